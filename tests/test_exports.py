import pytest
from pyspark.sql import functions as F

from marketloom.plans import exports as X
from marketloom.plans.exports import Report
from tests.market import tables


def reports(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("list", F.array(F.lit("a"), F.col("text")))
    return {"as_csv": Report(rows, ["id"]), "as_json": Report(rows, ["id"], "json"), "as_parquet": Report(rows, [], "parquet")}


TEXTS = ["plain", None, "", ' blanks and "quotes" ', "comma, and\nline", "back\\slash"]


def test_published_reports_read_back_as_written(spark, tmp_path):
    manifest = X.publish(spark, str(tmp_path), reports(spark, TEXTS))
    assert {(m.file, m.rows, m.sequence) for m in manifest.collect()} == {(f"as_{f}", len(TEXTS), 1) for f in ("csv", "json", "parquet")}
    for name in ("as_csv", "as_json", "as_parquet"):
        back = X.read_published(spark, str(tmp_path), name).select("id", "text").collect()
        assert sorted(tuple(x) for x in back) == list(enumerate(TEXTS))
    assert X.read_published(spark, str(tmp_path), "as_json").filter("id = 0").first()["list"] == ["a", "plain"]
    assert X.read_published(spark, str(tmp_path), "as_csv").filter("id = 0").first()["list"] == '["a","plain"]'


def test_a_failed_run_leaves_the_last_good_set(spark, tmp_path):
    X.publish(spark, str(tmp_path), reports(spark, ["first"]))
    broken = reports(spark, ["second"])
    broken["broken"] = Report(broken["as_csv"].table.withColumn("x", F.raise_error(F.lit("no"))), [])
    with pytest.raises(Exception):
        X.publish(spark, str(tmp_path), broken)
    assert X.published(spark, str(tmp_path)).count() == 3
    assert X.read_published(spark, str(tmp_path), "as_csv").first()["text"] == "first"
    X.publish(spark, str(tmp_path), reports(spark, ["third"]))
    assert {m.sequence for m in X.published(spark, str(tmp_path)).collect()} == {2}
    assert X.read_published(spark, str(tmp_path), "as_csv").first()["text"] == "third"
    with pytest.raises(ValueError):
        X.read_published(spark, str(tmp_path), "broken")


def test_empty_reports_keep_their_columns(spark, tmp_path):
    manifest = X.publish(spark, str(tmp_path), reports(spark, []))
    assert {m.rows for m in manifest.collect()} == {0}
    for name in ("as_csv", "as_json", "as_parquet"):
        back = X.read_published(spark, str(tmp_path), name)
        assert back.columns == ["id", "text", "list"] and back.count() == 0


def test_recommender_export_publishes_every_report(spark, tmp_path):
    manifest = X.export_recommender(spark, tables(spark), str(tmp_path), 3)
    assert {m.file for m in manifest.collect()} == {
        "recommender_metrics", "recommendation_examples", "producer_diversity", "product_coverage", "recommendation_share_by_producer",
        "discovery_metrics", "discovery_examples", "discovery_share_by_producer", "discovery_product_coverage",
        "producer_demand_trends", "producer_next_week_forecast", "summary",
    }
    summary = X.read_published(spark, str(tmp_path), "summary").first()
    assert summary["order_lines"] == 7 and summary["top_k"] == 3
    assert [m["method"] for m in summary["method_metrics"]] == ["frequency_recency", "global_popularity", "user_frequency"]
    assert len(summary["discovery_method_metrics"]) == 3
