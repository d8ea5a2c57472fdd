"""Streams against batch results: logs longer than the delay, several runs, late and repeated rows."""

import pytest
from pyspark.sql import functions as F

from marketloom.operators import monitoring as Mo
from marketloom.sources import logs
from marketloom.streaming import jobs as J

ORDER = "order_id string, customer_id string, order_date string, items array<struct<product_id:string,quantity:double,unit_price:double>>, event_ts timestamp"
LINES = (
    "product_id string, order_id string, customer_id string, order_date date, event_ts timestamp, quantity double, unit_price double,"
    " product_name string, category string, producer_id string, week_start date"
)


def _append(spark, path, values, schema):
    spark.createDataFrame(values, schema).withColumn("event_ts", F.col("event_ts").cast("timestamp")).coalesce(1).write.mode("append").json(path)


def test_a_log_longer_than_the_delay_loses_nothing(spark, tmp_path):
    """Three runs, each with orders of its month, orders of the first month and orders that came before, on time or late."""
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    products = spark.createDataFrame([("P1", "Leek", "veg", "F1"), ("P2", "Pear", "fruit", None)], "product_id string, product_name string, category string, producer_id string")
    order = lambda i, day: (f"O{i}", "C", day[:10], [("P1", 1.0 + i, 1.0), ("P2", 1.0, 1.0), ("none", 1.0, 1.0)][: 1 + i % 3], day)
    first = [order(i, f"2026-01-{1 + i % 20:02d}T10:00:00") for i in range(20)]
    second = [order(i, f"2026-02-{1 + i % 20:02d}T10:00:00") for i in range(20, 40)]
    straggling = [order(i, "2026-01-05T12:00:00") for i in range(40, 46)]
    third = [order(50, "2026-03-01T00:00:00"), order(51, "2026-01-06T00:00:00")]
    text = ORDER.replace("event_ts timestamp", "event_ts string")
    for rows in (first + first[:5], second + straggling + first[3:8] + straggling[:2], third + straggling + second[:4] + first):
        _append(spark, log, rows, text)
        orders = spark.readStream.schema(ORDER).json(log)
        J.take_order_lines(orders, products, out, delay="3 days")
        weekly = J.take_weekly_demand(spark, out, LINES)
    want = [(o[0], p, q) for o in first + second + straggling + third for p, q, _ in o[3]]
    got = [tuple(r) for r in J.order_lines(spark, out, LINES).select("order_id", "product_id", "quantity").collect()]
    assert sorted(got) == sorted(want)
    assert J.late_lines(spark, out, LINES).select("order_id").distinct().count() == 7
    sums = {}
    for r in J.order_lines(spark, out, LINES).collect():
        if r.producer_id:
            sums[r.week_start, r.product_id] = sums.get((r.week_start, r.product_id), 0) + r.quantity
    assert {(r.week_start, r.product_id): r.quantity_ordered for r in weekly.collect()} == sums and len(sums) > 6


def test_rows_behind_the_watermark_are_an_error(spark, tmp_path):
    """Without the split a late row would be lost; the query says so."""
    log = str(tmp_path / "log")
    products = spark.createDataFrame([], "product_id string, product_name string, category string, producer_id string")
    text = ORDER.replace("event_ts timestamp", "event_ts string")
    lines = lambda: J.stream_order_lines(spark.readStream.schema(ORDER).json(log), products, delay="1 day")
    run = lambda: J.run_available(lines(), str(tmp_path / "cp"), out=str(tmp_path / "out"))
    _append(spark, log, [("A", "C", "2026-02-01", [], "2026-02-01T00:00:00")], text)
    run()
    _append(spark, log, [("B", "C", "2026-01-01", [], "2026-01-01T00:00:00")], text)
    with pytest.raises(J.LateRowsError):
        run()


FEEDBACK = (
    "prediction_id string, predicted_class string, predicted_grade string, corrected_class string, producer_override_class string,"
    " producer_override_grade string, accepted_ai_recommendation boolean, feedback_ts string"
)
PREDICTION = (
    "seq bigint, prediction_id string, created_at string, predicted_class string, quality_grade string, model_name string,"
    " confidence double, manual_review_required boolean"
)


def test_daily_feedback_equals_batch_at_any_distance(spark, tmp_path):
    """Feedback a year after its prediction, before it, without id, equal rows, and a prediction that is logged again."""
    said = lambda i, day, ok, fix=None: (i, None, None, fix, None, "A" if fix else None, ok, f"{day}T01:00:00")
    told = lambda n, i, name, c: (n, i, "2025-01-01T00:00:00", name, "B", "m", c, n % 2 == 0)
    runs = [
        ([said("a", "2025-02-01", False), said("b", "2025-02-01", None, "kiwi"), said("", "2025-02-01", True), said(None, "2025-02-02", None)], [told(1, "a", "pear", 0.95)]),
        ([said("a", "2026-03-01", False, "pear")] * 3 + [said("c", "2025-02-01", None, "fig")], [told(2, "b", "kiwi", 0.5), told(3, "", "x", 0.1)]),
        ([said("b", "2026-03-01", False)], [told(5, "a", "fig", 0.91), told(4, "a", "plum", 0.2), told(6, "c", None, 0.99)]),
    ]
    logs, out = (str(tmp_path / "said"), str(tmp_path / "told")), str(tmp_path / "out")
    all_said, all_told = [], []
    for feedback, predictions in runs:
        all_said, all_told = all_said + feedback, all_told + predictions
        for values, schema, at in ((feedback, FEEDBACK, logs[0]), (predictions, PREDICTION, logs[1])):
            spark.createDataFrame(values, schema).repartition(2).write.mode("append").json(at)
        streams = [spark.readStream.schema(s).option("maxFilesPerTrigger", 1).json(at) for s, at in ((FEEDBACK, logs[0]), (PREDICTION, logs[1]))]
        got = J.take_feedback(*streams, out, ["seq"])
        rows = spark.createDataFrame(all_said, FEEDBACK).withColumn("created_at", F.col("feedback_ts")).withColumn("model_name", F.lit(None).cast("string"))
        want = Mo.feedback_metrics(rows, spark.createDataFrame(all_told, PREDICTION)).filter("level = 'day'").select(F.col("key").alias("day"), *got.columns[1:])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_the_state_of_feedback_needs_no_python(spark, tmp_path):
    """A Python call for each prediction id took milliseconds an id; both states are aggregates of Spark's own."""
    frame = lambda schema: spark.readStream.schema(schema).json(str(tmp_path))
    plans = [J.stream_feedback_counts(frame(FEEDBACK)), J.stream_latest_predictions(frame(PREDICTION), ["seq"])]
    for plan in plans:
        assert "Pandas" not in plan._jdf.queryExecution().analyzed().toString()


def test_files_of_an_append_do_not_go_by_the_shuffle_partitions(spark, tmp_path):
    """A reader takes files by number, so files of a few events are micro-batches of a few events."""
    at, before = str(tmp_path / "log"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        logs.append_log(spark.range(1000).select(F.col("id").alias("seq"), F.lit("x").alias("source")), None, at)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(list((tmp_path / "log").glob("part-*"))) <= logs.FEW_FILES
    log = logs.read_log(spark, at, "producer")
    assert log.count() == 1000 and log.select("seq").distinct().count() == 1000
