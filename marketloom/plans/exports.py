"""Export jobs: each writes its set of tables to a folder of the run and publishes them together at the end."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import demand as M
from ..operators import fairness as X
from ..operators import monitoring as Mo
from ..operators import predictions as P
from ..operators import splits as Sp
from ..operators.discovery import COOCCURRENCE
from ..operators.lines import dataset_summary, order_lines
from ..operators.reorder import FREQUENCY_RECENCY
from ..session import cut
from ..sources.tables import Tables
from . import evaluation as E
from .reports import CSV, write_report

MANIFEST = "sequence bigint, run string, file string, format string, rows bigint, location string, columns string"


@dataclass
class Report:
    """A table of an export: its rows, the order they are written in, and the format."""

    table: DataFrame
    order: list[str]
    fmt: str = "csv"


def publish(spark: SparkSession, base: str, reports: dict[str, Report]) -> DataFrame:
    """Write all reports under ``base/runs/<run>`` and then publish them; returns the manifest of the run.

    The manifest is one file, moved into ``base/published`` when its job commits. A run that fails before leaves the last
    published set as it was, and a reader never sees tables of two runs. Rows are counted while they are written; a
    report without rows is published with its columns. One job at a time publishes to a ``base``.
    """
    base, run = base.rstrip("/"), uuid.uuid4().hex
    entries = []
    for name, report in reports.items():
        location, seen = f"{base}/runs/{run}/{name}", Observation()
        write_report(report.table, location, report.fmt, report.order, seen)
        entries.append((run, name, report.fmt, seen.get["rows"], location, report.table.schema.json()))
    # Makes the folder where nothing was published yet.
    spark.createDataFrame([], MANIFEST).write.mode("append").json(f"{base}/published")
    last = manifests(spark, base).agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0]
    rows = spark.createDataFrame([(last + 1, *e) for e in entries], MANIFEST)
    rows.coalesce(1).write.mode("append").json(f"{base}/published")
    return published(spark, base)


def manifests(spark: SparkSession, base: str) -> DataFrame:
    """The manifests of all runs published to ``base``."""
    return spark.read.schema(MANIFEST).json(f"{base.rstrip('/')}/published")


def published(spark: SparkSession, base: str) -> DataFrame:
    """The manifest of the last published run: a row for each report."""
    rows = manifests(spark, base)
    return rows.filter(F.col("sequence") == rows.select(F.max("sequence")).scalar())


def read_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A report of the last published run, with its columns and types; nested columns of a CSV report stay JSON text."""
    entry = published(spark, base).filter(F.col("file") == name).first()
    if entry is None:
        raise ValueError(f"no published report {name} in {base}")
    schema = StructType.fromJson(json.loads(entry["columns"]))
    if entry["format"] == "csv":
        nested = ("array", "struct", "map")
        columns = ", ".join(f"`{f.name}` {'string' if f.dataType.typeName() in nested else f.dataType.simpleString()}" for f in schema)
        # With a null mark that no text has, a quoted empty text is one, and only a missing field is null.
        return spark.read.schema(columns).options(**CSV, multiLine=True, nullValue="\0").csv(entry["location"])
    return spark.read.schema(schema).format(entry["format"]).load(entry["location"])


# --- the jobs ------------------------------------------------------------------------------------


def _with_methods(row: DataFrame, metrics: DataFrame, out: str) -> DataFrame:
    """Adds the metrics as one array, a struct for each method (methods are a fixed short list)."""
    listed = metrics.select(F.array_sort(F.collect_list(F.struct("method", *[c for c in metrics.columns if c != "method"]))))
    return row.withColumn(out, listed.scalar())


def export_recommender(spark: SparkSession, tables: Tables, base: str, k: int = 3) -> DataFrame:
    """Metrics, lists, coverage and producer shares of the reorder and discovery methods, demand, and a summary."""
    split = E.prepare(tables)
    first, second = E.evaluate_reorder(tables, k, split=split), E.evaluate_discovery(tables, k, split=split)
    metrics, found = cut(first.metrics), cut(second.metrics)
    first, second = E.Evaluation(metrics, first.recommendations, first.producer_share), E.Evaluation(found, second.recommendations, second.producer_share)
    coverage, diversity = E.coverage_tables(first)
    trend = cut(M.demand_trend(order_lines(tables)))
    summary = dataset_summary(tables).select(
        "*", F.lit(FREQUENCY_RECENCY).alias("selected_method"), F.lit(COOCCURRENCE).alias("discovery_selected_method"), F.lit(k).alias("top_k")
    )
    summary = _with_methods(_with_methods(summary, metrics, "method_metrics"), found, "discovery_method_metrics")
    return publish(spark, base, {
        "recommender_metrics": Report(metrics, ["method"]),
        "recommendation_examples": Report(first.recommendations, ["method", "customer_id", "rank"]),
        "producer_diversity": Report(diversity, ["method"]),
        "product_coverage": Report(coverage, ["method"]),
        "recommendation_share_by_producer": Report(first.producer_share, ["method", "producer_id"]),
        "discovery_metrics": Report(found, ["method"]),
        "discovery_examples": Report(second.recommendations, ["method_run", "customer_id", "rank"]),
        "discovery_share_by_producer": Report(second.producer_share, ["method", "producer_id"]),
        "discovery_product_coverage": Report(E.coverage_tables(second)[0], ["method"]),
        "producer_demand_trends": Report(trend, ["producer_id", "product_id", "week_start"]),
        "producer_next_week_forecast": Report(M.demand_forecast(trend), ["producer_id", "product_id"]),
        "summary": Report(summary, [], "json"),
    })


def export_fairness(spark: SparkSession, tables: Tables, base: str, k: int = 3) -> DataFrame:
    """The study of alphas, producer shares by alpha, and the alpha chosen for each branch."""
    study, shares = E.alpha_study(tables, k)
    study = cut(study)
    return publish(spark, base, {
        "alpha_study": Report(study, ["branch", "alpha"]),
        "share_by_producer": Report(shares, ["branch", "alpha", "producer_id"]),
        "selected": Report(X.select_alpha(study), ["branch"], "json"),
    })


def export_thresholds(spark: SparkSession, preds: DataFrame, base: str, experiment: str | None = None) -> DataFrame:
    """The threshold grid of one experiment (of all predictions if none is named), and the operating point with its costs."""
    grid = cut(P.threshold_grid(preds if experiment is None else P.experiment_filter(preds, experiment)))
    chosen = P.select_operating_point(grid).select(
        F.lit(experiment).cast("string").alias("experiment_slug"), "*", grid.select(F.count("*")).scalar().alias("evaluated_settings"),
        F.create_map(*[F.lit(x) for pair in P.COSTS.items() for x in pair]).alias("cost_model"),
    )
    settings = ["confidence_review_threshold", "margin_review_threshold", "rotten_auto_block_threshold"]
    return publish(spark, base, {"threshold_results": Report(grid, settings), "threshold_summary": Report(chosen, [], "json")})


def export_monitoring(spark: SparkSession, feedback: DataFrame, predictions: DataFrame, base: str, seq: str = "seq") -> DataFrame:
    """All levels of the feedback metrics, and the ratios by day."""
    metrics = cut(Mo.feedback_metrics(feedback, predictions, seq))
    daily = metrics.filter("level = 'day'").select(
        F.col("key").alias("date"), "feedback_count", "class_accuracy_proxy", "grade_accuracy_proxy", "override_rate"
    )
    return publish(spark, base, {
        "feedback_monitoring_summary": Report(metrics, ["level", "key"], "json"),
        "feedback_accuracy_over_time": Report(daily, ["date"]),
    })


def export_validation(spark: SparkSession, preds: DataFrame, manifest: DataFrame, base: str) -> DataFrame:
    """Predictions against expected labels, and the summary by model."""
    validation = cut(P.validation_table(preds, manifest))
    return publish(spark, base, {
        "validation": Report(validation, ["image_path", "model"]),
        "validation_summary": Report(P.validation_summary(validation), ["model"]),
    })


def export_splits(spark: SparkSession, rows: DataFrame, base: str, class_column: str = "class_name", path: str = "relative_path") -> DataFrame:
    """A table for each split (``rows`` has ``split``), and the class names by index."""
    rows = cut(rows)
    parts = {s: Report(rows.filter(F.col("split") == s).drop("split"), [path]) for s in Sp.SPLITS}
    return publish(spark, base, parts | {"class_names": Report(Sp.class_index(rows, class_column), ["class_index"], "json")})


def contents(spark: SparkSession, base: str, names: list[str]) -> DataFrame:
    """The named reports of the last run in one table, each row with its ``file``; absent columns are null."""
    read = [read_published(spark, base, n).withColumn("file", F.lit(n)) for n in names]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)
