"""Append-only JSON-lines event logs: schemas, batch and streaming reads, validated appends."""

from __future__ import annotations

import math
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

ITEM = "struct<product_id:string,quantity:double,unit_price:double>"

LOG_SCHEMAS = {
    "producer": (
        "event_type string, producer_id string, producer_name string, postcode_area string,"
        " categories array<string>, organic_certified boolean, created_at string, source string"
    ),
    "product": (
        "event_type string, product_id string, producer_id string, product_name string, category string,"
        " unit string, price double, seasonal boolean, seasonal_start_month int, seasonal_end_month int,"
        " available boolean, created_at string, source string"
    ),
    "order": (
        "order_id string, customer_id string, customer_type string, postcode_area string, order_date string,"
        f" total_amount double, items array<{ITEM}>, source string, created_at string"
    ),
    "history": (
        "history_batch_id string, customer_id string, customer_type string, postcode_area string, source string,"
        f" orders array<struct<order_id:string,order_date:string,total_amount:double,items:array<{ITEM}>>>,"
        " created_at string"
    ),
    "prediction": (
        "prediction_id string, created_at string, model_name string, model_version string,"
        " predicted_class string, freshness_status string, confidence double, top1_top2_margin double,"
        " quality_grade string, recommended_action string, reason_codes array<string>,"
        " manual_review_required boolean, content_type string"
    ),
    "feedback": (
        "prediction_id string, image_id string, predicted_class string, predicted_grade string,"
        " corrected_class string, producer_override_class string, producer_override_grade string,"
        " override_reason string, accepted_ai_recommendation boolean, model_name string, user_note string,"
        " created_at string"
    ),
}


#: Events of one file of an append, at most about; files of a smaller append.
FILE_EVENTS, FEW_FILES = 500_000, 8

SEQ = "struct<append:bigint,row:bigint,file:string,part:bigint,line:bigint>"


def log_schema(kind: str, ids: str = "string") -> str:
    """The schema of a log's lines, with ids of another type where wanted, and the position that ``append_log`` writes."""
    schema = LOG_SCHEMAS[kind]
    if ids != "string":
        schema = schema.replace("_id string", f"_id {ids}").replace("_id:string", f"_id:{ids}")
    return schema + ", position struct<append:bigint,row:bigint>"


def with_seq(events: DataFrame, line: Column) -> DataFrame:
    """Replaces ``position`` by ``seq``, a value that grows with log position.

    An event that ``append_log`` wrote carries its position: (time of the append, row in it), which is the same for every
    reader, in batches and micro-batches, and survives a move of the files. A line of another writer goes by its file's
    time, name and block and by ``line``.
    """
    written = F.coalesce(F.col("position.append"), F.unix_micros("_metadata.file_modification_time"))
    foreign = F.col("position").isNull()
    return events.withColumn("seq", F.struct(
        written.alias("append"), F.coalesce("position.row", F.lit(0).cast("bigint")).alias("row"),
        F.when(foreign, F.col("_metadata.file_path")).alias("file"), F.when(foreign, F.col("_metadata.file_block_start")).alias("part"),
        F.when(foreign, line).alias("line"),
    )).drop("position")


def read_log(spark: SparkSession, path: str, kind: str, ids: str = "string") -> DataFrame:
    """All events of a log with ``seq`` (``with_seq``), so ties on event time can be settled by position.

    Blank lines are skipped by the reader; a log that does not exist yet is an empty table.
    """
    schema = log_schema(kind, ids)
    try:
        events = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema).withColumn("seq", F.lit(None).cast(SEQ)).drop("position")
    return with_seq(events, F.monotonically_increasing_id())


def stream_log(spark: SparkSession, path: str, kind: str, files_per_batch: int = 1000, ids: str = "string") -> DataFrame:
    """The events of a log as a stream, with the ``seq`` of ``read_log``; lines of other writers in one block have one position."""
    events = spark.readStream.schema(log_schema(kind, ids)).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).json(path)
    return with_seq(events, F.lit(0).cast("bigint"))


def append_log(valid: DataFrame, rejected: DataFrame | None, path: str, quarantine: str | None = None) -> None:
    """Append a batch of accepted events; rejected ones go to the quarantine folder.

    Each event is written with its position. Where events have a ``seq``, they keep its order: they are range-partitioned
    by it, so no task sorts all. The number of files goes by the events: readers of the stream take files by number, and each
    micro-batch commits all of their state. Appends are ordered by the driver's clock.
    """
    ordered = valid
    if "seq" in valid.columns:
        parts = max(FEW_FILES, math.ceil(valid.count() / FILE_EVENTS))
        ordered = valid.repartitionByRange(parts, "seq").sortWithinPartitions("seq").drop("seq")
    position = F.struct(F.lit(time.time_ns() // 1000).alias("append"), F.monotonically_increasing_id().alias("row"))
    ordered.withColumn("position", position).write.mode("append").json(path)
    if rejected is not None and quarantine:
        rejected.write.mode("append").json(quarantine)
