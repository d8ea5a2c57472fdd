"""Structured Streaming jobs: order lines, weekly demand, daily feedback, latest catalogue state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.catalog import latest_by_key
from ..operators.monitoring import COUNTERS, LOGGED, counted_flags, ratios, with_verdicts
from ..session import fresh_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LateRowsError(RuntimeError):
    """A query dropped rows behind its watermark."""


def run_available(
    df: DataFrame, checkpoint: str, out: str | None = None, each: Callable | None = None, mode: str = "append", parts: tuple = ()
) -> StreamingQuery:
    """Take what is there in as many micro-batches as needed, then end: into Parquet at ``out``, through ``each``, or into the
    query's own state only. State lives in RocksDB. Rows dropped behind a watermark are an error."""
    spark = df.sparkSession
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        if each is not None:
            query = writer.foreachBatch(each).start()
        elif out is not None:
            query = writer.format("parquet").option("path", out).partitionBy(*parts).start()
        else:
            query = writer.format("noop").start()
        query.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    if query.exception():
        raise query.exception()
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    if dropped:
        raise LateRowsError(f"{dropped} rows were dropped behind the watermark")
    return query


def written(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that a stream writes; empty before its first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


def kept(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys and the value of a one-aggregate query as of its last committed micro-batch, read from its state."""
    state = spark.read.format("statestore").load(checkpoint)
    # The state of a maximum is the row, then what it is ordered by; that of a sum is the sum.
    value = state.schema["value"].dataType.fields[0].name
    return state.select("key.*", F.col(f"value.{value}").alias("value"))


# --- order lines ---------------------------------------------------------------------------------


def split_late(events: DataFrame, path: str, checkpoint: str, time: str = "event_ts", delay: str = "7 days") -> StreamingQuery:
    """Write each micro-batch once, apart by whether a row lies over ``delay`` behind the newest row of earlier batches.

    Readers: ``rows/*/late=false`` and ``rows/*/late=true`` under ``path``. A batch's newest time is observed while it is
    written and kept beside it, running, so a batch reads one number of the batch before. A finished batch that is run again
    after a failure is not written again.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = lambda n: written(spark, f"{path}/newest/batch={n}", "newest bigint").first()
        if mark(batch_id):
            return
        before = mark(batch_id - 1) if batch_id else None
        newest = before["newest"] if before else None
        limit = F.timestamp_micros(F.lit(newest).cast("bigint")) - F.expr(f"interval {delay}")
        late = F.coalesce(F.col(time).cast("timestamp") < limit, F.lit(False))
        observed = Observation()
        rows = batch.observe(observed, F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias("newest"))
        rows.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(f"{path}/rows/batch={batch_id}")
        times = [t for t in (newest, observed.get.get("newest")) if t is not None]
        mark_row = spark.createDataFrame([(max(times) if times else None,)], "newest bigint")
        mark_row.coalesce(1).write.mode("overwrite").parquet(f"{path}/newest/batch={batch_id}")

    return run_available(events, checkpoint, each=each)


def week_of(time: str) -> Column:
    """The Monday of the week."""
    return F.to_date(F.date_trunc("week", F.col(time)))


def _exploded(orders: DataFrame, products: DataFrame, time: str) -> DataFrame:
    lines = orders.select("order_id", "customer_id", F.to_date("order_date").alias("order_date"), time, F.explode("items").alias("i"))
    flat = lines.select("order_id", "customer_id", "order_date", time, week_of(time).alias("week_start"), "i.product_id", "i.quantity", "i.unit_price")
    return flat.join(products.select("product_id", "product_name", "category", "producer_id"), "product_id", "left")


def stream_order_lines(orders: DataFrame, products: DataFrame, time: str = "event_ts", delay: str = "7 days") -> DataFrame:
    """Order stream to lines: one event per order id within the watermark, items exploded, joined with the catalogue.

    Rows behind the watermark would be dropped: ``take_order_lines`` sets them apart before and merges them after.
    """
    return _exploded(orders.withWatermark(time, delay).dropDuplicatesWithinWatermark(["order_id"]), products, time)


def take_order_lines(orders: DataFrame, products: DataFrame, path: str, time: str = "event_ts", delay: str = "7 days") -> None:
    """Take in what is there of an order stream as lines under ``path``; ``order_lines`` reads them. May be run again at any time.

    The state of seen ids covers ``delay`` only, however long the log is. Rows behind it go to a side table and are merged
    from there: an order that is late is new if neither the lines of its week nor earlier late lines hold its id. An order
    that is delivered again keeps its event time, so both deliveries lie in one week. The on-time rows of a run are
    one micro-batch, whose watermark is never ahead of the time at which its rows were found to be on time.
    """
    spark = orders.sparkSession
    split_late(orders, path, f"{path}/_split", time, delay)
    source = lambda late: spark.readStream.schema(orders.schema).parquet(f"{path}/rows/*/late={late}")
    on_time = stream_order_lines(source("false"), products, time, delay)
    numbered = StructType([*on_time.schema.fields, StructField("batch", LongType())])
    run_available(on_time, f"{path}/_lines", out=f"{path}/lines", parts=("week_start",))

    def merge(batch: DataFrame, batch_id: int) -> None:
        once = batch.dropDuplicates(["order_id"])
        weeks = [r[0] for r in once.select(week_of(time)).distinct().collect()]
        known = written(spark, f"{path}/lines", on_time.schema)
        earlier = written(spark, f"{path}/late_lines", numbered).filter(F.col("batch") < batch_id)
        ids = known.unionByName(earlier.drop("batch")).filter(F.col("week_start").isin(weeks)).select("order_id")
        new = _exploded(once.join(ids, "order_id", "left_anti"), products, time)
        new.select(*on_time.columns).write.mode("overwrite").parquet(f"{path}/late_lines/batch={batch_id}")

    run_available(source("true"), f"{path}/_late", each=merge)


def late_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """The lines of ``take_order_lines`` that came behind the delay."""
    return written(spark, f"{path}/late_lines", schema).drop("batch")


def order_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """All lines that ``take_order_lines`` has written, late ones included."""
    return written(spark, f"{path}/lines", schema).unionByName(late_lines(spark, path, schema))


WEEKLY = ["week_start", "producer_id", "product_id", "product_name"]


def stream_weekly_demand(lines: DataFrame) -> DataFrame:
    """Weekly quantity per producer and product; trend and forecast are batch work on its table.

    State is one sum a week and product, in proportion to the result, so it needs no watermark and no row can be late.
    """
    return lines.filter(F.col("producer_id").isNotNull()).groupBy(*WEEKLY).agg(F.sum("quantity").alias("quantity_ordered"))


def take_weekly_demand(spark: SparkSession, path: str, schema) -> DataFrame:
    """Take in the new lines of ``take_order_lines`` and return the weekly demand: the query's state plus the late lines."""
    lines = spark.readStream.schema(schema).parquet(f"{path}/lines")
    run_available(stream_weekly_demand(lines), f"{path}/_weekly", mode="update")
    sums = kept(spark, f"{path}/_weekly").withColumnRenamed("value", "quantity_ordered")
    late = stream_weekly_demand(late_lines(spark, path, schema))
    return sums.unionByName(late).groupBy(*WEEKLY).agg(F.sum("quantity_ordered").alias("quantity_ordered"))


# --- latest state --------------------------------------------------------------------------------


def keep_latest(events: DataFrame, key: str, checkpoint: str) -> StreamingQuery:
    """Takes in what is there of an event stream and keeps the latest event of each entity as the query's own state.

    Each micro-batch is reduced to one row per entity and task before it meets the state, which lives in RocksDB and is
    committed with the checkpoint: a query that is stopped or lost goes on from there when it is run again. ``events``
    needs ``seq`` (``logs.stream_log``); later positions win ties on time. Only entities take room, not events.
    """
    return run_available(latest_by_key(events, key), checkpoint, mode="update")


def latest_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The latest event of each entity as of the last committed micro-batch of ``keep_latest``, read from its state."""
    state = kept(spark, checkpoint)
    return state.select(*[c for c in state.columns if c != "value"], "value.*")


# --- feedback ------------------------------------------------------------------------------------

SAID = [
    "feedback_day", "accepted_ai_recommendation", "predicted_class", "predicted_grade", "corrected_class",
    "producer_override_class", "producer_override_grade",
]
SAID_TYPES = ", ".join(f"{c} {'boolean' if c.startswith('accepted') else 'string'}" for c in SAID)
LOGGED_TYPES = ", ".join(f"{c} { {'confidence': 'double', 'manual_review_required': 'boolean'}.get(c, 'string')}" for c in LOGGED)


def stream_feedback_counts(feedback: DataFrame, time: str = "feedback_ts") -> DataFrame:
    """The distinct feedback of each prediction id, as JSON text, with its number; equal feedback is combined before the shuffle.

    No bound on time and no watermark, so no row can be late. An id with very many rows sends one row a task and content.
    """
    said = F.to_json(F.struct(*SAID)).alias("said")
    rows = feedback.withColumn("feedback_day", F.date_format(time, "yyyy-MM-dd")).select("prediction_id", said)
    return rows.groupBy("prediction_id", "said").agg(F.count("*").alias("n"))


def stream_latest_predictions(predictions: DataFrame, order: list[str]) -> DataFrame:
    """The latest logged prediction of each id as JSON text; ``order`` names bigint columns by which later ones replace earlier ones."""
    named = predictions.filter(F.coalesce(F.col("prediction_id") != "", F.lit(False)))
    logged = named.select("prediction_id", F.struct(*[F.col(c).cast("bigint") for c in order]).alias("at"), F.to_json(F.struct(*LOGGED)).alias("logged"))
    return logged.groupBy("prediction_id").agg(F.max_by("logged", F.struct("at", "logged")).alias("logged"))


def feedback_daily(counts: DataFrame, latest: DataFrame) -> DataFrame:
    """Daily counters and ratios of counted feedback with its latest prediction, as ``monitoring.feedback_metrics`` has them.

    Feedback without an id can match nothing and goes around the join.
    """
    named = F.coalesce(F.col("prediction_id") != "", F.lit(False))
    joined = counts.filter(named).join(latest, "prediction_id", "left").unionByName(counts.filter(~named), allowMissingColumns=True)
    none = F.lit(None).cast("string")
    said, logged = F.from_json("said", SAID_TYPES), F.from_json("logged", LOGGED_TYPES)
    rows = joined.select(said.alias("s"), logged.alias("logged"), "n").select("s.*", "logged", "n", none.alias("created_at"), none.alias("model_name"))
    verdicts = with_verdicts(rows, keep=["feedback_day", "n"])
    sums = [F.sum(F.when(f, F.col("n")).otherwise(0)).alias(name) for name, f in zip(COUNTERS, counted_flags())]
    return verdicts.drop("day").groupBy(F.col("feedback_day").alias("day")).agg(*sums).select("day", *COUNTERS, *ratios())


def take_feedback(feedback: DataFrame, predictions: DataFrame, path: str, order: list[str]) -> DataFrame:
    """Take in what is there of both streams and return the daily counters and ratios so far. May be run again at any time.

    Each stream is an aggregate whose result is its own keyed state: the distinct feedback of an id with numbers, and its latest
    prediction. The states are read back and joined, so feedback meets a prediction of any age, in either order
    of arrival, and an id that is logged again changes the feedback given before.
    """
    spark = feedback.sparkSession
    run_available(stream_feedback_counts(feedback), f"{path}/_said", mode="update")
    run_available(stream_latest_predictions(predictions, order), f"{path}/_told", mode="update")
    counts = kept(spark, f"{path}/_said").withColumnRenamed("value", "n")
    return feedback_daily(counts, kept(spark, f"{path}/_told").withColumnRenamed("value", "logged"))


def checkpoint_for(spark: SparkSession, label: str) -> str:
    return fresh_path(spark, f"stream-{label}")
