"""Order and history events: validation, normal form, overlay on the base tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..sources.tables import Tables
from ..session import cut, fresh_path
from .catalog import _blank, first_reason, trimmed_ids
from .components import connected
from .joins import left_join_keyed
from .ranking import placed, ranked

ORDER_SOURCE = "order_event"
HISTORY_SOURCE = "history_backfill"
#: Claims of one component of history batches that one task settles in turn.
FOLD_ROWS = 1_000_000


def order_total(total: Column, items: Column) -> Column:
    """The given total, or the sum of quantity x price to 2 places."""
    summed = F.aggregate(items, F.lit(0.0), lambda acc, i: acc + i["quantity"] * i["unit_price"])
    return F.coalesce(total, round_to(summed, 2))


def written_date(name: str) -> Column:
    """The date as it is written; an offset of the time does not move it."""
    return F.when(F.try_to_timestamp(F.col(name)).isNotNull(), F.coalesce(F.try_to_date(F.substring(F.col(name).cast("string"), 1, 10)), F.to_date(F.try_to_timestamp(F.col(name)))))


def _known(df: DataFrame, key: str, mark: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(mark, F.lit(True))


def order_checks(tables: Tables, events: DataFrame, log_ids: DataFrame | None) -> DataFrame:
    """Adds ``reject_reason`` (first broken rule) to order events; ``seq`` orders events of one id.

    Known ids are matched by equi-joins. Items are exploded once for the product check and reduced
    to the events that hold an unknown one.
    """
    events = trimmed_ids(events, "order_id", "customer_id")
    known_orders = tables.orders.select("order_id")
    if log_ids is not None:
        known_orders = known_orders.unionByName(log_ids.select("order_id"))
    flagged = left_join_keyed(events, _known(known_orders, "order_id", "_dup"), "order_id", ["seq"])
    flagged = left_join_keyed(flagged, _known(tables.customers, "customer_id", "_customer"), "customer_id", ["seq"])
    lines = events.select("seq", F.explode("items").alias("i")).select("seq", F.col("i.product_id").alias("product_id"))
    unknown = (
        lines.join(tables.products.select("product_id"), "product_id", "left_anti").select("seq").distinct().withColumn("_unknown", F.lit(True))
    )
    flagged = flagged.join(unknown, "seq", "left")
    bad_item = lambda i: ~F.coalesce((i["quantity"] > 0) & (i["unit_price"] >= 0), F.lit(False))
    no_items = F.coalesce(F.size("items") < 1, F.lit(True))
    return flagged.withColumn(
        "reject_reason",
        first_reason(
            (_blank("order_id"), "missing order_id"),
            (F.col("_dup").isNotNull(), "duplicate order_id"),
            (_blank("customer_id"), "missing customer_id"),
            (no_items, "no items"),
            (F.col("_customer").isNull() & (F.coalesce("customer_type", F.lit("")) == ""), "unknown customer without type"),
            (F.col("_unknown").isNotNull(), "unknown product_id"),
            (F.try_to_timestamp(F.col("order_date")).isNull(), "invalid order_date"),
            (F.exists(F.coalesce("items", F.array().cast(events.schema["items"].dataType)), bad_item), "invalid item"),
        ),
    ).drop("_dup", "_customer", "_unknown")


def validate_order_events(tables: Tables, events: DataFrame, log_ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted in normal form, rejected with a reason).

    An event is a duplicate when its order is in the tables, in the logs, or accepted earlier in the
    same batch. The earliest acceptable event of an id is found by a minimum per id, not by a
    window, so an id repeated very often costs one row per task.
    """
    checked = order_checks(tables, events, log_ids)
    # Only an otherwise valid event can be "accepted earlier".
    first = checked.filter(F.col("reject_reason").isNull()).groupBy("order_id").agg(F.min("seq").alias("_first"))
    placed = left_join_keyed(checked, first, "order_id", ["seq"])
    repeat = F.coalesce(F.col("seq") > F.col("_first"), F.lit(False))
    # Duplicate comes right after a missing id, so it overrides the reasons behind it.
    reason = F.when((F.col("reject_reason") == "missing order_id"), F.col("reject_reason")).when(repeat, F.lit("duplicate order_id")).otherwise(
        F.col("reject_reason")
    )
    placed = placed.withColumn("reject_reason", reason).drop("_first")
    ok = F.col("reject_reason").isNull()
    return normalise_order_events(placed.filter(ok).drop("reject_reason")), placed.filter(~ok)


def normalise_order_events(events: DataFrame, source: str = ORDER_SOURCE) -> DataFrame:
    """Dates as dates, the default total and the default source."""
    return events.select(
        "seq", "order_id", "customer_id", "customer_type", "postcode_area",
        written_date("order_date").alias("order_date"),
        order_total(F.col("total_amount"), F.col("items")).alias("total_amount"),
        "items",
        F.coalesce("source", F.lit(source)).alias("source"),
    )


def flatten_history(batches: DataFrame) -> DataFrame:
    """One order event per order of each history batch; ``seq`` is (batch seq, place in the batch)."""
    spread = batches.select("*", F.posexplode("orders").alias("_at", "o"))
    return spread.select(
        F.struct(F.col("seq").alias("batch"), F.col("_at").alias("at")).alias("seq"),
        "o.order_id", "customer_id", "customer_type", "postcode_area", "o.order_date", "o.total_amount", "o.items",
        F.coalesce("source", F.lit(HISTORY_SOURCE)).alias("source"), "history_batch_id",
    )


def _folded(claims: pa.Table) -> pa.Table:
    """The batches of one component that lose an order, taken one after another; ``claims`` holds (root, number, order_id)."""
    claims = claims.sort_by("number")
    taken, late, now, own = set(), [], None, []

    def settle() -> None:
        if taken.isdisjoint(own):
            taken.update(own)
        else:
            late.append(now)

    for number, order in zip(claims.column("number").to_pylist(), claims.column("order_id").to_pylist()):
        if number != now and now is not None:
            settle()
            own = []
        now = number
        own.append(order)
    if now is not None:
        settle()
    return pa.table({"number": pa.array(late, pa.int64())})


def _late_in_rounds(claims: DataFrame) -> DataFrame:
    """The batches (number) that lose an order, in rounds over all of ``claims`` (number, order_id) at once.

    Batches that come first for all their orders are accepted, batches that share an order with those are late, and the
    others go into the next round. Each round adds its late batches to one table.
    """
    spark, path = claims.sparkSession, fresh_path(claims.sparkSession, "late")
    claims.select("number").limit(0).write.parquet(path)
    left = claims
    while not left.isEmpty():
        first = left.groupBy("order_id").agg(F.min("number").alias("_first"))
        wins = left.join(first, "order_id").groupBy("number").agg(F.min(F.col("number") == F.col("_first")).alias("_wins"))
        accepted = cut(wins.filter("_wins").select("number"))
        taken = left.join(accepted, "number", "left_semi").select("order_id")
        lost = cut(left.join(accepted, "number", "left_anti").join(taken, "order_id", "left_semi").select("number").distinct())
        lost.write.mode("append").parquet(path)
        left = cut(left.join(accepted.union(lost), "number", "left_anti"))
    return spark.read.schema("number bigint").parquet(path)


def _late_batches(claims: DataFrame, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Batches (seq) that lose an order to an earlier accepted batch; ``claims`` holds (seq, order_id).

    Only orders that several batches claim matter. Batches that are linked by those fall into components, which do not
    touch each other: one with up to ``fold_rows`` claims is settled batch by batch in one pass of one task, a larger
    one in rounds over all tasks. So the number of jobs does not grow with the longest chain of batches, unless its
    component is that large.
    """
    rows = cut(trimmed_ids(claims, "order_id").distinct())
    several = rows.groupBy("order_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("order_id")
    contested = cut(rows.join(several, "order_id"))
    numbers = cut(placed(cut(contested.select("seq").distinct()), [], [F.col("seq")], "number"))
    named = cut(contested.join(numbers, "seq").select("number", "order_id"))
    first = named.groupBy("order_id").agg(F.min("number").alias("_first"))
    roots = cut(connected(named.join(first, "order_id"), "_first", "number").withColumnRenamed("node", "number"))
    in_component = cut(named.join(roots, "number"))
    sizes = in_component.groupBy("root").agg(F.count("*").alias("_n"))
    small = in_component.join(sizes.filter(F.col("_n") <= fold_rows), "root").select("root", "number", "order_id")
    large = cut(in_component.join(sizes.filter(F.col("_n") > fold_rows), "root").select("number", "order_id"))
    late = small.groupBy("root").applyInArrow(_folded, "number bigint")
    if not large.isEmpty():
        late = late.union(_late_in_rounds(large))
    return late.join(numbers, "number").select("seq")


def validate_history(tables: Tables, batches: DataFrame, log_ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted batches, rejected batches with a reason). One bad order rejects its whole batch.

    An order is checked against the tables and both logs. Within the input, one batch after another, a batch is
    rejected if an accepted earlier batch brought one of its orders; a rejected batch claims none.
    """
    orders = flatten_history(batches)
    checked = order_checks(tables, orders, log_ids)
    # The first failing order, in batch order, names the batch's reason.
    per_batch = checked.groupBy(F.col("seq.batch").alias("seq")).agg(
        F.min_by("reject_reason", F.when(F.col("reject_reason").isNotNull(), F.col("seq.at"))).alias("order_reason"),
        F.count("*").alias("_orders"),
        F.count_distinct("order_id").alias("_ids"),
    )
    own = first_reason(
        (_blank("customer_id"), "missing customer_id"),
        (F.coalesce(F.size("orders") < 1, F.lit(True)), "no orders"),
    )
    joined = batches.join(per_batch, "seq", "left")
    reason = F.coalesce(own, F.col("order_reason"), F.when(F.col("_ids") < F.col("_orders"), F.lit("duplicate order_id")))
    judged = joined.withColumn("reject_reason", reason).drop("order_reason", "_orders", "_ids")
    good = flatten_history(judged.filter(F.col("reject_reason").isNull()))
    late = _late_batches(good.select(F.col("seq.batch").alias("seq"), "order_id"))
    judged = judged.join(late.withColumn("_late", F.lit(True)), "seq", "left")
    judged = judged.withColumn("reject_reason", F.coalesce("reject_reason", F.when(F.col("_late"), F.lit("duplicate order_id")))).drop("_late")
    ok = F.col("reject_reason").isNull()
    return judged.filter(ok).drop("reject_reason"), judged.filter(~ok)


def new_customers(tables: Tables, events: DataFrame) -> DataFrame:
    """Customers that only the events know; the first event defines type and area."""
    unknown = events.filter(F.col("customer_id").isNotNull()).join(tables.customers.select("customer_id"), "customer_id", "left_anti")
    first = unknown.groupBy("customer_id").agg(F.min_by(F.struct("customer_type", "postcode_area"), F.col("seq")).alias("c"))
    filled = lambda name: F.coalesce(F.nullif(F.col(f"c.{name}"), F.lit("")), F.lit("unknown")).alias(name)
    return first.select("customer_id", filled("customer_type"), filled("postcode_area"))


def apply_order_events(tables: Tables, valid: DataFrame) -> Tables:
    """Tables with the orders, items and new customers of accepted events appended."""
    orders = valid.select("order_id", "customer_id", "order_date", F.coalesce("total_amount", F.lit(0.0)).alias("total_amount"))
    items = valid.select("order_id", F.explode("items").alias("i")).select("order_id", "i.product_id", "i.quantity", "i.unit_price")
    return tables.with_(
        customers=tables.customers.unionByName(new_customers(tables, valid), allowMissingColumns=True),
        orders=tables.orders.unionByName(orders, allowMissingColumns=True),
        order_items=tables.order_items.unionByName(items, allowMissingColumns=True),
    )


def apply_history_events(tables: Tables, accepted_batches: DataFrame) -> Tables:
    flat = flatten_history(accepted_batches)
    return apply_order_events(tables, normalise_order_events(flat, HISTORY_SOURCE))


def order_receipts(valid: DataFrame) -> DataFrame:
    """One row for each accepted order event: its lines, and the orders and lines taken in up to it, in log order."""
    lines = valid.select("seq", "order_id", "customer_id", F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("ingested_order_lines"))
    return _so_far(lines).select("seq", F.lit("ingested").alias("status"), "order_id", "customer_id", "ingested_order_lines", "orders_so_far", "lines_so_far")


def history_receipts(accepted: DataFrame) -> DataFrame:
    """One row for each accepted history batch: its orders and lines, and the batches and lines taken in up to it."""
    held = F.aggregate("orders", F.lit(0).cast("bigint"), lambda n, o: n + F.coalesce(F.size(o["items"]), F.lit(0)))
    lines = accepted.select("seq", "history_batch_id", "customer_id", F.size("orders").alias("ingested_orders"), held.alias("ingested_order_lines"))
    return _so_far(lines).withColumn("status", F.lit("ingested")).withColumnRenamed("orders_so_far", "batches_so_far")


def _so_far(lines: DataFrame) -> DataFrame:
    """Running counts over range partitions: no task sees more than its own rows."""
    counted = ranked(lines, [], [F.col("seq")], total_of="ingested_order_lines")
    return counted.withColumnRenamed("rank", "orders_so_far").withColumnRenamed("running", "lines_so_far")


def ingest_receipt(tables: Tables) -> DataFrame:
    """Distinct orders and joined order lines after an ingest."""
    lines = tables.order_items.join(tables.orders.select("order_id"), "order_id").select(F.count("*")).scalar()
    return tables.orders.agg(F.countDistinct("order_id").alias("total_orders")).withColumn("total_order_lines", lines)
