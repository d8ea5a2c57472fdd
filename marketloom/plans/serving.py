"""Recommendation tables for serving: live tables from the logs, then lists for all customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import discovery as D
from ..operators import reorder as R
from ..operators.catalog import apply_catalog_events
from ..operators.lines import available_products, order_lines
from ..operators.orders import apply_history_events, apply_order_events, validate_history, validate_order_events
from ..session import cut
from ..sources.tables import Tables

LIST_COLUMNS = ["customer_id", "customer_type", "section", "method", "rank", "product_id", "product_name", "producer_id", "score", "reason_codes"]


def live_tables(tables: Tables, producer_events: DataFrame, product_events: DataFrame, history: DataFrame, orders: DataFrame) -> Tables:
    """Base tables with the logs laid over them: catalogue, then history, then orders.

    The current catalogue and the accepted events are written once; everything after reads those
    instead of checking the logs again. Base orders and items are not copied.
    """
    current = apply_catalog_events(tables, producer_events, product_events)
    current = current.with_(producers=cut(current.producers), products=cut(current.products))
    batches = cut(validate_history(current, history)[0])
    current = apply_history_events(current, batches)
    accepted = cut(validate_order_events(current, orders)[0])
    return apply_order_events(current, accepted)


def hybrid_recommendations(
    tables: Tables, targets: DataFrame, k: int = 3, method: str = R.FREQUENCY_RECENCY, include_discovery: bool = True
) -> DataFrame:
    """Reorder lists and, when asked, discovery lists of the target customers.

    Unavailable products are not recommended. The date is the day after the last order; a customer
    without history gets the type of the customer table.
    """
    lines = order_lines(tables)
    products = available_products(tables.products)
    basis = D.Basis(lines, products)
    as_of = basis.as_of
    lists = R.reorder(lines, products, method, k, targets, as_of, basis.rolled).withColumn("section", F.lit("quick_reorder")).select(*LIST_COLUMNS)
    if include_discovery:
        found = D.discover(lines, products, D.COOCCURRENCE, k, targets, as_of, basis)
        found = found.withColumn("section", F.lit("you_may_also_like")).withColumn("rank", F.col("rank").cast("int"))
        lists = lists.unionByName(found.select(*LIST_COLUMNS))
    types = tables.customers.groupBy("customer_id").agg(F.min("customer_type").alias("_type"))
    filled = lists.join(types, "customer_id", "left").withColumn("customer_type", F.coalesce("customer_type", "_type")).drop("_type")
    return filled.withColumn("recommendation_date", as_of)


def write_serving_table(recs: DataFrame, path: str, buckets: int = 256) -> None:
    """Write lists so that a lookup of one customer reads one bucket folder."""
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(buckets))
    recs.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
