"""Order lines and the aggregates every recommender starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..session import cut, spread
from ..sources.tables import Tables
from .ranking import with_group_max


def available_products(products: DataFrame) -> DataFrame:
    """Products not marked unavailable; a missing status, or no status column, means available."""
    if "availability_status" not in products.columns:
        return products
    return products.filter(F.lower(F.coalesce("availability_status", F.lit("available"))) != "unavailable")


def order_lines(tables: Tables) -> DataFrame:
    """Items with their order (inner), product, customer type and producer name (left).

    No broadcast hints: dimensions are broadcast when Spark measures them to be small. The lines are the largest table of every
    job that starts here, so shuffles get partitions by their number (``session.spread``), and dimensions that are not small
    meet the orders and the products first: lines are shuffled by order and by product only.
    """
    orders = tables.orders.select("order_id", "customer_id", "order_date", "total_amount").join(
        tables.customers.select("customer_id", "customer_type"), "customer_id", "left"
    )
    products = tables.products.join(tables.producers.select("producer_id", "producer_name"), "producer_id", "left")
    return spread(tables.order_items).join(orders, "order_id").join(products, "product_id", "left")


def dataset_summary(tables: Tables) -> DataFrame:
    """One row: distinct entities, number of order lines, first and last order date.

    Dimension joins cannot drop lines, so lines are counted on items and orders alone; a duplicated
    dimension key would add lines, which ``order_lines(...).count()`` shows.
    """
    orders = tables.orders.agg(
        F.countDistinct("order_id").alias("orders"),
        F.min("order_date").alias("start_date"),
        F.max("order_date").alias("end_date"),
    )
    count = lambda df, key: df.select(F.countDistinct(key)).scalar()
    lines = order_lines(tables).select(F.count("*")).scalar()
    return orders.select(
        count(tables.customers, "customer_id").alias("customers"),
        count(tables.producers, "producer_id").alias("producers"),
        count(tables.products, "product_id").alias("products"),
        "orders",
        lines.alias("order_lines"),
        "start_date",
        "end_date",
    )


def roll_up(lines: DataFrame) -> DataFrame:
    """The lines summed by customer, product, customer type and category (each may be null), written once.

    Quantities are sums and ``order_date`` is the last one, under the names they have in the lines, so every aggregate
    below gives the same on a roll-up as on its lines, and the star join runs once for all of them. Counts of lines or
    orders are not kept.
    """
    keys = [c for c in ("customer_id", "product_id", "customer_type", "category") if c in lines.columns]
    return cut(lines.groupBy(*keys).agg(F.sum("quantity").alias("quantity"), F.max("order_date").alias("order_date")))


def next_day(lines: DataFrame) -> Column:
    """The day after the last order: the default recommendation date, as a scalar subquery."""
    return F.date_add(lines.select(F.max("order_date")).scalar(), 1)


def keyed(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())


def customer_product_stats(lines: DataFrame) -> DataFrame:
    """Per customer and product: quantity and last order date. Map-side combined."""
    return keyed(lines).groupBy("customer_id", "product_id").agg(
        F.sum("quantity").alias("quantity"), F.max("order_date").alias("last_order_date")
    )


def customer_types(lines: DataFrame) -> DataFrame:
    """One row per customer with lines; the type is null when no line has one."""
    return lines.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.min("customer_type").alias("customer_type"))


def product_popularity(lines: DataFrame) -> DataFrame:
    """Quantity per product and its ratio to the most popular product."""
    sold = lines.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    most = sold.select(F.max("quantity")).scalar()
    return sold.withColumn("popularity", ratio(F.col("quantity"), most))


def segment_popularity(lines: DataFrame) -> DataFrame:
    """Quantity per customer type and product, and its ratio to the top product of the type."""
    sold = (
        lines.filter(F.col("customer_type").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("customer_type", "product_id")
        .agg(F.sum("quantity").alias("quantity"))
    )
    top = with_group_max(sold, ["customer_type"], "quantity", "_top")
    return top.withColumn("popularity", ratio(F.col("quantity"), F.col("_top"))).drop("_top")


def category_affinity(lines: DataFrame) -> DataFrame:
    """Quantity per customer type and category, and its ratio to the top category of the type.

    The sums are few and written first. A join with the result then finds out its size at once, and need not shuffle the rows it
    is joined to by these two columns.
    """
    bought = cut(
        lines.filter(F.col("customer_type").isNotNull() & F.col("category").isNotNull())
        .groupBy("customer_type", "category")
        .agg(F.sum("quantity").alias("quantity"))
    )
    top = with_group_max(bought, ["customer_type"], "quantity", "_top")
    return top.withColumn("affinity", ratio(F.col("quantity"), F.col("_top"))).drop("_top")
