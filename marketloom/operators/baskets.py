"""Products bought together: the co-occurrence edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .blocked import sums

#: Baskets with more distinct products than this are split into blocks of about this size.
BLOCK = 256


def baskets(lines: DataFrame) -> DataFrame:
    """Distinct (order, product) rows: a basket is a set."""
    return lines.filter(F.col("order_id").isNotNull() & F.col("product_id").isNotNull()).select("order_id", "product_id").distinct()


def basket_pairs(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges (product_a, product_b, n): the number of baskets holding both, stored both ways.

    Each unordered pair is formed once, counted with map-side combine, and mirrored after counting.
    The products of a basket of ordinary size are one array, and its pairs come from that row. A basket with more than
    ``block`` products is cut into blocks by product hash, and every (block, block) pair is a join key of its
    own: the pairs are the same, but they spread over many tasks and no key holds more than about
    block x block of them.

    Baskets are written once. Planned from the lines, both sides of every join would be made again in the task that joins
    them, and each sort and aggregate there holds a page of memory or more.
    """
    items = cut(baskets(lines))
    sizes = items.groupBy("order_id").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    over = cut(sizes.filter("blocks > 1"))
    sets = items.join(over, "order_id", "left_anti").groupBy("order_id").agg(F.sort_array(F.collect_list("product_id")).alias("set"))
    firsts = sets.select("set", F.posexplode("set").alias("at", "a"))
    pairs = firsts.select("a", F.explode(F.slice("set", F.col("at") + 2, F.size("set"))).alias("b"))

    own = F.pmod(F.xxhash64("product_id"), F.col("blocks"))
    large = items.join(over, "order_id").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    rows = large.select("order_id", F.col("own").alias("i"), F.col("other").cast("bigint").alias("j"), F.col("product_id").alias("a"))
    cols = large.select("order_id", F.col("other").cast("bigint").alias("i"), F.col("own").alias("j"), F.col("product_id").alias("b"))
    blocked = rows.join(cols, ["order_id", "i", "j"]).filter("a < b").select("a", "b")

    once = pairs.unionByName(blocked).groupBy("a", "b").agg(F.count("*").alias("n"))
    return once.select(F.explode(F.array(
        F.struct(F.col("a").alias("product_a"), F.col("b").alias("product_b"), "n"),
        F.struct(F.col("b").alias("product_a"), F.col("a").alias("product_b"), "n"),
    )).alias("e")).select("e.*")


def history_x_cooccurrence(history: DataFrame, edges: DataFrame) -> DataFrame:
    """Raw scores (customer_id, product_id, raw): pair counts summed over the customer's products.

    Products bought already are scored too, because the customer's largest raw score counts them. ``history`` holds
    distinct pairs. The sums are made block by block (``blocked``), so no row of a purchase and an edge is shuffled.
    """
    return sums(history, edges)
