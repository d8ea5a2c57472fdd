"""Reorder recommendations for a whole table of customers in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import clamp01, ratio, recency_decay, round6
from ..functions.reasons import REORDER_DEFAULT, REORDER_WORDING, code, joined, reason_codes, reason_text
from ..functions.seasons import seasonal_flag
from .lines import category_affinity, customer_types, next_day, product_popularity
from .ranking import top_k

GLOBAL_POPULARITY = "global_popularity"
USER_FREQUENCY = "user_frequency"
FREQUENCY_RECENCY = "frequency_recency"
REORDER_METHODS = [GLOBAL_POPULARITY, USER_FREQUENCY, FREQUENCY_RECENCY]

# Weights and reason thresholds of the frequency-recency score.
FREQUENCY_WEIGHT = 0.55
RECENCY_WEIGHT = 0.30
AFFINITY_WEIGHT = 0.10
SEASON_WEIGHT = 0.05
RECENT_FROM = 0.35
AFFINITY_FROM = 0.5

COLUMNS = [
    "customer_id", "customer_type", "method", "rank",
    "product_id", "product_name", "producer_id", "score", "reason_codes",
]


def _catalogue(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name", "producer_id", F.col("category").alias("product_category"),
        "seasonal_start_month", "seasonal_end_month",
    )


def top_k_popular(lines: DataFrame, products: DataFrame, k: int) -> DataFrame:
    """The k products sold most. Ranks are given before the catalogue lookup, so a product that is
    not in the catalogue leaves a gap."""
    best = product_popularity(lines).orderBy(F.desc("quantity"), "product_id").limit(k)
    # k rows from here on: k is the size of one list, so this window is bounded by it.
    placed = best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("quantity"), "product_id")))
    return placed.join(_catalogue(products), "product_id").select(
        "rank", "product_id", "product_name", "producer_id", round6(clamp01(F.col("popularity"))).alias("score")
    )


def popular_for(customers: DataFrame, lines: DataFrame, products: DataFrame, k: int, method: str, cold: bool) -> DataFrame:
    """The popular list given to each customer row (customer_id, customer_type).

    The list is one array of at most k entries, read as a scalar subquery and exploded, so no
    join of any kind multiplies the customers.
    """
    entries = top_k_popular(lines, products, k).select(
        F.array_sort(F.collect_list(F.struct("rank", "product_id", "product_name", "producer_id", "score")))
    )
    codes = reason_codes(code("globally_popular_product"), code("cold_start_fallback", F.lit(cold)))
    return customers.select("customer_id", "customer_type", F.explode(entries.scalar()).alias("e")).select(
        "customer_id", "customer_type", F.lit(method).alias("method"),
        "e.rank", "e.product_id", "e.product_name", "e.producer_id", "e.score", codes.alias("reason_codes"),
    )


def customers_without_history(targets: DataFrame, lines: DataFrame) -> DataFrame:
    """Target customers with no lines; their type is unknown here."""
    seen = lines.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    return targets.join(seen, "customer_id", "left_anti").withColumn("customer_type", F.lit(None).cast("string"))


def _for_targets(df: DataFrame, targets: DataFrame | None) -> DataFrame:
    return df if targets is None else df.join(targets.select("customer_id"), "customer_id", "left_semi")


def _user_frequency(own: DataFrame, lines: DataFrame, products: DataFrame, k: int) -> DataFrame:
    # Cut before the catalogue lookup: a product that left the catalogue leaves a gap.
    best = top_k(_typed_stats(own), ["customer_id"], [F.desc("quantity"), F.asc("product_id")], k)
    return (
        best.join(_catalogue(products), "product_id")
        .withColumn("score", round6(clamp01(ratio(F.col("quantity"), F.col("_top")))))
        .withColumn("reason_codes", F.array(F.lit("frequently_ordered_by_customer")))
    )


def _typed_stats(own: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """``customer_product_stats`` with the customer's type (``customer_types``) and largest quantity, from one pass over the lines.

    A line without a product can still tell the type, so such lines stay until it is known. The largest quantity counts every
    product of the customer, also unlisted ones. With a ``catalogue`` its columns are added and unlisted products dropped: it is
    joined before the rows are brought together by customer, and they stay so for what is done by customer afterwards.
    """
    known = F.col("product_id").isNotNull()
    customer = Window.partitionBy("customer_id")
    stats = own.filter(F.col("customer_id").isNotNull()).groupBy("customer_id", "product_id").agg(
        F.sum("quantity").alias("quantity"), F.max("order_date").alias("last_order_date"), F.min("customer_type").alias("_type")
    )
    wanted = known
    if catalogue is not None:
        stats = stats.join(catalogue.withColumn("_listed", F.lit(True)), "product_id", "left")
        wanted = known & F.col("_listed").isNotNull()
    return (
        stats.withColumn("customer_type", F.min("_type").over(customer))
        .withColumn("_top", F.max(F.when(known, F.col("quantity"))).over(customer))
        .filter(wanted).drop("_type", "_listed")
    )


def score_frequency_recency(own: DataFrame, lines: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """All scored (customer, product) rows of the frequency-recency method."""
    affinity = category_affinity(lines).select(
        "customer_type", F.col("category").alias("product_category"), "affinity"
    )
    season = seasonal_flag(F.month(as_of), F.col("seasonal_start_month"), F.col("seasonal_end_month"))
    joined_up = (
        _typed_stats(own, _catalogue(products).withColumn("season", season).drop("seasonal_start_month", "seasonal_end_month"))
        .join(affinity, ["customer_type", "product_category"], "left")
    )
    frequency = ratio(F.col("quantity"), F.when(F.col("_top") != 0, F.col("_top")).otherwise(F.lit(1.0)))
    parts = joined_up.select(
        "customer_id", "customer_type", "product_id", "product_name", "producer_id",
        frequency.alias("frequency"),
        recency_decay(as_of, F.col("last_order_date")).alias("recency"),
        F.coalesce("affinity", F.lit(0.0)).alias("affinity"),
        "season",
    )
    score = (
        F.col("frequency") * FREQUENCY_WEIGHT
        + F.col("recency") * RECENCY_WEIGHT
        + F.col("affinity") * AFFINITY_WEIGHT
        + F.col("season") * SEASON_WEIGHT
    )
    codes = reason_codes(
        code("frequently_ordered_by_customer"),
        code("ordered_recently", F.col("recency") >= RECENT_FROM),
        code("common_for_customer_type", F.col("affinity") >= AFFINITY_FROM),
        code("seasonally_available", F.col("season") >= 1.0),
    )
    return parts.withColumn("score", round6(clamp01(score))).withColumn("reason_codes", codes)


def reorder(
    lines: DataFrame,
    products: DataFrame,
    method: str = FREQUENCY_RECENCY,
    k: int = 3,
    targets: DataFrame | None = None,
    as_of: Column | None = None,
    rolled: DataFrame | None = None,
) -> DataFrame:
    """Top-k reorder list per target customer (every customer with lines when targets is None).

    Customers without history get the popular list under the caller's method name. A caller that runs several methods, or
    discovery too, gives their shared roll-up of the lines (``lines.roll_up``); the lines are then not read.
    """
    if method not in REORDER_METHODS:
        raise ValueError(f"unsupported reorder method: {method}")
    k = max(1, int(k))
    lines = lines if rolled is None else rolled
    own = _for_targets(lines, targets)
    if method == GLOBAL_POPULARITY:
        customers = customer_types(own)
        if targets is not None:
            customers = targets.select("customer_id").join(customers, "customer_id", "left")
        return popular_for(customers, lines, products, k, method, cold=False)

    if method == USER_FREQUENCY:
        ranked_rows = _user_frequency(own, lines, products, k)
    else:
        scored = score_frequency_recency(own, lines, products, next_day(lines) if as_of is None else as_of)
        ranked_rows = top_k(scored, ["customer_id"], [F.desc("score"), F.asc("product_id")], k)
    result = ranked_rows.withColumn("method", F.lit(method)).select(*COLUMNS)
    if targets is None:
        return result
    cold = customers_without_history(targets.select("customer_id"), lines)
    return result.unionByName(popular_for(cold, lines, products, k, method, cold=True))


def flat_export(recs: DataFrame) -> DataFrame:
    """Reorder rows with codes joined by a bar and the sentence added."""
    return recs.select(
        *[c for c in COLUMNS if c != "reason_codes"],
        joined(F.col("reason_codes")).alias("reason_codes"),
        reason_text(F.col("reason_codes"), REORDER_WORDING, REORDER_DEFAULT).alias("reason_text"),
    )
