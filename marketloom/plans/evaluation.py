"""Offline evaluation: temporal split, reorder and discovery metrics, the fairness study."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round6
from ..operators import discovery as D
from ..operators import reorder as R
from ..operators.fairness import ALPHAS, exposure_share, fair_rerank
from ..operators.lines import next_day, order_lines
from ..operators.ranking import ranked
from ..session import cut
from ..sources.tables import Tables


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def split_boundary(lines: DataFrame, train_ratio: float = 0.80) -> Column:
    """The last training order, as a scalar (order_date, order_id).

    Orders per date give the boundary date by a running total over the (few) dates; only the orders
    of that one date are ranked, spread over tasks by id range.
    """
    orders = cut(lines.select("order_id", "order_date").distinct())
    per_date = orders.groupBy("order_date").agg(F.count("*").alias("n"))
    dates = ranked(per_date, [], [F.asc("order_date")], total_of="n")
    total = orders.select(F.count("*")).scalar()
    # At least one order on either side; a single order is a test order.
    wanted = F.least(F.greatest(F.floor(total * F.lit(float(train_ratio))), F.lit(1)), total - 1)
    at = dates.filter((F.col("running") >= wanted) & (F.col("running") - F.col("n") < wanted))
    inside = ranked(orders.join(at.select("order_date", F.col("running").alias("_end"), "n"), "order_date"), ["order_date"], [F.asc("order_id")])
    last = inside.filter(F.col("_end") - F.col("n") + F.col("rank") == wanted)
    return last.select(F.struct("order_date", "order_id")).scalar()


def temporal_split(lines: DataFrame, train_ratio: float = 0.80) -> tuple[DataFrame, DataFrame]:
    """(train, test) lines: the first share of the orders by date and id, and the rest.

    The split is a comparison with the boundary order, so no order list is joined to the lines.
    """
    boundary = split_boundary(lines, train_ratio)
    is_train = F.coalesce(F.struct("order_date", "order_id") <= boundary, F.lit(False))
    return lines.filter(is_train), lines.filter(~is_train)


def future_unseen(test: DataFrame, train_history: DataFrame) -> DataFrame:
    """Test purchases (customer, product) the customer had not made in training."""
    return D.purchase_pairs(test).join(train_history, ["customer_id", "product_id"], "left_anti")


def score_lists(recs: DataFrame, actual: DataFrame, group: list[str], k: int) -> DataFrame:
    """Per group and target customer: hits, precision, recall and hit flag.

    ``actual`` holds the true (customer, product) rows. Groups come from ``recs``; customers without
    recommendations count as zeros.
    """
    targets = actual.groupBy("customer_id").agg(F.count("*").alias("actual"))
    hits = recs.select(*group, "customer_id", "product_id").distinct().join(
        actual.select("customer_id", "product_id"), ["customer_id", "product_id"], "left_semi"
    ).groupBy(*group, "customer_id").agg(F.count("*").alias("hits"))
    return hits.join(targets, "customer_id").select(
        *group, "customer_id", "hits",
        (F.col("hits") / F.lit(float(k))).alias("precision"),
        (F.col("hits") / F.col("actual")).alias("recall"),
    )


def list_metrics(recs: DataFrame, actual: DataFrame, group: list[str], k: int, tables: Tables) -> DataFrame:
    """Precision, recall, hit rate, coverage, diversity and largest producer share per group."""
    customers = actual.select(F.countDistinct("customer_id")).scalar()
    total_products = tables.products.select(F.countDistinct("product_id")).scalar()
    total_producers = tables.producers.select(F.countDistinct("producer_id")).scalar()
    hit = score_lists(recs, actual, group, k).groupBy(*group).agg(
        F.sum("precision").alias("_p"), F.sum("recall").alias("_r"), F.count("*").alias("_h")
    )
    spread = recs.groupBy(*group).agg(
        F.countDistinct("product_id").alias("unique_products"), F.countDistinct("producer_id").alias("unique_producers")
    )
    shares = exposure_share(recs, group).groupBy(*group).agg(
        F.max("recommendation_share").alias("_largest"), F.avg("recommendation_share").alias("_mean")
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    joined = spread.join(shares, group, "left").join(hit, group, "left")
    return joined.select(
        *group,
        round6(ratio(zero(F.col("_p")), customers)).alias("precision_at_k"),
        round6(ratio(zero(F.col("_r")), customers)).alias("recall_at_k"),
        round6(ratio(zero(F.col("_h")), customers)).alias("hit_rate_at_k"),
        "unique_products",
        "unique_producers",
        total_products.alias("total_products"),
        total_producers.alias("total_producers"),
        round6(ratio(F.col("unique_products"), total_products)).alias("product_coverage"),
        round6(ratio(F.col("unique_producers"), total_producers)).alias("producer_diversity"),
        round6(zero(F.col("_largest"))).alias("largest_producer_recommendation_share"),
        round6(zero(F.col("_mean"))).alias("mean_producer_exposure_share"),
        customers.alias("evaluated_customers"),
    )


def _with_all_groups(metrics: DataFrame, group: str, names: list[str]) -> DataFrame:
    """A row of zeros for every method that recommended nothing."""
    spark = metrics.sparkSession
    every = spark.createDataFrame([(n,) for n in names], f"{group} string")
    filled = every.join(metrics, group, "left")
    return filled.na.fill(0)


def novelty(recs: DataFrame, train_history: DataFrame, group: list[str]) -> DataFrame:
    """Per group and customer: share of recommended products not bought in training."""
    seen = train_history.select("customer_id", "product_id", F.lit(1).alias("_seen"))
    rows = recs.select(*group, "customer_id", "product_id").distinct().join(seen, ["customer_id", "product_id"], "left")
    return rows.groupBy(*group, "customer_id").agg(F.avg(F.when(F.col("_seen").isNull(), 1.0).otherwise(0.0)).alias("novelty"))


def with_code(recs: DataFrame, codes: list[str], group: list[str], out: str) -> DataFrame:
    """Per group: customers with at least one recommendation that carries one of the codes."""
    marked = recs.filter(F.arrays_overlap("reason_codes", F.array(*[F.lit(c) for c in codes])))
    return marked.groupBy(*group).agg(F.countDistinct("customer_id").alias(out))


@dataclass
class Evaluation:
    """Result tables of one evaluation run."""

    metrics: DataFrame
    recommendations: DataFrame
    producer_share: DataFrame


@dataclass
class Split:
    """A dataset cut in time: lines, training basis and test purchases, each made once."""

    tables: Tables
    train: DataFrame
    test_products: DataFrame
    customers: DataFrame
    basis: D.Basis
    as_of: Column


def prepare(tables: Tables, train_ratio: float = 0.80) -> Split:
    lines = order_lines(tables)
    train, test = temporal_split(lines, train_ratio)
    as_of = next_day(lines)
    # Training lines are read by every method, so the columns they need are written once.
    columns = ["order_id", "customer_id", "customer_type", "order_date", "product_id", "quantity", "category"]
    train = cut(train.select(*columns))
    bought = cut(D.purchase_pairs(test))
    return Split(tables, train, bought, bought.select("customer_id").distinct(), D.Basis(train, tables.products, as_of), as_of)


def evaluate_reorder(tables: Tables, k: int = 3, methods: list[str] | None = None, split: Split | None = None) -> Evaluation:
    """Reorder methods on test purchases; history is the training part, the catalogue unfiltered."""
    methods = methods or R.REORDER_METHODS
    s = split or prepare(tables)
    # A split that is shared with discovery has the roll-up anyway; for these methods alone it would not pay.
    rolled = s.basis.rolled if split else None
    recs = cut(_union([R.reorder(s.train, tables.products, m, k, s.customers, s.as_of, rolled) for m in methods]))
    metrics = list_metrics(recs, s.test_products, ["method"], k, tables)
    cold = with_code(recs, ["cold_start_fallback"], ["method"], "cold_start_fallback_count")
    full = _with_all_groups(metrics.join(cold, "method", "left"), "method", methods)
    return Evaluation(full, recs, exposure_share(recs, ["method"]))


def evaluate_discovery(tables: Tables, k: int = 3, methods: list[str] | None = None, split: Split | None = None) -> Evaluation:
    """Discovery methods on test purchases that are new to the customer."""
    methods = methods or D.DISCOVERY_METHODS
    s = split or prepare(tables)
    unseen = cut(s.test_products.join(s.basis.history, ["customer_id", "product_id"], "left_anti"))
    eligible = unseen.select("customer_id").distinct()
    recs = cut(_union_methods(s, methods, k, eligible))
    metrics = list_metrics(recs, unseen, ["method_run"], k, tables)
    new = novelty(recs, s.basis.history, ["method_run"]).groupBy("method_run").agg(F.sum("novelty").alias("_novelty"))
    fallback = with_code(
        recs, ["cold_start_discovery_fallback", "insufficient_new_discovery_candidates"], ["method_run"], "fallback_count"
    )
    joined = metrics.join(new, "method_run", "left").join(fallback, "method_run", "left")
    joined = joined.withColumn("novelty_rate", round6(ratio(F.col("_novelty"), F.col("evaluated_customers")))).drop("_novelty")
    full = _with_all_groups(joined, "method_run", methods).withColumnRenamed("method_run", "method")
    shares = exposure_share(recs, ["method_run"]).withColumnRenamed("method_run", "method")
    return Evaluation(full.withColumnRenamed("evaluated_customers", "eligible_customer_count"), recs, shares)


def _union_methods(s: Split, methods: list[str], k: int, eligible: DataFrame) -> DataFrame:
    """Rows of all methods; ``method_run`` names the method asked for, as fallback rows keep their own."""
    return _union([
        D.discover(s.train, s.tables.products, m, k, eligible, s.as_of, s.basis).withColumn("method_run", F.lit(m)) for m in methods
    ])


def coverage_tables(evaluation: Evaluation) -> tuple[DataFrame, DataFrame]:
    """(product coverage, producer diversity) per method."""
    m = evaluation.metrics
    return (
        m.select("method", F.col("unique_products").alias("unique_recommended_products"), "total_products", "product_coverage"),
        m.select("method", F.col("unique_producers").alias("unique_recommended_producers"), "total_producers", "producer_diversity"),
    )


def alpha_study(tables: Tables, k: int = 3, alphas: list[float] | None = None, split: Split | None = None) -> tuple[DataFrame, DataFrame]:
    """(metrics per branch and alpha, share per branch, alpha and producer).

    Candidate lists of 4k are made once per branch and re-ranked for all alphas together.
    """
    alphas = alphas or ALPHAS
    s = split or prepare(tables)
    unseen = cut(s.test_products.join(s.basis.history, ["customer_id", "product_id"], "left_anti"))
    columns = ["branch", "customer_id", "rank", "product_id", "producer_id", "score", "reason_codes"]
    first = R.reorder(s.train, tables.products, R.FREQUENCY_RECENCY, 4 * k, s.customers, s.as_of, s.basis.rolled)
    second = D.discover(s.train, tables.products, D.COOCCURRENCE, 4 * k, unseen.select("customer_id").distinct(), s.as_of, s.basis)
    lists = first.withColumn("branch", F.lit("quick_reorder")).select(*columns).unionByName(
        second.withColumn("branch", F.lit("discovery")).withColumn("score", round6(F.col("score"))).select(*columns)
    )
    chosen = cut(fair_rerank(lists, alphas, k, ["branch"]))
    keys = ["branch", "alpha"]
    parts = [
        list_metrics(chosen.filter(F.col("branch") == branch), actual, keys, k, tables)
        for branch, actual in (("quick_reorder", s.test_products), ("discovery", unseen))
    ]
    metrics = cut(_union(parts))
    base = metrics.filter("alpha = 0").select("branch", F.col("hit_rate_at_k").alias("_base"))
    study = metrics.join(base, "branch", "left").withColumn(
        "recommendation_quality_delta", round6(F.col("hit_rate_at_k") - F.coalesce("_base", "hit_rate_at_k"))
    ).drop("_base")
    return study, exposure_share(chosen, keys)
