"""Discovery recommendations: products a customer has not bought, spread over producers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import clamp01, flag, round6
from ..functions.reasons import DISCOVERY_DEFAULT, DISCOVERY_WORDING, code, joined, reason_codes, reason_text
from ..functions.seasons import seasonal_flag
from ..session import cut
from .baskets import basket_pairs
from .blocked import Block, blocked_product
from .lines import customer_types, keyed, product_popularity, roll_up, segment_popularity
from .ranking import placed, top_k

COOCCURRENCE = "co_occurrence_discovery"
SEGMENT_POPULARITY = "segment_popularity_discovery"
GLOBAL_POPULARITY = "global_popularity_discovery"
DISCOVERY_METHODS = [COOCCURRENCE, SEGMENT_POPULARITY, GLOBAL_POPULARITY]

# Score weights and the producer-diversity rule.
POPULARITY_WEIGHT = 0.85
POPULARITY_SEASON_WEIGHT = 0.15
COOCCURRENCE_WEIGHT = 0.82
SEGMENT_WEIGHT = 0.10
COOCCURRENCE_SEASON_WEIGHT = 0.08
DIVERSITY_KEEP = 0.70
DIVERSITY_BONUS = 0.03

COLUMNS = [
    "customer_id", "customer_type", "method", "rank", "product_id", "product_name", "producer_id", "score",
    "cooccurrence", "seasonality", "segment_popularity", "diversity_adjustment", "based_on", "reason_codes",
]


def purchase_pairs(lines: DataFrame) -> DataFrame:
    """Distinct (customer, product) of the lines."""
    return keyed(lines).select("customer_id", "product_id").distinct()


class Basis:
    """What discovery reads from order lines, each made once and shared by all methods.

    Lines are scanned twice: for one roll-up by customer, product, type and category, from which purchases, sales, types and the last
    day follow, and for baskets. Both are far smaller than the lines and are read many times, so they are written to
    the shared folder.
    """

    def __init__(self, lines: DataFrame, products: DataFrame, as_of: Column | None = None):
        self.lines, self.products = lines, products
        self.given = as_of

    @cached_property
    def rolled(self) -> DataFrame:
        return roll_up(self.lines)

    @cached_property
    def as_of(self) -> Column:
        """The day after the last order, unless given: one date, looked up once."""
        return F.date_add(F.lit(self.rolled.agg(F.max("order_date")).first()[0]).cast("date"), 1) if self.given is None else self.given

    @cached_property
    def history(self) -> DataFrame:
        """Distinct (customer, product). Without the type, whose smallest text can only be found by sorting."""
        return cut(purchase_pairs(self.rolled))

    @cached_property
    def types(self) -> DataFrame:
        """One row per customer with purchases; there are few distinct types of a customer to look through."""
        return cut(customer_types(keyed(self.rolled).select("customer_id", "customer_type").distinct()))

    @cached_property
    def sales(self) -> DataFrame:
        """Quantity per customer type and product (the type may be null)."""
        sold = self.rolled.filter(F.col("product_id").isNotNull())
        return cut(sold.groupBy("customer_type", "product_id").agg(F.sum("quantity").alias("quantity")))

    @cached_property
    def edges(self) -> DataFrame:
        return cut(basket_pairs(self.lines))

    @cached_property
    def everyone(self) -> DataFrame:
        """The ranked popularity list of all customers, under the name ``*``."""
        return cut(rank_lists(popularity_list(self.sales, self.products, self.as_of, by_segment=False)))

    @cached_property
    def lists(self) -> DataFrame:
        """The ranked popularity lists of all customers and of each customer type."""
        segments = popularity_list(self.sales, self.products, self.as_of, by_segment=True)
        return cut(rank_lists(popularity_list(self.sales, self.products, self.as_of, by_segment=False).unionByName(segments)))


# --- greedy producer-diverse choice --------------------------------------------------------------


def shortlist(candidates: DataFrame, k: int) -> DataFrame:
    """Per customer the at most 2k candidates the greedy choice can ever look at.

    In k steps the best remaining candidate is always among the first k, and the first candidate
    of an unused producer is always the best of one of the first k producers, so the first k rows
    and the best rows of the first k producers are enough. Needs customer_id, producer_id,
    product_id and score. The three windows are all satisfied by one shuffle by customer.
    """
    order = [F.desc("score"), F.asc("product_id")]
    customer = Window.partitionBy("customer_id")
    return (
        candidates.withColumn("_place", F.row_number().over(customer.orderBy(*order)))
        .withColumn("_in_producer", F.row_number().over(Window.partitionBy("customer_id", "producer_id").orderBy(*order)))
        .filter((F.col("_place") <= k) | (F.col("_in_producer") == 1))
        .withColumn("_heads", F.sum(flag(F.col("_in_producer") == 1)).over(customer.orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)))
        .filter((F.col("_place") <= k) | (F.col("_heads") <= k))
        .drop("_place", "_in_producer", "_heads")
    )


def _once(values: list[Column], use: Callable[..., Column]) -> Column:
    """``use(*values)`` with each value computed once: a plain Column in a lambda is computed wherever it is named."""
    held = F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    return F.get(F.transform(F.array(held), lambda h: use(*[h[f"v{i}"] for i in range(len(values))])), F.lit(0))


def diversity_rerank(candidates: DataFrame, k: int, keep: float = DIVERSITY_KEEP, bonus: float = DIVERSITY_BONUS) -> DataFrame:
    """Greedy choice of k candidates per customer that prefers producers not used yet.

    Each step takes the first candidate of an unused producer whose score is at least ``keep``
    times the best remaining one, else the best remaining one. A candidate that jumped ahead gets
    the bonus; a repeated producer is marked. The state is the shortlist, so at most 2k entries.
    """
    fields = [c for c in candidates.columns if c != "customer_id"]
    entry = F.struct(
        (-F.col("score")).alias("order"), "product_id", "producer_id", F.col("score").alias("base"),
        F.lit(0).alias("jumped"), F.lit(0).alias("repeated"), F.struct(*fields).alias("row"),
    )
    lists = shortlist(candidates, k).groupBy("customer_id").agg(F.array_sort(F.collect_list(entry)).alias("left"))
    start = F.struct(F.col("left").alias("left"), F.slice("left", 1, 0).alias("chosen"))

    def step(state: Column, _: Column) -> Column:
        left, chosen = state["left"], state["chosen"]
        best = F.get(left, F.lit(0))

        def look(used: Column, least: Column) -> Column:
            is_used = lambda c: F.coalesce(F.array_contains(used, c["producer_id"]), F.lit(False))
            fresh = F.get(F.filter(left, lambda c: ~is_used(c) & (c["base"] >= least)), F.lit(0))
            return _once([fresh], lambda fresh: _once([F.coalesce(fresh, best)], lambda pick: go_on(fresh, pick, is_used)))

        def go_on(fresh: Column, pick: Column, is_used: Callable[[Column], Column]) -> Column:
            jumped = fresh.isNotNull() & (fresh["product_id"] != best["product_id"])
            marked = F.struct(
                *[pick[c].alias(c) for c in ("order", "product_id", "producer_id", "base")],
                flag(jumped).alias("jumped"), flag(fresh.isNull() & is_used(best)).alias("repeated"), pick["row"].alias("row"),
            )
            return F.struct(
                F.filter(left, lambda c: c["product_id"] != pick["product_id"]).alias("left"),
                F.concat(chosen, F.array(marked)).alias("chosen"),
            )

        used = F.transform(chosen, lambda c: c["producer_id"])
        return F.when(F.size(left) == 0, state).otherwise(_once([used, best["base"] * keep], look))

    chosen = lists.select("customer_id", F.aggregate(F.sequence(F.lit(1), F.lit(k)), start, step)["chosen"].alias("chosen"))
    picks = chosen.select("customer_id", F.posexplode("chosen").alias("_at", "c")).select(
        "customer_id", (F.col("_at") + 1).alias("rank"), "c.row.*",
        (F.col("c.jumped") == 1).alias("_jumped"), (F.col("c.repeated") == 1).alias("_repeated"),
    )
    marks = F.array_compact(
        F.array(code("limited_diversity_candidates", F.col("_repeated")), code("producer_diversity_applied", F.col("_jumped")))
    )
    return (
        picks.withColumn("score", F.when(F.col("_jumped"), F.least(F.lit(1.0), F.col("score") + bonus)).otherwise(F.col("score")))
        .withColumn("diversity_adjustment", F.when(F.col("_jumped"), F.lit(bonus)).otherwise(F.col("diversity_adjustment")))
        .withColumn("reason_codes", F.array_distinct(F.concat("reason_codes", marks)))
        .drop("_jumped", "_repeated")
    )


# --- popularity lists ----------------------------------------------------------------------------


def popularity_list(sales: DataFrame, products: DataFrame, as_of: Column, by_segment: bool) -> DataFrame:
    """Sold products in the catalogue with their popularity score, for all customers or per type."""
    source = segment_popularity(sales) if by_segment else product_popularity(sales).withColumn("customer_type", F.lit("*"))
    listed = source.select("customer_type", "product_id", "popularity").join(
        products.select("product_id", "product_name", "producer_id", "seasonal_start_month", "seasonal_end_month"), "product_id"
    )
    season = seasonal_flag(F.month(as_of), F.col("seasonal_start_month"), F.col("seasonal_end_month"))
    scored = listed.withColumn("season", season)
    score = F.col("popularity") * POPULARITY_WEIGHT + F.col("season") * POPULARITY_SEASON_WEIGHT
    return scored.select(
        F.col("customer_type").alias("list"), "product_id", "product_name", "producer_id", "popularity", "season",
        round6(clamp01(score)).alias("score"),
    )


def rank_lists(popularity: DataFrame) -> DataFrame:
    """Adds each product's place in its list, its place among its producer's products, and - on the
    producer's best product - the producer's place in the list."""
    order = [F.desc("score"), F.asc("product_id")]
    # The lists are small beside the purchases. They are written once to be measured: a list or a producer of more
    # rows than a task should number is spread.
    listed = placed(cut(popularity), ["list"], order, "place")
    # Places are unique per list, so they order a producer's products too.
    listed = placed(listed, ["list", "producer_id"], [F.asc("place")], "producer_place")
    heads = listed.filter("producer_place = 1").select("list", "producer_id", "place")
    heads = placed(heads, ["list"], [F.asc("place")], "producer_rank").select("list", "producer_id", "producer_rank")
    return listed.join(heads, ["list", "producer_id"], "left")


def _unbought_places(taken: DataFrame, place: str, k: int, out: str) -> DataFrame:
    """Per customer the first k places not in ``taken`` (customer_id, place).

    With the taken places of a customer sorted, r_1 < r_2 < ..., the m-th free place is m plus the
    number of i with r_i - i < m. So k counters per customer, kept by a map-side combined
    aggregate, replace any product of customers and places.
    """
    order = Window.partitionBy("customer_id").orderBy(place)
    gap = taken.withColumn("_gap", F.col(place) - F.row_number().over(order))
    counters = [F.count(F.when(F.col("_gap") < m, 1)).alias(f"_m{m}") for m in range(1, k + 1)]
    free = F.array(*[(F.lit(m) + F.coalesce(F.col(f"_m{m}"), F.lit(0))).cast("bigint") for m in range(1, k + 1)])
    return gap.groupBy("customer_id").agg(*counters).select("customer_id", free.alias(out))


def bought_in_lists(customers: DataFrame, history: DataFrame, lists: DataFrame) -> DataFrame:
    """The purchases that are on the customer's list, with their places; as many as the purchases and read several times."""
    return cut(history.join(customers.select("customer_id", "list"), "customer_id").join(
        lists.select("list", "product_id", "producer_id", "place", "producer_place", "producer_rank"), ["list", "product_id"]
    ))


def popularity_candidates(
    customers: DataFrame, history: DataFrame, lists: DataFrame, k: int, exclude_bought: bool = True, bought: DataFrame | None = None
) -> DataFrame:
    """Candidates from popularity lists that the greedy choice can look at, per customer.

    ``customers`` holds (customer_id, list). The result is exact and grows with customers and
    purchases: the first k free places of the list, the best product of the first k producers the
    customer's purchases leave untouched, and the best product left of each producer they touch. A caller that has
    ``bought_in_lists`` of these customers, or of more, gives it as ``bought``.
    """
    if exclude_bought:
        bought = bought_in_lists(customers, history, lists) if bought is None else bought
        # With n places taken, the first k free ones are among the first n + k, so later places need not be sorted.
        most = bought.groupBy("customer_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        free = _unbought_places(bought.filter(F.col("place") < k + most), "place", k, "places")
        # A producer is touched when its best product is bought; the run of bought products from its
        # first on tells which one is the best left.
        in_producer = Window.partitionBy("customer_id", "producer_id").orderBy("producer_place")
        run = bought.withColumn("_n", F.row_number().over(in_producer)).filter("_n = producer_place")
        touched = cut(run.groupBy("customer_id", "list", "producer_id").agg(
            F.max("producer_place").alias("_run"), F.max("producer_rank").alias("producer_rank")
        ))
        producers = _unbought_places(touched, "producer_rank", k, "producer_ranks")
        left_over = touched.join(customers.select("customer_id"), "customer_id", "left_semi").select(
            "customer_id", "list", "producer_id", (F.col("_run") + 1).alias("producer_place")
        )
        wanted = cut(customers.select("customer_id", "list").join(free, "customer_id", "left").join(producers, "customer_id", "left"))
    else:
        wanted = customers.withColumn("places", F.lit(None).cast("array<bigint>")).withColumn(
            "producer_ranks", F.lit(None).cast("array<bigint>")
        )
    default = F.array(*[F.lit(m).cast("bigint") for m in range(1, k + 1)])
    by_place = wanted.select("customer_id", "list", F.explode(F.coalesce("places", default)).alias("place"))
    by_producer = wanted.select("customer_id", "list", F.explode(F.coalesce("producer_ranks", default)).alias("producer_rank"))
    entries = lists.select("list", "place", "producer_place", "producer_rank", "product_id", "product_name", "producer_id", "popularity", "season", "score")
    columns = ["customer_id", "list", "product_id", "product_name", "producer_id", "popularity", "season", "score"]
    heads = entries.filter(F.col("producer_rank").isNotNull() & (F.col("producer_place") == 1))
    found = _looked_up(by_place, entries, ["list", "place"]).select(columns).unionByName(
        _looked_up(by_producer, heads, ["list", "producer_rank"]).select(columns)
    )
    if exclude_bought:
        found = found.unionByName(left_over.join(entries, ["list", "producer_id", "producer_place"]).select(columns))
    return found.dropDuplicates(["customer_id", "product_id"])


def _looked_up(wanted: DataFrame, entries: DataFrame, key: list[str]) -> DataFrame:
    """``wanted`` joined with the entries it names.

    Nearly all customers name the same few places, so the entries named are found first, and written so that their size is known:
    joined by these keys over shuffles, most customers would meet in a few tasks.
    """
    return wanted.join(cut(entries.join(wanted.select(*key).distinct(), key, "left_semi")), key)


def _list_sizes(lists: DataFrame) -> DataFrame:
    return lists.groupBy("list").agg(F.count("*").alias("listed"))


def _with_unbought(customers: DataFrame, bought: DataFrame, lists: DataFrame) -> DataFrame:
    """Per customer: how many products of the list the customer has not bought."""
    counts = bought.groupBy("customer_id").agg(F.count("*").alias("bought"))
    return (
        customers.join(_list_sizes(lists), "list", "left").join(counts, "customer_id", "left")
        .withColumn("unbought", F.coalesce("listed", F.lit(0)) - F.coalesce("bought", F.lit(0))).drop("listed", "bought")
    )


def _marked(found: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates with ``_bought``: whether the customer bought the product before."""
    return found.join(
        history.select("customer_id", "product_id", F.lit(True).alias("_bought")), ["customer_id", "product_id"], "left"
    ).withColumn("_bought", F.coalesce("_bought", F.lit(False)))


def _as_popularity_rows(marked: DataFrame, method: str) -> DataFrame:
    """Candidate rows with components and reasons; needs customer_type, ``refilled`` and ``_bought`` on ``marked``."""
    in_segment = F.col("list") != "*"
    codes = reason_codes(
        F.when(in_segment, F.lit("popular_with_similar_customers")).otherwise(F.lit("globally_popular_product")),
        code("cold_start_discovery_fallback"),
        code("new_to_customer", ~F.col("_bought")),
        code("seasonally_available", F.col("season") >= 1.0),
        code("insufficient_new_discovery_candidates", F.col("_bought") & F.col("refilled")),
    )
    return marked.select(
        "customer_id", "customer_type", F.lit(method).alias("method"),
        "product_id", "product_name", "producer_id", "score",
        F.lit(0.0).alias("cooccurrence"),
        (F.col("season") * POPULARITY_SEASON_WEIGHT).alias("seasonality"),
        F.when(in_segment, F.col("popularity")).otherwise(F.lit(0.0)).alias("segment_popularity"),
        F.lit(0.0).alias("diversity_adjustment"),
        F.lit("").alias("based_on"),
        codes.alias("reason_codes"),
    )


def _typed_targets(targets: DataFrame | None, basis: Basis) -> DataFrame:
    return basis.types if targets is None else targets.select("customer_id").distinct().join(basis.types, "customer_id", "left")


def _discover_popular(targets: DataFrame, basis: Basis, method: str, k: int) -> DataFrame:
    history = basis.history
    if method == SEGMENT_POPULARITY:
        # A customer whose type is unknown falls back to the list of all customers.
        lists, customers = basis.lists, targets.withColumn("list", F.coalesce("customer_type", F.lit("*")))
    else:
        lists, customers = basis.everyone, targets.withColumn("list", F.lit("*"))
    customers = cut(customers)
    bought = bought_in_lists(customers, history, lists)
    counted = cut(_with_unbought(customers, bought, lists).withColumn("refilled", F.col("unbought") < k))
    # With fewer than k new products every product of the list counts, bought or not.
    enough, short = counted.filter("not refilled"), counted.filter("refilled")
    found = popularity_candidates(enough, history, lists, k, bought=bought).withColumn("_bought", F.lit(False))
    if not short.isEmpty():
        own = history.join(short.select("customer_id"), "customer_id", "left_semi")
        found = found.unionByName(_marked(popularity_candidates(short, history, lists, k, exclude_bought=False), own))
    found = found.join(counted.select("customer_id", "customer_type", "refilled"), "customer_id")
    return diversity_rerank(_as_popularity_rows(found, method), k)


# --- co-occurrence -------------------------------------------------------------------------------


def high_enough(score: np.ndarray, producer: np.ndarray, k: int) -> np.ndarray:
    """Places, in order, of the scores above a floor under which none of one customer's can be in a shortlist of k.

    Scores from the floor up are those of at least k producers, or all. The floor is looked for among the best few
    scores first. It lies two units of the last rounded place lower, so rounding changes nothing.
    """
    n = len(score)
    few = 16 * k
    while few < n:
        floor = np.partition(score, n - few)[n - few]
        if len(set(producer[score >= floor].tolist())) >= k:
            return np.flatnonzero(score >= floor - 2e-6)
        few *= 8
    return np.arange(n)


def reachable(customer: np.ndarray, product: np.ndarray, producer: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Which candidates (sorted by customer) can be in a shortlist of k, when scores are rounded to 6 places.

    A rounded score is known here up to the way a half is rounded, so each candidate has a lowest and a highest value.
    One is kept if by its highest value it is among the first k by lowest values, or leads its producer and that
    producer the list down to the k-th. Equal scores go by product.
    """
    low, high = np.floor(score * 1e6 + 0.499), np.floor(score * 1e6 + 0.501)

    def at_least(limit: np.ndarray) -> np.ndarray:
        """Whether a candidate's highest value reaches that of candidate ``limit`` (its index; -1: no limit)."""
        return (limit < 0) | (high > low[limit]) | ((high == low[limit]) & (product <= product[limit]))

    def kth(order: np.ndarray) -> np.ndarray:
        """For each candidate the k-th of its customer in ``order`` (indices, sorted by customer), or -1."""
        who = customer[order]
        first = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
        last = np.concatenate((first[1:], [len(who)]))
        limit = np.where(last - first >= k, order[np.minimum(first + k - 1, len(order) - 1)], -1)
        return limit[np.searchsorted(who[first], customer)]

    if not len(customer):
        return np.zeros(0, bool)
    order = np.lexsort((product, -low, customer))
    grouped = np.lexsort((product, -low, producer, customer))
    head = np.concatenate(([True], (customer[grouped][1:] != customer[grouped][:-1]) | (producer[grouped][1:] != producer[grouped][:-1])))
    leader = np.empty(len(customer), np.int64)
    leader[grouped] = grouped[np.maximum.accumulate(np.where(head, np.arange(len(grouped)), 0))]
    heads = grouped[head]
    heads = heads[np.lexsort((product[heads], -low[heads], customer[heads]))]
    return at_least(kth(order)) | (at_least(leader) & at_least(kth(heads)))


class Things:
    """Attributes of the products by number, as a task needs them."""

    def __init__(self, block: Block, kinds: int):
        columns = block.products(["product_id", "listed", "producer_id", "season", *[f"segment_{i}" for i in range(kinds)]])
        self.ids, self.producers = (columns[c].combine_chunks() for c in ("product_id", "producer_id"))
        self.listed = columns["listed"].fill_null(False).to_numpy()
        self.all_listed = bool(self.listed.all())
        self.season = columns["season"].cast("double").fill_null(0.0).to_numpy()
        self.segments = [columns[f"segment_{i}"].fill_null(0.0).to_numpy() for i in range(kinds)]
        self.producer = self.producers.dictionary_encode("encode").indices.to_numpy()
        self.named = self.ids.dictionary_encode()
        self._rest = {}

    def rest(self, kind: int | None) -> np.ndarray:
        """What type and season add to the score, for customers of a type."""
        if kind not in self._rest:
            segment = 0.0 if kind is None else self.segments[kind] * SEGMENT_WEIGHT
            self._rest[kind] = segment + self.season * COOCCURRENCE_SEASON_WEIGHT
        return self._rest[kind]


def _within_reach(block: Block, things: Things, batch: pa.RecordBatch, kind_of: list, found: list[tuple], k: int) -> pa.RecordBatch:
    """The candidates of some customers that can be in a shortlist, with what their exact scores are made from.

    ``found`` holds for each customer (row in the batch, products, sums, largest sum, scores, adjacency rows).
    """
    sizes = [len(f[1]) for f in found]
    at, customer = np.repeat(np.arange(len(found)), sizes), np.repeat([f[0] for f in found], sizes)
    product, raw, score = (np.concatenate([f[i] for f in found]) for i in (1, 2, 4))
    keep = reachable(at, product, things.producer[product], score, k)
    at, customer, product, raw = at[keep], customer[keep], product[keep], raw[keep]
    ends = np.searchsorted(at, np.arange(len(found) + 1))
    texts = _source_texts([(b - a, *block.sources(f[5], product[a:b])) for f, a, b in zip(found, ends, ends[1:])], things.named)
    segment = np.concatenate([
        np.zeros(b - a) if kind_of[f[0]] is None else things.segments[kind_of[f[0]]][product[a:b]] for f, a, b in zip(found, ends, ends[1:])
    ])
    seasons, customer, chosen = things.season[product], pa.array(customer), pa.array(product)
    return pa.RecordBatch.from_arrays([
        *(batch.column(c).take(customer) for c in ("customer_id", "customer_type")), things.ids.take(chosen), things.producers.take(chosen),
        pa.array(raw), pa.array(np.array([f[3] for f in found], np.int64)[at]), pa.array(segment), pa.array(seasons), texts,
    ], names=["customer_id", "customer_type", "product_id", "producer_id", "raw", "_largest", "_segment", "_season", "based_on"])


def cooccurrence_shortlist(targets: DataFrame, basis: Basis, k: int) -> DataFrame:
    """The at most 2k co-occurrence candidates per target customer that a greedy choice of k can look at.

    Sums, largest sum and scores of a block of customers are made in one task (``blocked_product``), which returns the
    candidates within reach (``reachable``) with the products they are based on; the exact scores and the cut are made from
    those. A customer has fewer than k rows only if the customer has fewer than k candidates.
    """
    season = seasonal_flag(F.month(basis.as_of), F.col("seasonal_start_month"), F.col("seasonal_end_month"))
    segment = segment_popularity(basis.sales).select("customer_type", "product_id", F.col("popularity").alias("_segment"))
    # A product brings its score in every customer type along, by the number of the type; types are few.
    kinds = [r[0] for r in basis.sales.filter("customer_type IS NOT NULL").select("customer_type").distinct().collect()]
    number_of = {kind: i for i, kind in enumerate(kinds)}
    of_type = [F.max(F.when(F.col("customer_type") == kind, F.col("_segment"))).alias(f"segment_{i}") for i, kind in enumerate(kinds)]
    by_type = segment.groupBy("product_id").agg(F.count("*").alias("_types"), *of_type).drop("_types")
    listed = basis.products.select("product_id", F.lit(True).alias("listed"), "producer_id", season.alias("season"))
    # All products sold: those with edges and some more, told without a pass over the edges.
    products = basis.sales.select("product_id").distinct().join(listed, "product_id", "left").join(by_type, "product_id", "left")
    wanted = targets.select("customer_id", "customer_type")
    history = basis.history.join(wanted.select("customer_id"), "customer_id", "left_semi")
    types = {c: (wanted if c == "customer_id" else products).schema[c].dataType.simpleString() for c in ("customer_id", "product_id", "producer_id")}

    def finish(block: Block) -> Iterator[pa.RecordBatch]:
        things = None
        for batch, each in block.sums():
            if things is None:
                things = Things(block, len(kinds))
            kind_of = [number_of.get(x) for x in batch.column("customer_type").to_pylist()]
            found, waiting = [], 0
            for customer, product, raw, bought, own in each:
                largest = raw.max()
                # Close enough to tell who is within reach; the exact scores are made from the parts.
                score = raw * (COOCCURRENCE_WEIGHT / largest)
                score += things.rest(kind_of[customer])[product]
                np.clip(score, 0.0, 1.0, out=score)
                score[bought] = -1.0
                score[raw <= 0] = -1.0
                if not things.all_listed:
                    score[~things.listed[product]] = -1.0
                some = high_enough(score, things.producer[product], k)
                some = some[score[some] >= 0]
                if not len(some):
                    continue
                found.append((customer, product[some], raw[some], largest, score[some], own))
                waiting += len(some)
                if waiting > 20_000:
                    yield _within_reach(block, things, batch, kind_of, found, k)
                    found, waiting = [], 0
            if found:
                yield _within_reach(block, things, batch, kind_of, found, k)

    schema = ", ".join([
        f"customer_id {types['customer_id']}, customer_type string, product_id {types['product_id']}, producer_id {types['producer_id']}",
        "raw bigint, _largest bigint, _segment double, _season double, based_on string",
    ])
    near = blocked_product(history, basis.edges, wanted, products, finish, schema).withColumn("_co", F.col("raw") / F.col("_largest"))
    score = F.col("_co") * COOCCURRENCE_WEIGHT + F.col("_segment") * SEGMENT_WEIGHT + F.col("_season") * COOCCURRENCE_SEASON_WEIGHT
    return shortlist(near.withColumn("score", round6(clamp01(score))).drop("raw", "_largest"), k)


def _source_texts(found: list[tuple], ids: pa.DictionaryArray, n: int = 3) -> pa.Array:
    """For each candidate the n bought products that share most baskets with it, smaller ids first on ties, as one text.

    ``found`` holds for each customer (number of candidates, ``Block.sources``). Products are numbered in the order of their
    ids; an id that comes twice in the catalogue has two numbers and is named once.
    """
    before = np.cumsum([0, *[f[0] for f in found]])
    candidate = np.concatenate([f[1] + b for f, b in zip(found, before)])
    source, shared = ids.indices.to_numpy()[np.concatenate([f[2] for f in found])], np.concatenate([f[3] for f in found])
    order = np.lexsort((source, -shared, candidate))
    candidate, source = candidate[order], source[order]
    once = np.concatenate(([True], (candidate[1:] != candidate[:-1]) | (source[1:] != source[:-1])))
    candidate, source = candidate[once], source[once]
    first = np.searchsorted(candidate, np.arange(before[-1] + 1))
    best = np.arange(len(candidate)) - first[candidate] < n
    ends = np.concatenate(([0], np.cumsum(best)))[first]
    names = ids.dictionary.take(pa.array(source[best])).cast(pa.string())
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), names), "|")


def _as_cooccurrence_rows(scored: DataFrame, products: DataFrame) -> DataFrame:
    codes = reason_codes(
        code("commonly_bought_together"), code("similar_basket_pattern"), code("new_to_customer"),
        code("seasonally_available", F.col("_season") >= 1.0),
        code("popular_with_similar_customers", F.col("_segment") > 0),
    )
    return scored.join(products.select("product_id", "product_name"), "product_id").select(
        "customer_id", "customer_type", F.lit(COOCCURRENCE).alias("method"), "product_id", "product_name", "producer_id", "score",
        (F.col("_co") * COOCCURRENCE_WEIGHT).alias("cooccurrence"),
        (F.col("_season") * COOCCURRENCE_SEASON_WEIGHT).alias("seasonality"),
        (F.col("_segment") * SEGMENT_WEIGHT).alias("segment_popularity"),
        F.lit(0.0).alias("diversity_adjustment"), "based_on", codes.alias("reason_codes"),
    )


def fallback_candidates(short: DataFrame, basis: Basis, k: int) -> DataFrame:
    """Popularity candidates for customers with fewer than k co-occurrence candidates.

    ``short`` holds (customer_id, customer_type, found). First the list of the customer's type (all
    customers when it is unknown) without bought products; customers that still have fewer than k
    also get the list of all customers with bought products, which are marked.
    """
    history, lists = basis.history, basis.lists
    customers = short.withColumn("list", F.coalesce("customer_type", F.lit("*")))
    bought = bought_in_lists(customers, history, lists)
    counted = cut(_with_unbought(customers, bought, lists).withColumn("refilled", F.col("found") + F.col("unbought") < k))
    names = counted.select("customer_id", "customer_type", "refilled")

    first = popularity_candidates(counted, history, lists, k, bought=bought).join(names, "customer_id").withColumn("_bought", F.lit(False))
    with_type = _as_popularity_rows(first.filter("list <> '*'"), SEGMENT_POPULARITY)
    without = _as_popularity_rows(first.filter("list = '*'"), GLOBAL_POPULARITY)
    still = counted.filter("refilled").withColumn("list", F.lit("*"))
    second = _marked(popularity_candidates(still, history, lists, k, exclude_bought=False).join(names, "customer_id"), history)
    return (
        with_type.unionByName(without).withColumn("_source", F.lit(1))
        .unionByName(_as_popularity_rows(second, GLOBAL_POPULARITY).withColumn("_source", F.lit(2)))
    )


def discovery_fallback_chain(candidates: DataFrame, targets: DataFrame, basis: Basis, k: int) -> DataFrame:
    """Co-occurrence candidates, filled up for customers that have fewer than k of them.

    One row per customer and product: the best score, the earlier source on a tie. The candidates are read several times, so
    they are written once. When no customer is short - the usual case on a grown history - the popularity lists are not even made.
    """
    candidates = cut(candidates)
    found = candidates.groupBy("customer_id").agg(F.count("*").alias("found"))
    short = cut(
        targets.join(found, "customer_id", "left").withColumn("found", F.coalesce("found", F.lit(0))).filter(F.col("found") < k)
    )
    if short.isEmpty():
        return candidates
    fill = cut(fallback_candidates(short, basis, k))
    # Customers with enough candidates pass through; only short ones are de-duplicated.
    own = candidates.join(short.select("customer_id"), "customer_id", "left_semi").withColumn("_source", F.lit(0))
    merged = top_k(own.unionByName(fill), ["customer_id", "product_id"], [F.desc("score"), F.asc("_source")], 1, "_at")
    full = candidates.join(short.select("customer_id"), "customer_id", "left_anti")
    return full.unionByName(merged.drop("_at", "_source"))


def _discover_cooccurring(targets: DataFrame, basis: Basis, k: int) -> DataFrame:
    near = _as_cooccurrence_rows(cooccurrence_shortlist(targets, basis, k), basis.products)
    filled = discovery_fallback_chain(near, targets, basis, k)
    return diversity_rerank(filled, k)


def discover(
    lines: DataFrame,
    products: DataFrame,
    method: str = COOCCURRENCE,
    k: int = 3,
    targets: DataFrame | None = None,
    as_of: Column | None = None,
    basis: Basis | None = None,
) -> DataFrame:
    """Top-k discovery list per target customer (every customer with lines when targets is None).

    Pass one ``basis`` to run several methods over the same lines.
    """
    if method not in DISCOVERY_METHODS:
        raise ValueError(f"unsupported discovery method: {method}")
    k = max(1, int(k))
    basis = basis or Basis(lines, products, as_of)
    typed = _typed_targets(targets, basis)
    if method == COOCCURRENCE:
        chosen = _discover_cooccurring(typed, basis, k)
    else:
        chosen = _discover_popular(typed, basis, method, k)
    return chosen.select(*COLUMNS)


def flat_export(recs: DataFrame) -> DataFrame:
    """Discovery rows with codes joined by a bar, components rounded and the sentence added."""
    numbers = ["score", "cooccurrence", "seasonality", "segment_popularity", "diversity_adjustment"]
    return recs.select(
        *[round6(F.col(c)).alias(c) if c in numbers else F.col(c) for c in COLUMNS if c != "reason_codes"],
        joined(F.col("reason_codes")).alias("reason_codes"),
        reason_text(F.col("reason_codes"), DISCOVERY_WORDING, DISCOVERY_DEFAULT).alias("reason_text"),
    )
