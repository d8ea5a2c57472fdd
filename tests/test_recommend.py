import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketloom.operators import baskets as B
from marketloom.operators import blocked
from marketloom.operators import demand as M
from marketloom.operators import discovery as D
from marketloom.operators import fairness as X
from marketloom.operators import lines as L
from marketloom.operators import reorder as R
from marketloom.operators.ranking import placed, ranked
from marketloom.plans import evaluation as E
from tests.market import ids, rows, tables


def test_basket_pairs_counts_both_ways(spark):
    pairs = rows(B.basket_pairs(L.order_lines(tables(spark))), "product_a", "product_b", "n")
    assert pairs == [("P000001", "P000002", 1), ("P000002", "P000001", 1)]


def test_large_baskets_split_into_blocks_give_the_same_pairs(spark):
    rng = random.Random(3)
    lines = [(o, rng.randrange(60)) for o in range(12) for _ in range(5 if o % 4 else 55)]
    df = spark.createDataFrame(lines, "order_id long, product_id long")
    want = {}
    for o in range(12):
        for a, b in itertools.permutations({p for x, p in lines if x == o}, 2):
            want[a, b] = want.get((a, b), 0) + 1
    got = {(r.product_a, r.product_b): r.n for r in B.basket_pairs(df, block=7).collect()}
    assert got == want


@pytest.mark.parametrize("method", R.REORDER_METHODS)
def test_roll_up_stands_for_the_lines(spark, method):
    t = tables(spark)
    lines = L.order_lines(t)
    # Repeated purchases, a line without customer and a product without type or category.
    odd = lines.withColumn("customer_id", F.when(F.col("order_id") != "O000004", F.col("customer_id")))
    odd = odd.withColumn("category", F.when(F.col("product_id") != "P000003", F.col("category")))
    rolled = L.roll_up(odd.unionByName(odd))
    wanted = ids(spark, "C000001", "C000002", "C000003", "C000009")
    a = R.flat_export(R.reorder(odd.unionByName(odd), t.products, method, 2, wanted))
    b = R.flat_export(R.reorder(None, t.products, method, 2, wanted, L.next_day(rolled), rolled))
    assert rows(a, *a.columns) == rows(b, *a.columns)
    plan = b._jdf.queryExecution().optimizedPlan().toString()
    assert "unit_price" not in plan and "total_amount" not in plan


def test_reorder_user_frequency_and_cold_start(spark):
    t = tables(spark)
    lines = L.order_lines(t)
    one = R.reorder(lines, t.products, R.USER_FREQUENCY, 1, ids(spark, "C000001"))
    assert rows(one, "product_id", "rank") == [("P000001", 1)]
    cold = R.reorder(lines, t.products, R.FREQUENCY_RECENCY, 2, ids(spark, "C999999")).collect()
    assert len(cold) == 2 and all("cold_start_fallback" in r.reason_codes and r.method == R.FREQUENCY_RECENCY for r in cold)


def test_unlisted_products_leave_rank_gaps_only_where_cut_before_lookup(spark):
    t = tables(spark)
    lines, listed = L.order_lines(t), t.products.filter("product_id <> 'P000001'")
    by_frequency = R.reorder(lines, listed, R.USER_FREQUENCY, 2, ids(spark, "C000001"))
    assert rows(by_frequency, "rank", "product_id") == [(2, "P000002")]
    by_score = R.reorder(lines, listed, R.FREQUENCY_RECENCY, 2, ids(spark, "C000001")).collect()
    assert [(r["rank"], r.product_id) for r in by_score] == [(1, "P000002")]
    # 1 of at most 5 units: the maximum counts the unlisted product.
    assert by_score[0].score < 0.55


def test_unknown_methods_are_errors(spark):
    t = tables(spark)
    with pytest.raises(ValueError):
        R.reorder(L.order_lines(t), t.products, "nope")
    with pytest.raises(ValueError):
        D.discover(L.order_lines(t), t.products, "nope")


def _discovery_fixture(spark):
    data = [("O1", "C1", "P1"), ("O2", "C2", "P1"), ("O2", "C2", "P2"), ("O3", "C3", "P1"), ("O3", "C3", "P3")]
    lines = spark.createDataFrame([(o, c, "family", p, 1.0) for o, c, p in data], "order_id string, customer_id string, customer_type string, product_id string, quantity double")
    lines = lines.withColumn("order_date", F.lit("2026-01-01").cast("date"))
    products = spark.createDataFrame(
        [("P1", "Bread", "food", "PR1", 1, 12), ("P2", "Jam", "food", "PR2", 1, 12), ("P3", "Cream", "food", "PR3", 1, 12)],
        "product_id string, product_name string, category string, producer_id string, seasonal_start_month int, seasonal_end_month int",
    )
    return lines, products


def test_discovery_finds_what_is_bought_together(spark):
    lines, products = _discovery_fixture(spark)
    got = D.discover(lines, products, D.COOCCURRENCE, 2, ids(spark, "C1")).collect()
    assert {r.product_id for r in got} == {"P2", "P3"}
    assert all("new_to_customer" in r.reason_codes and r.based_on == "P1" for r in got)


def test_discovery_falls_back_to_bought_products_when_short(spark):
    t = tables(spark)
    got = D.discover(L.order_lines(t), t.products, D.COOCCURRENCE, 3, ids(spark, "C000001")).collect()
    assert len(got) == 3 and sorted(r["rank"] for r in got) == [1, 2, 3]
    assert any("insufficient_new_discovery_candidates" in r.reason_codes for r in got)
    assert len({r.product_id for r in got}) == 3


@pytest.mark.parametrize("method", [D.SEGMENT_POPULARITY, D.GLOBAL_POPULARITY])
def test_popularity_refill_marks_bought_products(spark, method):
    t = tables(spark)
    got = D.discover(L.order_lines(t), t.products, method, 3, ids(spark, "C000001", "C999999"))
    bought = {r.product_id for r in got.filter("customer_id = 'C000001'").collect() if "insufficient_new_discovery_candidates" in r.reason_codes}
    assert bought == {"P000001", "P000002"}
    assert got.filter("customer_id = 'C999999'").count() == 3


def _greedy(cands, k):
    left = sorted(cands, key=lambda c: (-c[2], c[0]))
    out, used = [], set()
    while left and len(out) < k:
        alt = next((i for i, c in enumerate(left) if c[1] not in used and c[2] >= left[0][2] * 0.70), None)
        repeated = alt is None and left[0][1] in used
        pick = left.pop(alt or 0)
        used.add(pick[1])
        out.append((len(out) + 1, pick[0], bool(alt), repeated))
    return out


def test_diversity_rerank_equals_a_plain_replay_of_the_rule(spark):
    rng = random.Random(11)
    data = {c: [(p, rng.randrange(rng.choice([1, 3, 12])), round(rng.random() ** rng.choice([1, 3]), 2)) for p in range(rng.choice([1, 4, 40]))] for c in range(150)}
    df = spark.createDataFrame(
        [(c, p, pr, s, ["x"], 0.0) for c, cands in data.items() for p, pr, s in cands],
        "customer_id long, product_id long, producer_id long, score double, reason_codes array<string>, diversity_adjustment double",
    )
    for k in (1, 3, 5):
        got = {}
        for r in D.diversity_rerank(df, k).collect():
            got.setdefault(r.customer_id, []).append(
                (r["rank"], r.product_id, "producer_diversity_applied" in r.reason_codes, "limited_diversity_candidates" in r.reason_codes)
            )
        assert {c: sorted(v) for c, v in got.items()} == {c: _greedy(v, k) for c, v in data.items()}


def test_popularity_candidates_hold_every_choice(spark):
    """Lists minus random histories: the trimmed candidates lead to the choice over all products."""
    rng = random.Random(5)
    listed = [("*", p, f"n{p}", rng.randrange(6), 0.5, 1.0, round(rng.random(), 2)) for p in range(40)]
    lists = D.rank_lists(spark.createDataFrame(listed, "list string, product_id long, product_name string, producer_id long, popularity double, season double, score double"))
    # Half of the histories hold the best of the list, to touch many producers.
    best = [p for *_, p in sorted((-x[6], x[1]) for x in listed)]
    bought = {c: set(best[: rng.randrange(25)]) if c % 2 else set(rng.sample(range(40), rng.randrange(30))) for c in range(60)}
    history = spark.createDataFrame([(c, p) for c, ps in bought.items() for p in ps], "customer_id long, product_id long")
    customers = spark.createDataFrame([(c, "*") for c in bought], "customer_id long, list string")
    k = 4
    found = D.popularity_candidates(customers, history, lists, k).withColumn("reason_codes", F.array(F.lit("x"))).withColumn("diversity_adjustment", F.lit(0.0))
    got = {}
    for r in D.diversity_rerank(found, k).collect():
        got.setdefault(r.customer_id, []).append((r["rank"], r.product_id))
    want = {c: [x[:2] for x in _greedy([(p, pr, s) for _, p, _, pr, _, _, s in listed if p not in ps], k)] for c, ps in bought.items()}
    assert {c: sorted(v) for c, v in got.items()} == want


def test_ranked_is_exact_with_one_hot_group(spark):
    rng = random.Random(2)
    data = [("hot" if i % 10 else f"g{i % 7}", rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v long, id long")
    got = {r.id: (r["rank"], r.running) for r in ranked(df, ["g"], [F.asc("v"), F.asc("id")], total_of="v").collect()}
    for g in {x[0] for x in data}:
        total = 0
        for n, (_, v, i) in enumerate(sorted((x for x in data if x[0] == g), key=lambda x: (x[1], x[2])), start=1):
            total += v
            assert got[i] == (n, total)


def test_fair_rerank_alpha_zero_keeps_the_prefix(spark):
    cands = [("c", i + 1, f"p{i}", "A" if i < 4 else "B", s, ["x"]) for i, s in enumerate([0.9, 0.8, 0.85, 0.7, 0.69, 0.2])]
    df = spark.createDataFrame(cands, "customer_id string, rank int, product_id string, producer_id string, score double, reason_codes array<string>")
    got = X.fair_rerank(df, [0.0, 0.3], 3)
    assert rows(got.filter("alpha = 0"), "rank", "product_id", "score") == [(1, "p0", 0.9), (2, "p1", 0.8), (3, "p2", 0.85)]
    fair = rows(got.filter("alpha > 0"), "rank", "product_id")
    assert fair == [(1, "p0"), (2, "p2"), (3, "p1")]
    assert all("producer_fair_reranking_applied" in r.reason_codes for r in got.filter("alpha > 0").collect())


def test_select_alpha_prefers_the_smallest_that_helps(spark):
    study = spark.createDataFrame(
        [("a", 0.0, 0.5, 0.0), ("a", 0.05, 0.5, 0.0), ("a", 0.1, 0.4, -0.02), ("a", 0.2, 0.3, -0.1), ("b", 0.0, 0.3, 0.0), ("b", 0.1, 0.4, 0.0)],
        "branch string, alpha double, largest_producer_recommendation_share double, recommendation_quality_delta double",
    )
    assert rows(X.select_alpha(study), "branch", "alpha") == [("a", 0.1), ("b", 0.0)]


def test_temporal_split_and_metrics(spark):
    t = tables(spark)
    train, test = E.temporal_split(L.order_lines(t))
    assert (train.select("order_id").distinct().count(), test.select("order_id").distinct().count()) == (4, 2)
    one = L.order_lines(t).filter("order_id = 'O000001'")
    assert [x.count() for x in E.temporal_split(one)] == [0, 2]
    result = E.evaluate_reorder(t)
    metrics = result.metrics.collect()
    assert {m.method for m in metrics} == set(R.REORDER_METHODS)
    assert all(0 <= m[c] <= 1 for m in metrics for c in ("precision_at_k", "recall_at_k", "hit_rate_at_k", "product_coverage"))
    totals = result.producer_share.groupBy("method").agg(F.sum("recommendation_share").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in totals)
    found = E.evaluate_discovery(t)
    assert {m.method for m in found.metrics.collect()} == set(D.DISCOVERY_METHODS)


def test_results_do_not_depend_on_partitioning(spark):
    t = tables(spark)
    shuffled = t.with_(order_items=t.order_items.repartition(3, "quantity"))
    first = R.flat_export(R.reorder(L.order_lines(t), t.products, R.FREQUENCY_RECENCY, 3))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        second = R.flat_export(R.reorder(L.order_lines(shuffled), t.products, R.FREQUENCY_RECENCY, 3))
        assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_demand_average_uses_observed_weeks(spark):
    from datetime import date

    t = tables(spark)
    weeks = [("2026-01-05", 1.0), ("2026-01-12", 2.0), ("2026-02-09", 4.0), ("2026-02-16", 8.0)]
    lines = spark.createDataFrame([("PR", "P", "Name", date.fromisoformat(d), q) for d, q in weeks], "producer_id string, product_id string, product_name string, order_date date, quantity double")
    trend = M.demand_trend(lines)
    assert [r.moving_average_3w for r in trend.orderBy("week_start").collect()] == [1.0, 1.5, 2.3333, 4.6667]
    assert [r.trend_direction for r in trend.orderBy("week_start").collect()] == ["stable", "up", "up", "up"]
    last = M.demand_forecast(trend).first()
    assert (str(last.forecast_week_start), last.predicted_quantity_next_week) == ("2026-02-23", 4.67)
    requested = spark.createDataFrame([("PR",), ("PX",)], "producer_id string")
    known, unknown = M.producer_forecast_lookup(M.demand_forecast(trend), requested, t.producers.limit(0).unionByName(spark.createDataFrame([("PR", "n", "a")], t.producers.schema)))
    assert rows(known, "alert_text") == [("High demand expected for Name next week based on recent order trends.",)]
    assert rows(unknown, "producer_id") == [("PX",)]


@pytest.mark.parametrize("seed", range(4))
def test_what_can_be_in_a_shortlist_is_kept(seed):
    """Against a plain shortlist over all candidates, with many ties and producers of very different size."""
    rng = np.random.default_rng(seed)
    for k in (1, 3, 5):
        kept, all_ = [], []
        for c in range(40):
            n = int(rng.choice([1, 3, 40, 900]))
            score = np.round(rng.random(n) ** 2, int(rng.choice([1, 2, 7])))
            producer = rng.integers(0, int(rng.choice([1, 2, 30])), n)
            some = D.high_enough(score, producer, k)
            all_ += [(c, p, int(producer[p]), float(np.rint(score[p] * 1e6))) for p in range(n)]
            kept += [(c, int(p), int(producer[p]), float(score[p])) for p in some]
        columns = [np.array(x) for x in zip(*kept)]
        near = {r[:2] for r, fit in zip(kept, D.reachable(*columns, k)) if fit}
        for c in range(40):
            own = sorted((-s, p, m) for w, p, m, s in all_ if w == c)
            heads = list({m: (s, p) for s, p, m in reversed(own)}.values())
            want = {p for _, p, _ in own[:k]} | {p for _, p in sorted(heads)[:k]}
            assert {(c, p) for p in want} <= near
        assert len(near) <= 40 * 2 * k + 40


def test_blocked_sums_equal_a_plain_loop(spark, monkeypatch):
    """Small blocks, rows and batches; a customer who bought everything, a product that everyone bought, text ids."""
    monkeypatch.setattr(blocked, "NEIGHBOURS", 7)
    monkeypatch.setattr(blocked, "WAITING", 50)
    rng = random.Random(4)
    history = {(f"c{c}", f"p{p:02d}") for c in range(150) for p in rng.sample(range(60), 4)} | {("c0", f"p{p:02d}") for p in range(60)} | {(f"c{c}", "p07") for c in range(150)}
    pairs = {(a, b): rng.randint(1, 5) for a in range(50) for b in range(a) if rng.random() < 0.4}
    edges = [(f"p{a:02d}", f"p{b:02d}", n) for (x, y), n in pairs.items() for a, b in ((x, y), (y, x))]
    want = {}
    for c, a in history:
        for x, b, n in edges:
            if x == a:
                want[c, b] = want.get((c, b), 0) + n
    got = B.history_x_cooccurrence(spark.createDataFrame(sorted(history), "customer_id string, product_id string"), spark.createDataFrame(edges, "product_a string, product_b string, n bigint"))
    assert {(r.customer_id, r.product_id): r.raw for r in got.collect()} == want
    nothing = B.history_x_cooccurrence(spark.createDataFrame([], "customer_id string, product_id string"), spark.createDataFrame(edges, "product_a string, product_b string, n bigint"))
    assert nothing.count() == 0


def test_attributes_go_to_a_few_blocks_for_each_core(spark):
    """Every block gets the attributes of all products, so the number of blocks must not grow with the customers."""
    customers = spark.range(50_000).withColumnRenamed("id", "customer_id")
    history = customers.withColumn("product_id", F.col("customer_id") % 10)
    edges = spark.createDataFrame([(a, b, 1) for a in range(10) for b in range(10) if a != b], "product_a long, product_b long, n long")
    products = spark.range(10).withColumnRenamed("id", "product_id")

    def finish(block):
        yield pa.RecordBatch.from_arrays([pa.array([sum(len(b) for b in block.customers)])], names=["customers"])

    held = [r.customers for r in blocked.blocked_product(history, edges, customers, products, finish, "customers long").collect()]
    assert sum(held) == 50_000 and len(held) <= 3 * spark.sparkContext.defaultParallelism


def test_discovery_names_the_three_products_with_most_shared_baskets(spark):
    baskets = [("P1", "P9")] * 3 + [("P2", "P9")] * 2 + [("P3", "P9"), ("P4", "P9"), ("P5", "P8")]
    data = [(f"O{i}", f"D{i}", p) for i, b in enumerate(baskets) for p in b] + [(f"X{p}", "C1", f"P{p}") for p in range(1, 6)]
    lines = spark.createDataFrame([(o, c, "family", p, 1.0) for o, c, p in data], "order_id string, customer_id string, customer_type string, product_id string, quantity double")
    lines = lines.withColumn("order_date", F.lit("2026-01-01").cast("date"))
    products = spark.createDataFrame(
        [(f"P{i}", f"name {i}", "food", f"PR{i}", 1, 12) for i in range(1, 10)],
        "product_id string, product_name string, category string, producer_id string, seasonal_start_month int, seasonal_end_month int",
    )
    for catalogue in (products, products.unionByName(products.filter("product_id = 'P1'"))):
        got = D.discover(lines, catalogue, D.COOCCURRENCE, 2, ids(spark, "C1"))
        assert rows(got, "product_id", "based_on") == [("P8", "P5"), ("P9", "P1|P2|P3")]


@pytest.mark.parametrize("rows", [1, 10**6])
def test_measured_ranks_are_exact(spark, rows):
    data = [(i, i % 3, (i * 7) % 101) for i in range(101)]
    df = spark.createDataFrame(data, "id long, g long, v long")
    got = {r.id: r["rank"] for r in placed(df, ["g"], [F.asc("v")], rows=rows).collect()}
    for g in range(3):
        order = sorted((v, i) for i, gg, v in data if gg == g)
        assert all(got[i] == at + 1 for at, (_, i) in enumerate(order))


def test_shuffle_partitions_grow_with_the_lines(spark, monkeypatch):
    from marketloom import session

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        L.order_lines(tables(spark))
        assert spark.conf.get(key) == before
        spark.conf.set(key, "2")
        monkeypatch.setattr(session, "PARTITION_ROWS", 2)
        assert L.order_lines(tables(spark)).count() == 7 and spark.conf.get(key) == "4"
    finally:
        spark.conf.set(key, before)


def test_scores_read_the_lines_once_for_stats_and_types(spark):
    lines, products = _discovery_fixture(spark)
    untold = lines.withColumns({"category": F.lit("food"), "product_id": F.when(F.col("order_id") != "O1", F.col("product_id"))})
    scored = R.score_frequency_recency(untold, untold, products, F.lit("2026-01-02").cast("date"))
    assert rows(scored, "customer_id", "customer_type", "product_id") == [("C2", "family", "P1"), ("C2", "family", "P2"), ("C3", "family", "P1"), ("C3", "family", "P3")]
    # With the catalogue, the affinity and its maximum; the types need none of their own.
    joins = scored._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins == 3, joins
