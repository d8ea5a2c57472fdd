"""What keeps a task's share and the shuffles of the recommenders small on larger tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketloom import session as S
from marketloom.operators import baskets as B
from marketloom.operators import blocked
from marketloom.operators import discovery as D
from marketloom.operators import lines as L
from marketloom.operators import reorder as R
from tests.market import rows, tables


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def conf(spark):
    """Sets session values, and the old ones again afterwards."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    put("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    put(S.ADVISORY_CONF, spark.conf.get(S.ADVISORY_CONF))
    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


def test_partitions_of_large_inputs_are_not_merged_up_to_64_mb(spark, conf):
    conf(S.ADVISORY_CONF, "64MB")
    S.spread(spark.range(S.PARTITION_ROWS))
    assert spark.conf.get(S.ADVISORY_CONF) == "64MB"
    S.spread(spark.range(2 * S.PARTITION_ROWS))
    assert S._megabytes(spark.conf.get(S.ADVISORY_CONF)) == S.PARTITION_MB
    conf(S.ADVISORY_CONF, "1048576b")
    S.spread(spark.range(2 * S.PARTITION_ROWS))
    assert spark.conf.get(S.ADVISORY_CONF) == "1048576b"


def test_basket_pairs_make_the_baskets_once(spark):
    plan = optimized(B.basket_pairs(L.order_lines(tables(spark))))
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and plan.count("Join ") == 4, plan


def test_lines_meet_products_last(spark):
    """Customers join the orders and producers the products, so lines are not shuffled for them."""
    first = next(x for x in optimized(L.order_lines(tables(spark))).splitlines() if "Join " in x)
    assert "product_id" in first, first


def test_scores_stay_together_by_customer(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    t = tables(spark)
    stats = R._typed_stats(L.order_lines(t), R._catalogue(t.products.filter("product_id <> 'P000001'")))
    # The largest quantity counts the product that is not listed.
    assert rows(stats, "customer_id", "product_id", "product_name", "customer_type", "quantity", "_top") == [
        ("C000001", "P000002", "Apples", "family", 1.0, 5.0), ("C000002", "P000003", "Potatoes", "restaurant", 10.0, 10.0),
        ("C000003", "P000002", "Apples", "community_group", 3.0, 3.0),
    ]
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(D.shortlist(stats.withColumn("score", F.col("quantity")), 2)) == exchanges(stats)


def test_candidates_from_purchases_of_more_customers(spark):
    rng = random.Random(7)
    listed = [("*", p, f"n{p}", rng.randrange(5), 0.5, 1.0, round(rng.random(), 2)) for p in range(30)]
    lists = D.rank_lists(spark.createDataFrame(listed, "list string, product_id long, product_name string, producer_id long, popularity double, season double, score double"))
    pairs = [(c, p) for c in range(20) for p in rng.sample(range(30), rng.randrange(25))]
    history = spark.createDataFrame(pairs, "customer_id long, product_id long")
    everyone = spark.range(20).select(F.col("id").alias("customer_id"), F.lit("*").alias("list"))
    some = everyone.filter("customer_id % 3 = 0")
    found = lambda **given: rows(D.popularity_candidates(some, history, lists, 3, **given), "customer_id", "product_id")
    assert found(bought=D.bought_in_lists(everyone, history, lists)) == found()
    assert not set(found()) & set(pairs)


def test_greedy_step_computes_its_pick_once(spark):
    schema = "customer_id long, product_id long, producer_id long, score double, diversity_adjustment double, reason_codes array<string>"
    chosen = D.diversity_rerank(spark.createDataFrame([(1, 1, 1, 0.5, 0.0, ["x"])], schema), 3)
    assert optimized(chosen).count("lambdafunction(") < 40


def test_tasks_map_the_adjacency(spark):
    """Neither adjacency rows nor attributes of products are shuffled to the blocks: a task is given customers and their purchases."""
    history = spark.range(60).selectExpr("id AS customer_id", "id % 7 AS product_id")
    edges = spark.range(49).selectExpr("id % 7 AS product_a", "id DIV 7 AS product_b", "1L AS n").filter("product_a <> product_b")
    products = spark.range(7).selectExpr("id AS product_id", "id * 2 AS producer_id")

    def finish(block):
        for batch, each in block.sums():
            yield pa.RecordBatch.from_arrays([pa.array([",".join(batch.schema.names)]), pa.array([sum(x[2].sum() for x in each)])], names=["columns", "raw"])

    found = blocked.blocked_product(history, edges, history.select("customer_id"), products, finish, "columns string, raw bigint")
    assert "Union" not in optimized(found)
    got = found.collect()
    assert {r.columns for r in got} == {"customer_id,own"} and sum(r.raw for r in got) == 60 * 6


def test_adjacency_rows_hold_every_count(spark, conf, monkeypatch, tmp_path):
    """Small files and rows; counts on either side of those that are written as copies."""
    monkeypatch.setattr(blocked, "NEIGHBOURS", 3)
    monkeypatch.setattr(blocked, "GATHER", 20)
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "25")
    rng = random.Random(3)
    pairs = {(a, b): rng.choice([1, 1, 2, blocked.REPEATED, blocked.REPEATED + 1, 40]) for a in range(12) for b in range(15) if a != b and rng.random() < 0.7}
    edges = spark.createDataFrame([(f"p{a:02d}", f"p{b:02d}", n) for (a, b), n in pairs.items()], "product_a string, product_b string, n long")
    written = str(tmp_path / "things")
    spark.createDataFrame([(f"p{i:02d}", i) for i in range(15)], "product_id string, number int").write.parquet(written)
    near = blocked.adjacency(edges, 15, written)
    assert len(near.files) > 1 and near.products == 15
    many, found = near.rows(np.arange(15, dtype=np.int32))
    assert many.sum() == len(found) and (many[12:] == 0).all()
    got = {}
    for a, to, n in found:
        for i, b in enumerate(to.tolist()):
            got[a, b] = got.get((a, b), 0) + (1 if n is None else int(n[i]))
    assert got == pairs
    assert blocked.adjacency(edges.limit(0), 15, written).rows(np.zeros(1, np.int32))[1] == []


def test_raw_scores_come_by_product(spark):
    """Runs of a product are written in less room than products in turn."""
    history = spark.range(30).selectExpr("id AS customer_id", "id % 5 AS product_id").coalesce(1)
    edges = spark.range(25).selectExpr("id % 5 AS product_a", "id DIV 5 AS product_b", "1L AS n").filter("product_a <> product_b")
    got = B.history_x_cooccurrence(history, edges).withColumn("task", F.spark_partition_id()).collect()
    assert len(got) == 30 * 4
    for task in {r.task for r in got}:
        of = [r.product_id for r in got if r.task == task]
        assert of == sorted(of)


def test_products_of_one_id_have_all_its_pairs(spark, tmp_path):
    written = str(tmp_path / "things")
    spark.createDataFrame([("p0", 0), ("p1", 1), ("p1", 2), ("p2", 3)], "product_id string, number int").write.parquet(written)
    edges = spark.createDataFrame([("p0", "p1", 2), ("p1", "p0", 2), ("p1", "p9", 1), ("p2", "p2", 1)], "product_a string, product_b string, n long")
    _, found = blocked.adjacency(edges, 4, written).rows(np.arange(4, dtype=np.int32))
    assert sorted((a, to.tolist()) for a, to, _ in found) == [(0, [1, 1, 2, 2]), (1, [0, 0]), (2, [0, 0]), (3, [3])]
