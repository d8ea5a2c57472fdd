from pyspark.sql import functions as F

from marketloom.operators import catalog as Ca
from marketloom.operators import orders as O
from marketloom.operators.joins import left_join_keyed


def test_rows_without_a_key_are_dealt_over_the_tasks(spark):
    """Half of the keys null, a quarter blank: none is matched, none is lost, and no task holds most of them."""
    rows = spark.range(8000).selectExpr("id AS seq", "CASE id % 4 WHEN 0 THEN concat('k', id % 7) WHEN 1 THEN ' ' END AS key")
    table = spark.createDataFrame([("k1", 1), ("k2", 2), (" ", 3), (None, 4)], "key string, v int")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", False)
        out = left_join_keyed(rows, table, "key", ["seq"])
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        got = out.collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert out.columns == ["key", "seq", "v"] and len(got) == 8000
    assert all(r.v == {"k1": 1, "k2": 2}.get(r.key) for r in got)
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(tasks) < 1.5 * 8000 / len(tasks)


def test_receipts_count_up_to_each_event(spark):
    events = spark.createDataFrame([(1, "O1", "C", [1, 2]), (2, "O2", "C", None), (5, "O3", "D", [1])], "seq bigint, order_id string, customer_id string, items array<int>")
    got = [tuple(r) for r in O.order_receipts(events).orderBy("seq").collect()]
    assert got == [(1, "ingested", "O1", "C", 2, 1, 2), (2, "ingested", "O2", "C", 0, 2, 2), (5, "ingested", "O3", "D", 1, 3, 3)]
    base = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "producer_id string")
    valid = spark.createDataFrame([(1, "C"), (2, "A"), (3, "C"), (4, "D")], "seq bigint, producer_id string")
    assert [r.catalog_so_far for r in Ca.catalog_receipts(base, valid, "producer_id").orderBy("seq").collect()] == [3, 3, 3, 4]
    assert Ca.catalog_receipts(base, valid.limit(0), "producer_id").count() == 0 and O.order_receipts(events.limit(0)).count() == 0
