import hashlib
import zlib

from marketloom.llm import common, shards
from marketloom.llm.common import table

from .helpers import SF, awkward, documents, empty


def brute(rows, count):
    """doc_id -> (shard, slot) from (doc_id, source) by plain sorting."""
    by = {}
    for i, s in rows:
        by.setdefault(s, []).append((hashlib.md5(f"{shards.SEED}|{i}".encode()).hexdigest(), i))
    order = []
    for s, ids in by.items():
        for r, (_, i) in enumerate(sorted(ids), 1):
            order.append(((2 * r - 1) / (2 * len(ids)), s, r, i))
    order.sort()
    out, slots = {}, {}
    for at, (_, _, _, i) in enumerate(order):
        k = at * count // len(order)
        out[i] = (k, slots.get(k, 0))
        slots[k] = slots.get(k, 0) + 1
    return out


def test_matches_plain_sorting(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", 7)
    docs = table(spark, SF, "documents")
    want = brute([tuple(r) for r in docs.select("doc_id", "source").collect()], 40)
    rows = shards.digest(docs, 40).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in rows} == want
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 16 for r in rows)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_every_shard_matches_the_mixture(spark):
    docs = documents(spark, [(i, "x", "hot" if i % 3 else f"s{i % 5}") for i in range(3000)])
    rows = shards.shard(docs, 10).groupBy("shard", "source").count().collect()
    total = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    assert all(abs(r["count"] - total[r["source"]] / 10) <= 1 for r in rows)


def test_awkward_rows(spark):
    rows = shards.digest(awkward(spark), 3).collect()
    assert len(rows) == 11
    sizes = [sum(r.shard == k for r in rows) for k in range(3)]
    assert max(sizes) - min(sizes) <= 1
    for k in range(3):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (3, 4)} == {(16, 0)}
    assert shards.digest(empty(spark), 40).count() == 0


def test_clashing_columns_pass_through(spark):
    docs = awkward(spark)
    for name in ("n", "rank", "_bucket", "_start", "_order"):
        docs = docs.withColumn(name, docs["n_chars"])
    assert shards.shard(docs.withColumn("slot", docs["n_chars"]), 2).columns == [*docs.columns, "shard", "slot"]
    out = shards.shard(docs, 2, ties=("text",))
    assert out.columns == [*docs.columns, "shard", "slot"] and out.count() == 11


def test_written_shards_hold_their_rows(spark, tmp_path):
    docs = documents(spark, [(i, "x", f"s{i % 2}") for i in range(50)])
    shards.write_shards(shards.shard(docs, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 4
