import random

import numpy as np
import pytest
import xxhash
from marketloom.llm import simhash
from marketloom.llm.common import table
from marketloom.operators import components as connected_module
from marketloom.session import cut
from pyspark.sql import functions as F

from .helpers import SF, awkward, documents, empty


def plain(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("seed", range(6))
def test_trie_finds_every_link(seed):
    rng = random.Random(seed)
    keys, first = [], []
    for _ in range(5):
        bucket = set()
        for _ in range(8):
            x = rng.getrandbits(64)
            for _ in range(rng.randint(1, 25)):
                y = x
                for b in rng.sample(range(64), rng.randint(0, 5)):
                    y ^= 1 << b
                bucket.add(y)
        keys += sorted(bucket)
        first += [True] + [False] * (len(bucket) - 1)
    k, f = np.array(keys, np.uint64), np.array(first)
    got = simhash.trie_classes(k, f, 4, batch=rng.choice([3, 50, 50_000]))
    edges = [*np.flatnonzero(f), len(k)]
    for a, b in zip(edges, edges[1:]):
        assert [x - a for x in got[a:b]] == classes(keys[a:b], 4)
    x, y = simhash.tree_links(got, np.arange(len(k)))
    assert np.array_equal(simhash.unite(np.arange(len(k)), x, y), got)
    x, y = simhash.tree_links(np.zeros(10_000, np.int64), np.arange(10_000))
    assert np.bincount(np.concatenate((x, y))).max() <= 400 and not simhash.unite(np.arange(10_000), x, y).any()


def test_dense_group_is_near_linear():
    rng = np.random.default_rng(0)
    keys = np.unique(np.array([np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, 4, replace=False).astype(np.uint64)) for _ in range(20_000)]))
    got = simhash.trie_classes(keys, np.arange(len(keys)) == 0, 4)
    assert (got == 0).mean() > 0.999


def test_query_matches_brute_force(spark):
    docs = table(spark, SF, "documents").union(table(spark, SF, "documents").limit(60).withColumn("doc_id", F.col("doc_id") + 1000).withColumn(
        "text", F.concat("text", F.lit(" one two three four five six"))))
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    fps = [plain(t) for _, t in texts]
    want = classes(fps, 4)
    rows = {r.doc_id: r for r in simhash.digest(docs).collect()}
    assert len(rows) == len(texts)
    for (i, _), fp, c in zip(texts, fps, want):
        assert rows[i].fingerprint == f"{fp:016x}" and rows[i].component_id == texts[c][0]


def test_hot_buckets_are_split_without_losing_links(spark):
    rng = random.Random(3)
    fps = list({rng.getrandbits(64) & ~(1 << rng.randrange(64)) for _ in range(20)} | {1 << a | 1 << b for a in range(30) for b in range(a)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x, x, 0) for x in signed], "fp bigint, name bigint, t int")
    nodes = df.select("fp", F.col("fp").alias("first"))

    def labels(part_rows):
        return sorted(tuple(r) for r in simhash.components(simhash.links(df, 4, part_rows), nodes).collect())

    assert labels(40) == labels(10**6)


def test_chains_reach_the_smallest_id(spark):
    ids = [(1 << 62) | ((1 << i) - 1) for i in range(0, 60, 4)]
    nodes = spark.createDataFrame([(x, 100 + i) for i, x in enumerate(reversed(ids))], "fp bigint, first bigint")
    found = simhash.components(simhash.links(nodes.select("fp", F.col("fp").alias("name"), F.lit(0).alias("t")), 4), nodes).collect()
    assert {r.label for r in found} == {100} and len(found) == 15


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rng, x = random.Random(2), random.Random(9).getrandbits(64)
    chain = [x]
    seen = {x}
    while len(chain) < 5_000:
        y = chain[-1] ^ (1 << rng.randrange(64))
        if y not in seen:
            chain.append(y)
            seen.add(y)
    signed = [y - (1 << 64) if y >> 63 else y for y in chain]
    links = spark.createDataFrame(list(zip(signed, signed[1:])), "a bigint, b bigint")
    nodes = spark.createDataFrame([(y, i + 7) for i, y in enumerate(signed)], "fp bigint, first bigint")
    rounds = []
    monkeypatch.setattr(connected_module, "cut", lambda df: rounds.append(1) or cut(df))
    found = simhash.components(links, nodes).collect()
    assert len(found) == 5_000 and {r.label for r in found} == {7} and len(rounds) < 20


def test_awkward_rows(spark):
    rows = simhash.digest(awkward(spark)).collect()
    assert len(rows) == 11
    blank = {r.component_id for r in rows if r.doc_id in (3, 4, 8)}
    assert blank == {3} and {r.fingerprint for r in rows if r.doc_id in (3, 4, 8)} == {"0" * 16}
    assert [r.component_id for r in rows if r.doc_id == 2] == [1, 1]
    assert simhash.digest(empty(spark)).count() == 0


def kept_ids(spark, rows):
    """(ids that stay, ids that should by brute force over all pairs of fingerprints)."""
    got = sorted(r.doc_id for r in simhash.drop_near_duplicates(documents(spark, rows)).collect())
    return got, [rows[i][0] for i, c in enumerate(classes([plain(t) for _, t, _ in rows], 4)) if i == c]


def test_one_of_each_group_of_copies_stays(spark):
    """Exact copies, edited copies, chains of edits and texts that share a passage: what stays is what all pairs give."""
    rng = random.Random(1)
    texts = []
    for _ in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(40, 300))]
        for _ in range(rng.choice([1, 2, 12])):
            texts.append(" ".join(words))
            if rng.random() < 0.7:
                words = list(words)
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    passage = [f"p{i}" for i in range(160)]
    texts += [" ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(40)]) for _ in range(60)]
    got, want = kept_ids(spark, [(i, t, "s") for i, t in enumerate(texts)])
    assert got == want and 30 <= len(want) < len(texts)


def test_repeated_keys_and_texts_stay_once(spark):
    far, near = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    rows = [(1, far, "s"), (1, far, "s"), (1, near, "s"), (2, near, "s"), (None, far, "s"), (None, "alone", "s"), (None, "alone", "s")]
    got = simhash.drop_near_duplicates(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text[:3]) for r in got) == [(0, "alo"), (1, far[:3]), (1, near[:3])]


def test_stage_takes_awkward_rows(spark):
    docs = awkward(spark).withColumns({"t": F.lit(1), "fp": F.lit(2), "node": F.lit(3), "label": F.lit(4)})
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.select("doc_id", F.substring("text", 1, 9).alias("text")).collect())
    assert [i for n, i, _ in ids if not n] == [1, 3, 5, 6, 7] and sum(n for n, *_ in ids) == 1
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0
