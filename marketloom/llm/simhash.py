"""SimHash near-duplicates: a binary trie joined with itself finds all fingerprints within a Hamming radius."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected
from ..session import cut
from .common import null_safe_join

WORDS = 4
RADIUS = 4
SEED = 42
#: Rows of a bucket that one task takes; a larger bucket is dealt out as pairs of parts.
PART_ROWS = 500_000


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words`` words, repeats included; a shorter text is one run."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    k = min(words, len(tokens))
    starts = np.concatenate(([0], ends[: len(ends) - k] + 1)).tolist()
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(line[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """64-bit fingerprint: a bit is 1 if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at: at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: list[str], text: str = "text", words: int = WORDS) -> DataFrame:
    """(key columns, fp): the SimHash of each whole text as a signed long. Null text: no words. No words: zero."""
    types = {f.name: f for f in docs.schema}
    schema = ", ".join(f"`{k}` {types[k].dataType.simpleString()}" for k in key) + ", fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(key))
            fps = np.fromiter((majority(shingle_hashes(texts[i].as_py(), words)) for i in range(batch.num_rows)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], pa.array(fps.view(np.int64))], names=[*key, "fp"])

    return docs.select(*key, F.col(text).alias("_whole")).mapInArrow(run, schema)


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the classes of a[i] and b[i]; ``root`` maps each element to the first of its class."""
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[open_], np.minimum(x, y)[open_])
        while not np.array_equal(root, again := root[root]):
            root = again


def trie_classes(keys: np.ndarray, first: np.ndarray, budget: int, batch: int = 50_000) -> np.ndarray:
    """Classes of the keys that are linked by chains of at most ``budget`` differing bits inside their bucket.

    ``keys`` (uint64) are distinct and sorted inside each bucket; ``first`` marks the first key of each bucket. Each
    bucket is a binary trie over the bits from the top: a node is a range of keys that agree so far. Pairs of nodes go
    down together. The children of one node make a pair that differs in one bit; a pair of nodes makes four pairs of
    children, two of which differ in one bit more; a pair beyond ``budget`` is dropped with all that is below it. Pairs
    of few keys are compared at once.

    Pairs wait on a stack, lowest nodes first, and a pair whose keys all belong to one class already is dropped: a dense
    group is so linked near the leaves, and does not cost a step for each of its pairs. Returns the index of the first
    key of each key's class.
    """
    n = len(keys)
    root = np.arange(n)
    ones = {}

    def halves(lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
        """Where the keys with bit 1 at ``depth`` begin in each node."""
        if depth not in ones:
            ones[depth] = np.concatenate(([0], np.cumsum((keys >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)))
        c = ones[depth]
        return hi - (c[hi] - c[lo])

    starts = np.flatnonzero(first)
    lo, hi = starts, np.concatenate((starts[1:], [n]))
    stack = []
    for depth in range(64):
        some = hi - lo > 1
        lo, hi = lo[some], hi[some]
        if not len(lo):
            break
        mid = halves(lo, hi, depth)
        both = (mid > lo) & (mid < hi)
        if both.any() and budget > 0:
            stack.append((depth + 1, np.stack((lo, mid, mid, hi, np.ones_like(lo)))[:, both]))
        lo, hi = np.concatenate((lo, mid)), np.concatenate((mid, hi))
    changes = None
    while stack:
        depth, pairs = stack.pop()
        if changes is None:
            changes = np.concatenate(([0], np.cumsum(root[1:] != root[:-1])))
        if pairs.shape[1] > batch:
            stack.append((depth, pairs[:, batch:]))
            pairs = pairs[:, :batch]
        alo, ahi, blo, bhi, gone = pairs
        done = (root[alo] == root[blo]) & (changes[alo] == changes[ahi - 1]) & (changes[blo] == changes[bhi - 1])
        alo, ahi, blo, bhi, gone = pairs[:, ~done]
        size = (ahi - alo) * (bhi - blo)
        few = (size <= 64) | (depth > 63)
        if few.any():
            a0, b0, nb, many = alo[few], blo[few], (bhi - blo)[few], size[few]
            which = np.repeat(np.arange(len(many)), many)
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            a, b = a0[which] + at // nb[which], b0[which] + at % nb[which]
            near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
            if near.any():
                root = unite(root, a[near], b[near])
                changes = None
        alo, ahi, blo, bhi, gone = alo[~few], ahi[~few], blo[~few], bhi[~few], gone[~few]
        if len(alo):
            am, bm = halves(alo, ahi, depth), halves(blo, bhi, depth)
            down = np.concatenate([np.stack(x) for x in (
                (alo, am, blo, bm, gone), (am, ahi, bm, bhi, gone), (alo, am, bm, bhi, gone + 1), (am, ahi, blo, bm, gone + 1),
            )], axis=1)
            down = down[:, (down[0] < down[1]) & (down[2] < down[3]) & (down[4] <= budget)]
            if down.shape[1]:
                stack.append((depth + 1, down))
    return root


def tree_links(root: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each class a tree of two levels: members by groups of hash, to the first of their group, to the first of all.

    A class of n has about sqrt(n) groups, so no member has many neighbours. First is smallest ``name``; as groups go by
    name too, a class that is found in several buckets yields the same links, which are then counted once.
    """
    if not len(root):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, of, sizes = np.unique(root, return_inverse=True, return_counts=True)
    groups = (np.uint64(1) << np.ceil(np.log2(np.sqrt(sizes))).astype(np.uint64))[of]
    mixed = name.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    group = (mixed >> np.uint64(32)) & (groups - np.uint64(1))
    links_: list[tuple[np.ndarray, np.ndarray]] = []
    order = np.lexsort((name, group, of))
    head = np.concatenate(([True], (of[order][1:] != of[order][:-1]) | (group[order][1:] != group[order][:-1])))
    leader = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    links_.append((order, leader))
    tops = order[head]
    tops = tops[np.lexsort((name[tops], of[tops]))]
    first = np.concatenate(([True], of[tops][1:] != of[tops][:-1]))
    links_.append((tops, tops[np.maximum.accumulate(np.where(first, np.arange(len(tops)), 0))]))
    x, y = (np.concatenate(side) for side in zip(*links_))
    return x[x != y], y[x != y]


def _rotate(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64) & np.uint64(63)
    return np.where(by == 0, x, (x << by) | (x >> ((np.uint64(64) - by) & np.uint64(63))))


def links(fps: DataFrame, radius: int, part_rows: int = PART_ROWS) -> DataFrame:
    """Links (a, b) between names that chain together all fingerprints of one t within ``radius`` bits; distinct (t, fp, name).

    The 64 bits are cut into radius + 1 blocks: two fingerprints within the radius agree in one of them. So each
    fingerprint goes to one bucket for each block, rotated so that the block comes first, and a bucket is the part of a
    trie below that block. Buckets are sorted in their task and joined with themselves (``trie_classes``). A bucket of
    over ``part_rows`` rows is dealt out by hash into parts, and every pair of parts is a bucket of its own, so that no
    task holds a hot bucket and no pair of rows is missed. A class of a bucket is returned as a tree, not as all pairs.
    """
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    shifts, widths = edges[:-1], np.diff(edges).tolist()
    spread = F.posexplode(F.array(*[
        F.shiftrightunsigned(F.shiftleft("fp", s), 64 - w) for s, w in zip(shifts, widths)
    ])).alias("block", "value")
    rows = fps.select("fp", "name", "t", spread).select("fp", "name", (F.col("t") * (radius + 1) + F.col("block")).cast("int").alias("block"), "value")
    hot = cut(rows.groupBy("block", "value").agg(F.count("*").alias("_n")).filter(F.col("_n") > part_rows).select(
        "block", "value", F.ceil(F.col("_n") / part_rows).cast("int").alias("_parts")
    ))
    part = F.pmod(F.xxhash64("fp"), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = (
        rows.join(hot, ["block", "value"], "left")
        .withColumn("_me", part)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .select("fp", "name", "block", "value", F.least("_me", "_other").alias("x"), F.greatest("_me", "_other").alias("y"))
    )
    offsets = np.array(shifts, np.uint64)

    def solve(fp: np.ndarray, name: np.ndarray, block: np.ndarray, same: np.ndarray) -> pa.RecordBatch:
        turned = _rotate(fp, offsets[block % (radius + 1)])
        order = np.lexsort((turned, np.cumsum(same)))
        name, turned, first = name[order], turned[order], same
        repeat = np.concatenate(([False], (turned[1:] == turned[:-1]) & ~first[1:]))
        name, turned, first = name[~repeat], turned[~repeat], first[~repeat]
        a, b = tree_links(trie_classes(turned, first, radius), name)
        return pa.RecordBatch.from_arrays([pa.array(name[a]), pa.array(name[b])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come bucket by bucket; whole buckets are solved together, some hundred thousand rows at a time."""
        held: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            if sum(h.shape[1] for h in held) < 200_000:
                continue
            all_ = np.concatenate(held, axis=1)
            last = np.flatnonzero((all_[2:, 1:] != all_[2:, :-1]).any(axis=0))
            if len(last):
                end = last[-1] + 1
                held = [all_[:, end:]]
                yield one(all_[:, :end])
            else:
                held = [all_]
        if held and (all_ := np.concatenate(held, axis=1)).shape[1]:
            yield one(all_)

    def one(rows_: np.ndarray) -> pa.RecordBatch:
        first = np.concatenate(([True], (rows_[2:, 1:] != rows_[2:, :-1]).any(axis=0)))
        return solve(rows_[0].view(np.uint64), rows_[1], rows_[2], first)

    bucket = ["block", "value", "x", "y"]
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = dealt.repartition(parts, *bucket).sortWithinPartitions(*bucket)
    return placed.mapInArrow(run, "a bigint, b bigint").distinct()


def components(links_: DataFrame, nodes: DataFrame) -> DataFrame:
    """(fp, label): for each linked fingerprint the smallest ``first`` reachable over the links; ``nodes`` holds (fp, first)."""
    roots = cut(connected(links_))
    least = roots.join(nodes.withColumnRenamed("fp", "node"), "node").groupBy("root").agg(F.min("first").alias("label"))
    return roots.join(least, "root").select(F.col("node").alias("fp"), "label")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS, extra: tuple[str, ...] = (),
) -> DataFrame:
    """(key, extra columns, fp, component): the near-duplicate class of every row.

    Texts whose fingerprints differ in at most ``radius`` bits are linked; ``component`` is the smallest key reachable
    over links, the row's own key included. Equal texts have equal fingerprints and so one class. Null and blank texts
    have the fingerprint zero, which links like any other. A null key takes the class's smallest key, and is null itself
    only if the class has no other. Repeated rows are kept, in one class. An empty table gives an empty table.
    """
    marked = cut(fingerprints(docs, [key, *extra], text, words))
    nodes = cut(marked.groupBy("fp").agg(F.min(key).alias("first"), F.count("*").alias("_copies")))
    found = components(links(nodes.select("fp", F.col("fp").alias("name"), F.lit(0).alias("t")), radius), nodes)
    labels = nodes.select("fp", "first").join(found, "fp", "left").select("fp", F.coalesce("label", "first").alias("component"))
    return marked.join(labels, "fp").select(key, *extra, "fp", "component")


def digest(docs: DataFrame) -> DataFrame:
    """What the near-duplicate query returns."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each near-duplicate class (``near_duplicates``): the one with the smallest key.

    Classes are those of the fingerprints, so a row without a key stays only if its class has no key, and repeated
    keys whose texts are of different classes leave one row in each. Rows that share the smallest key are told apart by
    a hash of their texts, wholly repeated rows by nothing: one stays. A null text is an empty one, and all texts
    without words are one class. An empty table gives an empty table. All columns pass through under any name.

    Classes are found on keys, text hashes and fingerprints; the texts are read twice and shuffled once, to meet the
    rows that stay.
    """
    own = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    key, text = own[key], own[text]
    same = f"{text}_id"
    df = docs.toDF(*own.values()).withColumn(same, F.xxhash64(F.coalesce(text, F.lit(""))))
    marked = cut(fingerprints(df, [key, same], text, words))
    first = F.min(F.struct(F.col(key).isNull().alias("_none"), F.col(key), F.col(same))).alias("_first")
    nodes = cut(marked.groupBy("fp").agg(first))
    found = components(links(nodes.select("fp", F.col("fp").alias("name"), F.lit(0).alias("t")), radius), nodes.select("fp", F.col("fp").alias("first")))
    classes = nodes.join(found, "fp", "left").groupBy(F.coalesce("label", "fp").alias("label")).agg(F.min("_first").alias("_first"))
    keep = cut(classes.select(f"_first.{key}", f"_first.{same}"))
    kept = null_safe_join(df, keep, [key, same], "left_semi")
    once = F.row_number().over(Window.partitionBy(key, same).orderBy(*[F.col(c) for c in own.values() if c not in (key, text)]))
    return kept.withColumn("_once", once).filter("_once = 1").select(*[F.col(v).alias(k) for k, v in own.items()])
