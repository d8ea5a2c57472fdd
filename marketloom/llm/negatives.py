"""Hard-negative mining: Strassen products of anchor and candidate tiles, and heaps of positives and windows that merge."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these shares (percent) of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
#: Candidates of one group, and anchors of one tile: what a task holds at once.
GROUP_ROWS = 16_384
TILE_ROWS = 256
#: A product with a side of at most LEAF is multiplied plainly.
LEAF = 32
NO_ID = 2**63 - 1


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices by seven half-size products, padded with zeros to even sides.

    All sums are of integers modulo 2^64, so the product is exact if it fits into 64 bits, whatever the sums between.
    """
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return plain_product(a, b)
    if n % 2 or k % 2:
        a = np.pad(a, ((0, n % 2), (0, k % 2)))
    if k % 2 or m % 2:
        b = np.pad(b, ((0, k % 2), (0, m % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * t), np.int64)
    out[:r, :t] = m1 + m4 - m5 + m7
    out[:r, t:] = m3 + m5
    out[r:, :t] = m2 + m4
    out[r:, t:] = m1 - m2 + m3 + m6
    return out[:n, :m]


def plain_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The int64 product; in doubles, which are faster and exact here, if no partial sum can reach 2^53."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    most = max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min())) * a.shape[1]
    return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64) if most < 2**53 else a @ b


def matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of integers as one matrix; shorter vectors end in zeros."""
    offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(offsets)
    wide = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lengths), wide), np.int64)
    out[np.arange(wide) < lengths[:, None]] = values[offsets[0]: offsets[-1]]
    return out


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """All inner products, anchors by candidates; an error if one could pass 64 bits."""
    wide = max(anchors.shape[1], candidates.shape[1])
    longest = [np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)) for x in (anchors, candidates)]
    if longest[0] * longest[1] >= 2.0**62 / 100:
        raise ValueError("Vectors are too long: 100 times an inner product of theirs can pass 64 bits.")
    a, c = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (anchors, candidates))
    return strassen(a, np.ascontiguousarray(c.T))


class Heaps:
    """The best ``size`` (score, id) of each key, by score from the top, then the smaller id; added to in sorted pieces."""

    def __init__(self, size: int):
        self.size = size
        self.held: dict[tuple[int, int], list[tuple[int, int, int]]] = {}

    def add(self, key: tuple[int, int], found: list[tuple[int, int, int]]) -> None:
        """``found`` holds (-score, id, row) in order."""
        if found:
            own = self.held.get(key)
            self.held[key] = found if own is None else sorted(own + found)[: self.size]


def in_window(ordered: np.ndarray, positive: int, size: int) -> slice:
    """Where the first ``size`` scores of a descending row that lie in the window of a positive's score are."""
    if positive <= 0:
        # below zero the window is empty; at zero it is the score zero
        if positive < 0:
            return slice(0, 0)
        return slice(a := int(np.searchsorted(-ordered, 0)), min(int(np.searchsorted(-ordered, 0, "right")), a + size))
    first = int(np.searchsorted(-ordered, -(HIGH * positive // 100)))
    end = int(np.searchsorted(-ordered, LOW * positive // -100, "right"))
    return slice(first, max(first, min(end, first + size)))


def _tiles(rows: DataFrame, solve: Callable[..., None], size: int, schema: str) -> DataFrame:
    """Runs over groups of candidates, each followed by all anchors that meet it, TILE_ROWS at a time.

    ``rows`` holds (part, anchor, row, id, label, vector, positives); parts are dealt to tasks and sorted, candidates
    (anchor = 0) first and by id, so that equal scores keep the order of ids. ``solve`` adds what it finds to the heaps
    of a part, which go out with the part's end.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartition(parts, "part").sortWithinPartitions("part", "anchor", "id", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, candidates, heaps, held = None, [], Heaps(size), []

        def flush(tile: list[pa.RecordBatch]) -> None:
            nonlocal candidates
            if isinstance(candidates, list):
                if not candidates:
                    return
                all_ = pa.Table.from_batches(candidates).combine_chunks()
                candidates = tuple(all_.column(c).to_numpy() for c in ("row", "id", "label")) + (matrix(all_.column("vector").combine_chunks()),)
            all_ = pa.Table.from_batches(tile).combine_chunks()
            anchors = tuple(all_.column(c).to_numpy() for c in ("row", "id", "label")) + (matrix(all_.column("vector").combine_chunks()),)
            solve(anchors, candidates, scores(anchors[3], candidates[3]), all_.column("positives").to_pylist(), heaps)

        def out() -> pa.RecordBatch:
            flat = [(a, p, i, -s, r) for (a, p), found in heaps.held.items() for s, i, r in found]
            columns = zip(*flat) if flat else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor_row", "place", "id", "score", "row"])

        for batch in batches:
            part, kind = batch.column("part").to_numpy(), batch.column("anchor").to_numpy()
            edges = [0, *(np.flatnonzero((part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), len(part)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if part[a] != now:
                    if held:
                        flush(held)
                    if heaps.held:
                        yield out()
                    now, candidates, heaps, held = part[a], [], Heaps(size), []
                if kind[a] == 0:
                    candidates.append(batch.slice(a, b - a))
                    continue
                for at in range(a, b, TILE_ROWS):
                    held.append(batch.slice(at, min(TILE_ROWS, b - at)))
                    if sum(x.num_rows for x in held) >= TILE_ROWS:
                        flush(held)
                        held = []
        if held:
            flush(held)
        if heaps.held:
            yield out()

    return placed.mapInArrow(run, schema)


def _best(found: DataFrame, size: int) -> DataFrame:
    """Merges the heaps of all parts: the first ``size`` rows of each anchor and place, with ``rank``."""
    order = Window.partitionBy("anchor_row", "place").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def quantised(rows: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """(row, id, label, vector): the rows that take part, numbered, with floor(SCALE * x) as integers."""
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    fine = F.col(vector).isNotNull() & F.forall(F.transform(vector, lambda x: x.cast("double")), number)
    used = rows.withColumn("_label", label).filter(F.coalesce(fine, F.lit(False)) & F.col("_label").isNotNull())
    return cut(used.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col("_label").cast("long").alias("label"), scaled.alias("vector"),
    ))


def mine(
    rows: DataFrame, is_anchor: Column, label: Column, key: str = "vec_id", vector: str = "embedding", group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and each of its positives.

    Scores are inner products of quantised vectors. An anchor's positives are its POSITIVES best other rows of the same
    label; a positive's negatives are the first NEGATIVES rows of other labels whose score lies in the window between
    LOW and HIGH percent of the positive's. Higher scores come first, then smaller keys.

    The stated anchors meet all rows in blocks. Rows are dealt by hash into parts of about ``group_rows``, and each part
    gets the anchors (for positives, parts are of one label and get that label's anchors), so a label or vector that
    most rows have is spread like any other. A part multiplies its candidates with TILE_ROWS anchors at a time
    (``strassen``) and keeps a heap for each anchor, or for each anchor and positive; heaps of all parts then merge.
    Windows depend on the merged positives, hence two passes, over same-label and other-label pairs.

    Rows with a null label, a null vector, or a null or non-finite component take no part. A null key makes no anchor and
    comes last among equal scores. Repeated rows are rows like any others: a repeated anchor is mined twice, each the
    other's positive. Shorter vectors end in zeros. An empty table, or one without anchors, gives an empty table. Vectors
    whose scores could pass 64 bits are an error. Other columns take no part.
    """
    vectors = quantised(rows, key, vector, label)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = cut(vectors.groupBy("label").agg(F.count("*").alias("n")))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows_a_part = max(1024, min(group_rows, math.ceil(total / parts)))
    anchors = cut(vectors.withColumn("_id", F.when(F.col("id") == NO_ID, None).otherwise(F.col("id"))).filter(is_anchor).drop("_id"))
    none = F.lit(None).cast("array<bigint>").alias("positives")
    columns = ["part", F.lit(0).alias("anchor"), "row", "id", "label", "vector", none]
    schema = "anchor_row bigint, place bigint, id bigint, score bigint, row bigint"

    spread = F.ceil(F.col("n") / rows_a_part).cast("int")
    of_label = vectors.join(sizes, "label").withColumn("part", F.xxhash64("label", F.pmod(F.xxhash64("row"), spread)))
    to_label = anchors.join(sizes, "label").withColumn("part", F.explode(F.transform(F.sequence(F.lit(0), spread - 1), lambda i: F.xxhash64("label", i.cast("long")))))
    same = of_label.select(*columns).union(to_label.select("part", F.lit(1), "row", "id", "label", "vector", none))

    def positives(a, c, product, _, heaps):
        for i in range(len(a[0])):
            fit = np.flatnonzero((c[2] == a[2][i]) & (c[0] != a[0][i]))
            s = product[i, fit]
            if len(s) > POSITIVES:
                least = np.partition(s, len(s) - POSITIVES)[len(s) - POSITIVES]
                fit = fit[s >= least]
                fit = fit[np.argsort(-product[i, fit], kind="stable")[:POSITIVES]]
            else:
                fit = fit[np.argsort(-s, kind="stable")]
            heaps.add((int(a[0][i]), 0), list(zip((-product[i, fit]).tolist(), c[1][fit].tolist(), c[0][fit].tolist())))

    nearest = cut(_best(_tiles(same, positives, POSITIVES, schema), POSITIVES))
    windows = nearest.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("_p"))
    wanted = cut(anchors.join(windows, anchors.row == windows.anchor_row).select("row", "id", "label", "vector", F.col("_p.score").alias("positives")))

    groups = max(1, math.ceil(total / rows_a_part))
    dealt = vectors.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)))
    to_all = wanted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    every = dealt.select(*columns).union(to_all.select("part", F.lit(1), "row", "id", "label", "vector", "positives"))

    def negatives(a, c, product, positive_scores, heaps):
        for i in range(len(a[0])):
            other = np.flatnonzero(c[2] != a[2][i])
            s = product[i, other]
            order = np.argsort(-s, kind="stable")
            ordered = s[order]
            for place, positive in enumerate(positive_scores[i]):
                at = in_window(ordered, positive, NEGATIVES)
                fit = other[order[at]]
                heaps.add((int(a[0][i]), place + 1), list(zip((-ordered[at]).tolist(), c[1][fit].tolist(), c[0][fit].tolist())))

    hard = _best(_tiles(every, negatives, NEGATIVES, schema), NEGATIVES)
    named = nearest.select("anchor_row", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return (
        hard.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(named, ["anchor_row", "place"])
        .join(anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id")), "anchor_row")
        .select("anchor_id", real("positive_id"), F.col("rank").cast("int").alias("rank"), real("negative_id"), "positive_score", "negative_score")
    )


def digest(embeddings: DataFrame) -> DataFrame:
    """What the mining query returns: anchors are every hundredth id; every seventh id has its label moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(embeddings, F.col("_id") % 100 == 0, label)
