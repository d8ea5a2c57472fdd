"""Language-model scores: an interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by workers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut
from ..store import Store, shared_store
from .toxicity import fold

#: No word holds a blank, so this is none.
END = xxhash.xxh64_intdigest(b" end")
#: Tokens that a task gathers before it sorts and sums them.
GATHER = 4_000_000
#: Tokens that are looked up together.
LOOKUP = 500_000
NONE = np.int64(-1)


def token_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased, and of the end token."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    one = xxhash.xxh64_intdigest
    out = np.fromiter(map(one, words), np.uint64, len(words))
    return np.append(out, np.uint64(END))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], np.add.reduceat(counts[order], heads)


@dataclass
class Model:
    """Where the arrays are, the shards' first type numbers, and the model's few numbers.

    A type's number is its place in the sorted array of all type hashes (shards follow one another); a pair's key is
    the first type's number times 2^32 plus the second's, so there may be up to 2^32 - 1 types.
    """

    store: Store
    bits: int
    offsets: np.ndarray
    tokens: int
    pair_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    type_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    pairs: int = 0
    rest: float = 1.0
    with_pairs: np.ndarray | None = None

    @property
    def types(self) -> int:
        return int(self.offsets[-1])

    @property
    def shards(self) -> int:
        return 1 << self.bits

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Type numbers of sorted hashes; NONE for unknown ones."""
        out = np.full(len(hashes), NONE)
        edges = (np.arange(1, self.shards, dtype=np.uint64) << np.uint64(64 - self.bits)) if self.bits else np.zeros(0, np.uint64)
        ends = np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))
        for s in np.flatnonzero((ends[1:] > ends[:-1]) & (np.diff(self.offsets) > 0)):
            known, asked = self.store.read(f"hashes-{s}"), hashes[ends[s]: ends[s + 1]]
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            hit = known[at] == asked
            out[ends[s]: ends[s + 1]][hit] = at[hit] + self.offsets[s]
        return out

    def by_type(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of a per-type array for sorted type numbers."""
        out = np.zeros(len(ids))
        ends = np.searchsorted(ids, self.offsets)
        for s in np.flatnonzero(ends[1:] > ends[:-1]):
            out[ends[s]: ends[s + 1]] = self.store.read(f"{name}-{s}")[ids[ends[s]: ends[s + 1]] - self.offsets[s]]
        return out

    def shard_of(self, ids: np.ndarray) -> np.ndarray:
        """Shards of type numbers; the start mark, which is numbered after all types, goes with the last."""
        return np.minimum(np.searchsorted(self.offsets, ids, side="right") - 1, self.shards - 1)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pair keys."""
        out = np.zeros(len(keys))
        edges = np.searchsorted(keys >> np.int64(32), self.offsets[1:-1])
        ends = np.concatenate(([0], edges, [len(keys)]))
        for s in np.flatnonzero((ends[1:] > ends[:-1]) & self.with_pairs):
            known, asked = self.store.read(f"pairs-{s}"), keys[ends[s]: ends[s + 1]]
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            hit = known[at] == asked
            out[ends[s]: ends[s + 1]][hit] = self.store.read(f"pair_counts-{s}")[at[hit]]
        return out


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more from the numbers of entries with count 1 to 4.

    Where a number is zero the usual estimate does not exist and half a count is taken off each step.
    """
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3, n4) <= 0:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(float(np.clip(d, 0.0, k)) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))


def _discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    off = np.where(counts >= 3, d[2], np.where(counts == 2, d[1], d[0]))
    return np.maximum(counts - off, 0) * (counts > 0)


def _histogram(counts: np.ndarray) -> list[int]:
    """How many are 1, 2, 3, 4, and 3 or more."""
    return [*(int((counts == k).sum()) for k in (1, 2, 3, 4)), int((counts >= 3).sum())]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        texts = batch.column(0)
        for i in range(batch.num_rows):
            yield token_hashes(texts[i].as_py())


def _dealt(keys: np.ndarray, counts: np.ndarray, shards: np.ndarray) -> pa.RecordBatch:
    """Sorted keys and counts as one row for each shard that they fall into; shards must rise with the keys."""
    heads = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1]))) if len(keys) else np.zeros(0, np.int64)
    ends = np.concatenate((heads[1:], [len(keys)]))
    return pa.RecordBatch.from_arrays([
        pa.array(shards[heads].astype(np.int32), pa.int32()),
        pa.array([keys[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
        pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in zip(heads, ends)], pa.binary()),
    ], names=["shard", "keys", "counts"])


def _merged(part: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.frombuffer(x, kind) for x in part.column("keys").to_pylist()]
    counts = [np.frombuffer(x, np.uint32).astype(np.int64) for x in part.column("counts").to_pylist()]
    return _summed(np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, kind), np.zeros(0, np.int64))


DEALT = "shard int, keys binary, counts binary"
SUMS = "shard int, types bigint, tokens bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint, more bigint"


def _sums(part: pa.Table, types: int, tokens: int, n: list[int]) -> dict:
    return {k: pa.array([v], t) for k, v, t in zip(
        ("shard", "types", "tokens", "n1", "n2", "n3", "n4", "more"), (part.column("shard")[0].as_py(), types, tokens, *n), (pa.int32(), *[pa.int64()] * 7),
    )}


def _count_types(texts: DataFrame, store: Store, bits: int) -> Model:
    """Counts of all token types: tasks sum what they read, shards of the hash range sum over tasks and write their arrays."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            shards = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
            return _dealt(keys, counts, shards)

        for h in _texts(batches):
            held.append(h)
            many += len(h)
            if many >= GATHER:
                yield flush()
                held, many = [], 0
        if held:
            yield flush()

    def merge(part: pa.Table) -> pa.Table:
        keys, counts = _merged(part, np.uint64)
        s = part.column("shard")[0].as_py()
        store.write(f"hashes-{s}", keys)
        store.write(f"counts-{s}", counts)
        return pa.table(_sums(part, len(keys), int(counts.sum()), [0] * 5))

    got = {r["shard"]: r for r in texts.mapInArrow(gather, DEALT).groupBy("shard").applyInArrow(merge, SUMS).collect()}
    sizes = [got[s]["types"] if s in got else 0 for s in range(1 << bits)]
    return Model(store, bits, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), sum(r["tokens"] for r in got.values()))


def _pair_keys(hashes: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts given as token hashes: first and second type number of each token's pair, and each token's place in
    the list of distinct hashes (sorted) with their numbers. The first token of a text follows the start mark."""
    flat = np.concatenate(hashes)
    known, back = np.unique(flat, return_inverse=True)
    ids = model.find(known)
    second = ids[back]
    first = np.concatenate(([model.types], second[:-1]))
    starts = np.cumsum([0, *[len(h) for h in hashes[:-1]]])
    first[starts] = model.types
    return first, second, ids


def _count_pairs(texts: DataFrame, model: Model) -> Model:
    """Counts of all pairs by first type, then the number of distinct first types of each second type."""
    store = model.store

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, looked, many, waiting = [], [], 0, 0

        def look() -> None:
            first, second, _ = _pair_keys(looked, model)
            held.append((first << np.int64(32)) | second)
            looked.clear()

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return _dealt(keys, counts, model.shard_of(keys >> np.int64(32)))

        for h in _texts(batches):
            looked.append(h)
            many += len(h)
            waiting += len(h)
            if waiting >= LOOKUP:
                look()
                waiting = 0
            if many >= GATHER:
                if looked:
                    look()
                    waiting = 0
                yield flush()
                many = 0
        if looked:
            look()
        if held:
            yield flush()

    def merge(part: pa.Table) -> pa.Table:
        keys, counts = _merged(part, np.int64)
        s = part.column("shard")[0].as_py()
        store.write(f"pairs-{s}", keys)
        store.write(f"pair_counts-{s}", counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32))
        first = (keys >> np.int64(32)) - model.offsets[s]
        own = int(model.offsets[s + 1] - model.offsets[s]) + 1  # one more for the start mark
        store.write(f"followers-{s}", np.stack([
            np.bincount(first[chosen], minlength=own).astype(np.uint32) for chosen in (counts == 1, counts == 2, counts >= 3)
        ]))
        second, n = np.unique(keys & np.int64(0xFFFFFFFF), return_counts=True)
        told = _dealt(second, n, model.shard_of(second)).to_pydict()
        none = len(told["shard"]) * [0]
        n = _histogram(counts)
        # the first row also tells how often each count occurs
        numbers = {f"n{i + 1}": pa.array([n[i], *none[1:]], pa.int64()) for i in range(4)}
        return pa.table({"first_shard": pa.array([s] * len(told["shard"]), pa.int32()), "shard": pa.array(told["shard"], pa.int32()), "keys": pa.array(told["keys"], pa.binary()), "counts": pa.array(told["counts"], pa.binary()), **numbers})

    def merge_seconds(part: pa.Table) -> pa.Table:
        ids, counts = _merged(part, np.int64)
        s = part.column("shard")[0].as_py()
        whole = np.zeros(int(model.offsets[s + 1] - model.offsets[s]), np.uint32)
        whole[ids - model.offsets[s]] = counts
        store.write(f"leaders-{s}", whole)
        return pa.table(_sums(part, len(ids), int(counts.sum()), _histogram(counts)))

    pairs = texts.mapInArrow(gather, DEALT)
    told = cut(pairs.groupBy("shard").applyInArrow(merge, "first_shard int, " + DEALT + ", n1 bigint, n2 bigint, n3 bigint, n4 bigint"))
    model.with_pairs = np.isin(np.arange(model.shards), [r[0] for r in told.select("first_shard").distinct().collect()])
    n = told.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in range(1, 5)]).first()
    model.pair_discounts = discounts(np.array(list(n)))
    got = told.select("shard", "keys", "counts").groupBy("shard").applyInArrow(merge_seconds, SUMS).collect()
    if not got:
        return model
    sums = np.array([[r["n1"], r["n2"], r["n3"], r["n4"], r["more"], r["tokens"]] for r in got]).sum(axis=0)
    model.type_discounts = d = discounts(sums[:4])
    model.pairs = int(sums[5])
    model.rest = float((d[0] * sums[0] + d[1] * sums[1] + d[2] * sums[4]) / sums[5])
    return model


def train(docs: DataFrame, text: str = "text") -> Model:
    """The model of all rows of ``docs``. What comes to the driver is one row of sums for each shard.

    Shards are ranges of type hashes; there are as many as shuffle partitions, rounded up to a power of two, so a
    shard's arrays stay as large as a shuffle partition. A frequent first type has all its pairs in one shard, summed
    by task before: its distinct followers, not its occurrences.
    """
    spark = docs.sparkSession
    bits = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    texts = docs.select(F.col(text).alias("text"))
    return _count_pairs(texts, _count_types(texts, shared_store(spark, "language-model"), bits))


def token_scores(hashes: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(log10 probability, training count) of each token of some texts, one after another.

    P(b | a) = max(c(ab) - D(c(ab)), 0) / c(a) + g(a) P(b), where g(a) c(a) is what the discounts took from the pairs of
    a, and P(b) = max(l(b) - D'(l(b)), 0) / pairs + rest / (types + 1) with l(b) the number of distinct types before b.
    After an unknown type P(b) holds alone. An unknown token has the share of one further type.
    """
    first, second, ids = _pair_keys(hashes, model)
    distinct = ids[ids >= 0]  # sorted hashes have rising numbers
    counts, leaders = model.by_type("counts", distinct), model.by_type("leaders", distinct)
    slots = np.searchsorted(distinct, second)
    known = second >= 0
    slots[~known] = 0
    uniform = 1.0 / (model.types + 1)
    pick = lambda values: np.where(known, values[slots], 0.0) if len(values) else np.zeros(len(second))
    low = pick(_discounted(leaders, model.type_discounts)) / max(model.pairs, 1) + model.rest * uniform
    seen_first = first >= 0
    firsts, back = np.unique(first[seen_first], return_inverse=True)
    totals, kept = np.zeros(len(firsts)), np.zeros(len(firsts))
    ends = np.concatenate(([0], np.searchsorted(firsts, model.offsets[1:-1]), [len(firsts)]))
    for s in np.flatnonzero((ends[1:] > ends[:-1]) & model.with_pairs):
        mine = firsts[ends[s]: ends[s + 1]] - model.offsets[s]
        kept[ends[s]: ends[s + 1]] = np.array(model.pair_discounts) @ model.store.read(f"followers-{s}")[:, mine]
    totals[firsts < model.types] = model.by_type("counts", firsts[firsts < model.types])
    if len(firsts) and firsts[-1] == model.types:
        totals[-1] = model.by_type("counts", model.find(np.array([END], np.uint64))).sum() if model.types else 0  # one start for each end
    ratio = np.where(totals > 0, kept / np.maximum(totals, 1), 1.0)
    p = low.copy()
    p[seen_first] *= ratio[back]
    both = seen_first & known
    keys, back_keys = np.unique((first[both] << np.int64(32)) | second[both], return_inverse=True)
    found = _discounted(model.pair_counts(keys), model.pair_discounts)[back_keys]
    at = np.zeros(len(first), np.int64)
    at[seen_first] = back
    p[both] += found / np.maximum(totals[at[both]], 1)
    return np.log10(p), pick(counts)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) for every row of ``docs``; perplexity is 10 ** (-score / n_tokens).

    A null text is empty and has one token, the end.
    """
    kind = docs.schema[key].dataType.simpleString()
    tokens, types = model.tokens, model.types
    floor = np.log10(tokens + types + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(1), 0
            columns: list[list] = [[], [], [], []]
            while at < batch.num_rows:
                held, many, start = [], 0, at
                while at < batch.num_rows and many < LOOKUP:
                    held.append(token_hashes(texts[at].as_py()))
                    many += len(held[-1])
                    at += 1
                log_p, counts = token_scores(held, model)
                heads = np.cumsum([0, *[len(h) for h in held[:-1]]])
                for column, values in zip(columns, (
                    np.array([len(h) for h in held]), np.add.reduceat((counts > 0).astype(np.int64), heads),
                    np.add.reduceat(np.log10(counts + 1) - floor, heads), np.add.reduceat(log_p, heads),
                )):
                    column.append(values)
            arrays = [pa.array(np.concatenate(c)) if c else pa.array([], t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[key, "n_tokens", "n_known", "base_score", "score"])

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint, n_known bigint, base_score double, score double")


def held_out(key: str = "doc_id") -> Column:
    return fold(key, 7) == 2


def digest(docs: DataFrame) -> DataFrame:
    """What the scoring query returns: every row of ``docs``, scored by the model of those not held out."""
    model = train(docs.filter(~held_out()))
    scored = score(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
