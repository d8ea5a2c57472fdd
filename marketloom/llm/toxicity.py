"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

BUCKETS = 1 << 20
SAMPLE_ROWS = 40_000
PRIOR_TOKENS = 100_000.0
CONFIDENCE = 1.645
DRIFT = 0.2
EVALUE = 0.05
THRESHOLD = 0.7
K = 0.5


def bucket_ids(text: str) -> Column:
    """The tokens of a text (lower-cased runs of letters) as bucket numbers; null text: none."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def fold(key: str, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``; a null key counts as empty text."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % of).cast("int")


def labelled_sample(labels: DataFrame, key: str, label: str, held_out: Column, rows: int) -> DataFrame:
    """(key, label) of at most ``rows`` labelled rows outside the held-out part, chosen by hash; one row a key.

    A key with several labels takes the larger. The bound is what lets this table be broadcast.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out)
    one = known.groupBy(key).agg(F.max(label).cast("int").alias("_label"))
    return cut(one.orderBy(F.xxhash64(key), key).limit(rows))


@dataclass
class Model:
    """Score of each token bucket (negative: not toxic), the tail exponent, and the calibration."""

    weights: np.ndarray
    decay: float
    slope: float
    offset: float


def token_weights(counts: np.ndarray, prior_tokens: float = PRIOR_TOKENS) -> tuple[np.ndarray, float]:
    """Scores from an array of (all, toxic, clean) counts of documents by token bucket, and the tail exponent.

    A bucket's log-odds between toxic and clean documents has a Dirichlet prior in proportion to the corpus counts.
    Its score is the bound of its confidence interval that lies nearer to zero (zero if the interval holds zero), less
    a drift, so that a token of which little is known counts slightly against a passage. The exponent solves
    E[exp(decay * score)] = 1 over clean text: the chance of a segment of score s falls as exp(-decay * s).
    """
    every, toxic, clean = counts
    if toxic.sum() == 0 or clean.sum() == 0:
        return np.full(counts.shape[1], -DRIFT), 1.0
    prior = prior_tokens * (every + 1e-3) / (every + 1e-3).sum()
    t, c = toxic + prior, clean + prior
    odds = np.log(t / (t.sum() - t)) - np.log(c / (c.sum() - c))
    wide = CONFIDENCE * np.sqrt(1 / t + 1 / c)
    score = np.where(odds > wide, odds - wide, np.where(odds < -wide, odds + wide, 0.0)) - DRIFT
    chance = c / c.sum()
    if not (score > 0).any():
        return score, 1.0
    low, high = 1e-6, 50.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if (chance * np.exp(np.minimum(mid * score, 700))).sum() > 1 else (mid, high)
    return score, low


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) of a sequence of scores, in linear time.

    Only positive tokens start or extend a candidate, so the scan goes over those, with running sums. Each candidate
    keeps a link to the nearest earlier one that starts at a lower sum, which the search for a merge follows.
    """
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    sums = np.cumsum(scores)
    right_sums = sums[at].tolist()
    left_sums = (sums[at] - scores[at]).tolist()
    first: list[int] = []
    end: list[int] = []
    left: list[float] = []
    right: list[float] = []
    back: list[int] = []
    for i, lo, hi in zip(at.tolist(), left_sums, right_sums):
        start = i
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= lo:
                j = back[j]
            if j < 0 or right[j] >= hi:
                break
            start, lo = first[j], left[j]
            del first[j:], end[j:], left[j:], right[j:], back[j:]
        first.append(start)
        end.append(i + 1)
        left.append(lo)
        right.append(hi)
        back.append(j)
    return [(a, b, r - l) for a, b, l, r in zip(first, end, left, right)]


def significant(scores: np.ndarray, decay: float, most: float = EVALUE) -> list[tuple[int, int, float, float]]:
    """Segments (first, end, score, expected number by chance) with an expected number under ``most``."""
    scale = np.log(K * max(len(scores), 1))
    found = ((a, b, s, scale - decay * s) for a, b, s in segments(scores))
    return [(a, b, s, float(np.exp(e))) for a, b, s, e in found if e < np.log(most)]


def evidence(scores: np.ndarray, decay: float) -> float:
    """Sum of minus the log of the expected number, over the segments of which less than one is expected; on a log scale."""
    return float(np.log1p(sum(-np.log(max(e, 1e-300)) for *_, e in significant(scores, decay, 1.0))))


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets


def _evidence_of(column: pa.Array, weights: np.ndarray, decay: float) -> np.ndarray:
    ids, offsets = _rows(column)
    scores = weights[ids]
    some = np.concatenate(([0], np.cumsum(scores > 0)))
    out = np.zeros(len(column))
    for i in np.flatnonzero(some[offsets[1:]] > some[offsets[:-1]]):
        out[i] = evidence(scores[offsets[i]: offsets[i + 1]], decay)
    return out


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from evidence to label, with smoothed targets and a weak pull to a slope of 1."""
    if not len(y):
        return 0.0, 0.0
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    if pos == 0 or neg == 0:
        mean = (pos + 1) / (pos + neg + 2)
        return 0.0, float(np.log(mean / (1 - mean)))
    a, b = 1.0, float(np.log((pos + 1) / (neg + 1)))
    ridge = 1e-3 * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * x).sum() + 1e-3 * ridge * (a - 1), (p - target).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3 * ridge, (w * x).sum()], [(w * x).sum(), w.sum()]]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-9:
            break
    return max(a, 0.0), b


def train(docs: DataFrame, sample: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """The model from all texts (corpus counts) and the labels in ``sample`` (key, _label), which is bounded.

    A token counts once for a document, and a text once for all its labelled copies: a word that one text repeats is no
    evidence about others. Counts are summed before they are shuffled, into BUCKETS buckets at most; those sums and the
    sample's evidence, one number a document, are all that comes to the driver.
    """
    ids = docs.select(F.col(key).alias("_key"), bucket_ids(text).alias("_ids"))
    named = F.broadcast(sample.select(F.col(key).alias("_key"), "_label"))
    texts = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_text")).join(named, "_key")
    once = texts.groupBy("_text").agg(F.min("_key").alias("_key"), F.max("_label").alias("_label")).groupBy("_key").agg(F.max("_label").alias("_label"))
    seen = F.broadcast(cut(once))
    tokens = ids.join(seen, "_key", "left").select("_label", F.explode(F.array_distinct("_ids")).alias("bucket"))
    sums = tokens.groupBy("bucket").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("_label") == 1, 1)).alias("toxic"), F.count(F.when(F.col("_label") == 0, 1)).alias("clean"),
    )
    got = sums.select("bucket", *[F.col(c).cast("double") for c in ("n", "toxic", "clean")]).toArrow()
    counts = np.zeros((3, BUCKETS))
    for i, name in enumerate(("n", "toxic", "clean")):
        counts[i, got.column("bucket").to_numpy()] = got.column(name).to_numpy()
    del got
    weights, decay = token_weights(counts)
    weights = weights.astype(np.float32)
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_evidence_of(batch.column(1), held.value, decay))], names=["y", "x"])

    known = ids.join(seen, "_key").select(F.col("_label").alias("y"), "_ids").mapInArrow(run, "y int, x double").toArrow()
    return Model(weights, decay, *calibrate(known.column("x").to_numpy(), known.column("y").to_numpy()))


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score`` (0 to 1, higher: likelier toxic) for every row of ``docs``.

    Only the text is an input. A null or empty text holds no passage and has the score of such texts.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model.weights)
    decay, slope, offset = model.decay, model.slope, model.offset

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _evidence_of(batch.column(batch.num_columns - 1), held.value, decay)
            p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], names=[*batch.schema.names[:-1], "score"])

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", score double"
    return docs.select(*keep, bucket_ids(text).alias("_ids")).mapInArrow(run, schema)


def passages(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every significant toxic passage: (key, first, end, words, passage_score, expected) with token positions."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model.weights)
    decay = model.decay

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, offsets = _rows(batch.column(1))
            scores = held.value[ids]
            found = [(i, *s) for i in range(batch.num_rows) for s in significant(scores[offsets[i]: offsets[i + 1]], decay)]
            rows, first, end, value, expected = zip(*found) if found else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(first, pa.int64()), pa.array(end, pa.int64()),
                pa.array(value, pa.float64()), pa.array(expected, pa.float64()),
            ], names=[key, "first", "end", "passage_score", "expected"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, bucket_ids(text).alias("_ids")).mapInArrow(
        run, f"`{key}` {kind}, first bigint, `end` bigint, passage_score double, expected double",
    )


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The production model: labels of the rows whose crc32(key) mod 3 is not 1, at most ``sample_rows`` of them."""
    return train(docs, labelled_sample(labels, key, "toxic", fold(key, 3) == 1, sample_rows), key, text)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What the toxicity query returns: one row for each row of ``docs``."""
    scored = score(docs, fitted(docs, labels), ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, with all columns. Texts are scored where they lie: no shuffle."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    model = fitted(docs, labels)
    scored = score(docs.toDF(*names.values()), model, list(names.values()), names["text"])
    return scored.filter(F.col("score") < threshold).select(*[F.col(v).alias(k) for k, v in names.items()])
