"""Text quality: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .toxicity import fold, labelled_sample

BUCKETS = 1 << 18
SAMPLE_ROWS = 40_000
REPLICAS = 4
PASSES = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.01
#: Length of a text's vector.
SCALE = 3.0
THRESHOLD = 0.3
#: Bucket of every pair of a word and the same word again, and the bucket that each text has.
AGAIN, ALWAYS = 0, 1


def word_hashes(text: str) -> Column:
    """32-bit hashes of a text's words: runs of letters and digits as they are written, and runs of other signs."""
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.hash(w))


def features(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text's word 1-grams and 2-grams: log counts, scaled to the length SCALE; and ALWAYS."""
    if not len(hashes):
        return np.array([ALWAYS]), np.ones(1)
    h = hashes.astype(np.int64).view(np.uint64)
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    pair = (pair >> np.uint64(40)) % np.uint64(BUCKETS - 2) + np.uint64(2)
    pair[h[:-1] == h[1:]] = AGAIN
    single = ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(BUCKETS - 2) + np.uint64(2)
    at, n = np.unique(np.concatenate((single, pair)), return_counts=True)
    x = np.log1p(n)
    return np.append(at.astype(np.int64), ALWAYS), np.append(SCALE * x / np.sqrt((x * x).sum()), 1.0)


def follow_leader(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights after PASSES passes of FTRL-proximal updates with per-bucket rates and an L1 pull to zero."""
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[at]) <= L1, 0.0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    vectors = [features(t) for t in texts]
    for _ in range(PASSES):
        for (at, x), y in zip(vectors, labels):
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(slice(None))


def train(docs: DataFrame, sample: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Weights by bucket from the labels in ``sample`` (key, _label), which is bounded and broadcast.

    The sample is dealt by hash over REPLICAS tasks; each follows the leader over its part, and the weights are
    averaged by bucket. BUCKETS numbers at most come to the driver.
    """
    seen = F.broadcast(sample.select(F.col(key).alias("_key"), "_label"))
    known = docs.select(F.col(key).alias("_key"), word_hashes(text).alias("h")).join(seen, "_key").select(
        F.pmod(F.xxhash64("_key"), F.lit(REPLICAS)).cast("int").alias("replica"), F.xxhash64("_key", F.lit(1)).alias("turn"), "_label", "h"
    )

    def fit(part: pa.Table) -> pa.Table:
        part = part.sort_by("turn")
        rows = part.column("h").combine_chunks()
        offsets, values = rows.offsets.to_numpy(), rows.values.to_numpy(zero_copy_only=False)
        w = follow_leader([values[a:b] for a, b in zip(offsets, offsets[1:])], part.column("_label").to_numpy())
        at = np.flatnonzero(w)
        return pa.table({"bucket": at.astype(np.int64), "w": w[at]})

    fitted = known.groupBy("replica").applyInArrow(fit, "bucket bigint, w double")
    mean = fitted.groupBy("bucket").agg((F.sum("w") / REPLICAS).alias("w")).toArrow()
    out = np.zeros(BUCKETS)
    out[mean.column("bucket").to_numpy()] = mean.column("w").to_numpy()
    return out


def score(docs: DataFrame, weights: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score`` (0 to 1, higher: label 1 likelier): a sparse dot product for each whole text.

    A null or empty text has the score of the bucket that every text has.
    """
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.num_columns - 1)
            offsets, values = rows.offsets.to_numpy(), rows.values.to_numpy(zero_copy_only=False)
            dots = np.zeros(batch.num_rows)
            for i in range(batch.num_rows):
                at, x = features(values[offsets[i]: offsets[i + 1]])
                dots[i] = held.value[at] @ x
            p = 1 / (1 + np.exp(-np.clip(dots, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], names=[*batch.schema.names[:-1], "score"])

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", score double"
    return docs.select(*keep, word_hashes(text).alias("_h")).mapInArrow(run, schema)


def digest(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """What the quality query returns: one row for each row of ``docs``."""
    held_out = fold("doc_id", 5) == 0
    weights = train(docs, labelled_sample(labels, "doc_id", "quality", held_out, sample_rows))
    scored = score(docs, weights, ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
