import random
import zlib

import numpy as np
from marketloom.llm import quality
from pyspark.sql import functions as F

from .helpers import awkward, documents, empty


def corpus(spark, n=800):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        words = [f"word{rng.randrange(300)}" for _ in range(rng.randrange(30, 80))]
        if bad:
            words = [w + "%%%" for w in words] if i % 4 else [w for w in words[:6] for _ in range(8)]
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(not bad), 0))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    rows = quality.digest(docs, labels).collect()
    assert len(rows) == 800 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = [r.score for r in held if r.doc_id % 6], [r.score for r in held if r.doc_id % 6 == 0]
    assert min(good) > max(bad) and np.mean([r.predicted for r in held if r.doc_id % 6]) == 1.0
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus(spark, 150)
    flipped = labels.withColumn("quality", F.when(quality.fold("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((r.doc_id, round(r.score, 12)) for r in quality.digest(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_features_of_a_text():
    at, x = quality.features(np.array([5, 5, 7], np.int32))
    assert quality.AGAIN in at and quality.ALWAYS in at
    assert abs(np.sqrt((x[:-1] ** 2).sum()) - quality.SCALE) < 1e-9
    assert quality.features(np.zeros(0, np.int32))[0].tolist() == [quality.ALWAYS]


def test_awkward_rows(spark):
    labels = corpus(spark)[1]
    rows = quality.digest(awkward(spark), labels).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert quality.digest(empty(spark), labels).count() == 0
    assert {r.score for r in quality.digest(awkward(spark), labels.limit(0)).collect()} == {0.5}
