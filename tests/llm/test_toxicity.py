import random
import zlib

import numpy as np
import pytest
from marketloom.llm import toxicity
from pyspark.sql import functions as F

from .helpers import awkward, documents, empty


def maximal(scores, lo=0, hi=None):
    """All maximal-scoring segments by their definition: take the best, then each side of it."""
    hi = len(scores) if hi is None else hi
    best = None
    for a in range(lo, hi):
        total = 0
        for b in range(a, hi):
            total += scores[b]
            if total > 0 and (best is None or total > best[2]):
                best = (a, b + 1, total)
    if best is None:
        return []
    return maximal(scores, lo, best[0]) + [best] + maximal(scores, best[1], hi)


@pytest.mark.parametrize("seed", range(20))
def test_segments_match_the_definition(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-3, -1, -1, -0.5, 2, 1.37, 4.11]) + rng.random() / 1000 for _ in range(rng.randrange(40))]
    got = toxicity.segments(np.array(scores))
    want = maximal(scores)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def corpus(spark, n=600):
    rng = random.Random(7)
    words, bad = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)], ["rude", "nasty", "vile"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = [rng.choice(words) for _ in range(rng.randrange(50, 150))]
        if toxic:
            for _ in range(4):
                text[rng.randrange(20, 40)] = rng.choice(bad)
        rows.append((i, " ".join(text), f"s{i % 3}"))
        labels.append((i, 1, int(toxic)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    rows = toxicity.digest(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus(spark, 200)
    flipped = labels.withColumn("toxic", F.when(toxicity.fold("doc_id", 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted((r.doc_id, r.score) for r in toxicity.digest(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_passages_lie_where_the_words_are(spark):
    docs, labels = corpus(spark)
    found = toxicity.passages(docs, toxicity.fitted(docs, labels)).collect()
    assert len({r.doc_id for r in found if r.doc_id % 5 == 0}) > 40
    assert all(15 <= r.first < r.end <= 45 and r.expected < toxicity.EVALUE for r in found if r.doc_id % 5 == 0)


def test_awkward_rows_and_missing_labels(spark):
    labels = corpus(spark)[1]
    rows = toxicity.digest(awkward(spark), labels).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.digest(empty(spark), labels).count() == 0
    none = labels.limit(0)
    assert {r.predicted for r in toxicity.digest(awkward(spark), none).collect()} == {0}
    clash = awkward(spark).withColumns({"score": F.lit(1.0), "_label": F.lit(1), "_ids": F.lit(1)})
    kept = toxicity.drop_toxic(clash, labels)
    assert kept.columns == clash.columns and kept.count() == 11
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (1, 1, 1), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert toxicity.digest(awkward(spark), odd).count() == 11
