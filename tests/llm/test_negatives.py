import math
import random

import numpy as np
import pytest
from marketloom.llm import negatives
from marketloom.llm.common import table
from pyspark.sql import functions as F

from .helpers import SF

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows):
    """Negatives of every anchor by sorting all rows."""
    used = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        used.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    last = lambda i: 10**30 if i is None else i
    out = []
    for n, (i, v, label) in enumerate(used):
        if i is None or i % 100:
            continue
        all_ = [(-sum(x * y for x, y in zip(v, w)), last(j), m, j, k) for m, (j, w, k) in enumerate(used) if m != n]
        all_.sort()
        for p in [x for x in all_ if x[4] == label][:5]:
            fit = [x for x in all_ if x[4] != label and -30 * p[0] <= -100 * x[0] <= -90 * p[0]][:10]
            out += [(i, p[3], r + 1, x[3], -p[0], -x[0]) for r, x in enumerate(fit)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in negatives.digest(df).collect()), key=str)


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 7), (64, 64, 64), (33, 70, 129), (0, 4, 3), (100, 65, 40)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(0)
    n, k, m = shape
    for most in (10, 2**20, 2**28):
        a, b = rng.integers(-most, most, (n, k)), rng.integers(-most, most, (k, m))
        assert np.array_equal(negatives.strassen(a, b, leaf=4), a @ b)


def test_windows():
    row = np.array([90, 90, 89, 31, 30, 29, 0, 0, -5])
    for p in (100, 99, 1, 0, -3, 7, 33):
        fit = [i for i, n in enumerate(row) if 30 * p <= 100 * n <= 90 * p][:3]
        assert np.arange(9)[negatives.in_window(row, p, 3)].tolist() == fit


def test_query_matches_brute_force(spark):
    df = table(spark, SF, "embeddings")
    want = plain([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert got(df) == want and len(want) > 20


@pytest.mark.parametrize("seed", range(2))
def test_ties_repeats_nulls_and_many_parts(spark, monkeypatch, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(2600):
        v = [rng.choice([0.0, 0.5, 1.0, -0.25, 0.1]) for _ in range(rng.choice([3, 4, 4, 4]))]
        rows.append((rng.choice([i, i, i, i, None, i - 1]), v, rng.choice([0, 0, 0, 1, 2, None])))
    rows += [(100, [1.0, 1.0, 1.0, 1.0], 1)] * 3 + [(200, None, 1), (300, [float("nan"), 1.0], 1), (400, [1.0, None], 2), (500, [], 0), (600, [float("inf")], 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"id": F.lit(1), "part": F.lit(2), "n": F.lit(3), "row": F.lit(4)})
    monkeypatch.setattr(negatives, "TILE_ROWS", 7)
    assert got(df) == plain(rows)


def test_small_tables(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(100, [1.0], 1), (1, [1.0], 1)], SCHEMA)) == []
    with pytest.raises(Exception, match="64 bits"):
        got(spark.createDataFrame([(100, [1e20], 1), (1, [1e20], 1)], SCHEMA))
