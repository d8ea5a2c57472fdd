import numpy as np
from marketloom.llm import mixture
from pyspark.sql import functions as F

from .helpers import awkward, documents, empty


def schedule(units):
    """Earliest deadline first among released blocks, slot by slot."""
    w, had, out = sum(units), [0] * len(units), []
    for t in range(w):
        ready = [(-(-(j + 1) * w // u), i) for i, (j, u) in enumerate(zip(had, units)) if j * w // u <= t]
        i = min(ready)[1]
        had[i] += 1
        out.append(i)
    return out


def test_period_is_earliest_deadline_first_and_stays_within_a_block(spark):
    for units in ([1], [5, 3, 2], [50, 25, 25], [97, 1, 1, 1], [7] * 9, [40, 13, 11, 9, 2, 1]):
        rows = mixture.period(spark.createDataFrame(list(enumerate(units)), "sid int, units bigint")).collect()
        got = [sid for _, sid in sorted((r.slot, r.sid) for r in rows)]
        assert got == schedule(units)
        share = np.array(units) / sum(units)
        counts = np.cumsum(np.eye(len(units))[got], axis=0)
        assert np.abs(counts - share * np.arange(1, len(got) + 1)[:, None]).max() < 1


def test_mixture_follows_given_weights_and_keeps_every_row(spark):
    docs = documents(spark, [(i, "x", "big" if i % 10 else "small") for i in range(2000)])
    weights = spark.createDataFrame([("big", 3.0), ("small", 1.0)], "source string, weight double")
    rows = sorted(mixture.mix(docs, weights, block=8, units=100).select("position", "slot", "source", "doc_id", "epoch").collect())
    assert len({r.position for r in rows}) == len(rows)
    assert {r.doc_id for r in rows} == set(range(2000))
    assert max(r.epoch for r in rows) == 2  # 600 places for 200 rows
    blocks = [s for _, s in sorted({(r.slot, r.source) for r in rows})]
    for t in range(1, len(blocks)):
        assert abs(blocks[:t].count("small") - t / 4) < 1


def test_rounds_are_limited_and_tiny_sources_share_an_entry(spark):
    docs = documents(spark, [(i, "x", "big") for i in range(500)] + [(1000 + i, "x", f"tiny{i}") for i in range(20)])
    rows = mixture.mix(docs, units=10, block=4, epochs=2).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert len(rows) == 520 and max(r.n for r in rows) <= 2


def test_awkward_rows(spark):
    out = mixture.mix(awkward(spark), ties=("text",))
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "epoch", "slot", "position"}
    rows = out.filter("epoch = 0").collect()
    assert len(rows) == 11
    assert mixture.mix(empty(spark)).count() == 0
    clash = awkward(spark).withColumns({c: F.lit(1) for c in ("epoch", "n", "sid", "units", "turn", "w", "_rows")})
    assert mixture.mix(clash).filter("epoch = 0").count() == 11


def test_sources_under_a_unit_keep_their_weights(spark):
    """1,500 sources of 0.00067: half have twice the weight of the others, and each is within two blocks of its target."""
    docs = spark.range(1500 * 12).selectExpr("id AS doc_id", "concat('s', id % 1500) AS source")
    weight = {f"s{i}": 2.0 if i % 2 else 1.0 for i in range(1500)}
    weights = spark.createDataFrame(list(weight.items()), "source string, weight double")
    rows = mixture.mix(docs, weights, block=1, epochs=4).select("slot", "source", "doc_id", "epoch").collect()
    assert {r.doc_id for r in rows} == set(range(1500 * 12))
    assert len({r.slot for r in rows}) == len(rows) and len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    # up to 9,000 slots no source is through, so that each has its share of every beginning
    for t in (1500, 4500, 9000):
        got = dict.fromkeys(weight, 0)
        for r in rows:
            got[r.source] += r.slot < t
        assert max(abs(got[s] - t * w / 2250) for s, w in weight.items()) < 2.3  # two blocks and the rounding
        ratio = sum(got[s] for s in weight if weight[s] == 2) / max(1, sum(got[s] for s in weight if weight[s] == 1))
        assert 1.8 < ratio < 2.2
