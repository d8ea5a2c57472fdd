import random

import pytest
from marketloom.operators import components
from marketloom.session import cut


def plain(links):
    root = {x: x for pair in links for x in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed = changed or root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("seed", range(3))
def test_roots_match_label_spreading(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(1000, 1000 + i) for i in range(1, 300)] + [(2000 + i, 1999) for i in range(300)] + links[:20]
    df = spark.createDataFrame(links + [(None, 3), (5000, None), (6000, 6000)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.connected(df).collect()}
    want = plain([x for x in links if x[0] != x[1]])
    assert got == want


def test_a_chain_of_ten_thousand_takes_few_rounds(spark, monkeypatch):
    ids = list(range(10_000))
    random.Random(0).shuffle(ids)
    rounds = []
    monkeypatch.setattr(components, "cut", lambda df: rounds.append(1) or cut(df))
    got = components.connected(spark.createDataFrame(list(zip(ids, ids[1:])), "a bigint, b bigint")).collect()
    assert len(got) == 10_000 and {r.root for r in got} == {0} and len(rounds) < 20


def test_no_links(spark):
    assert components.connected(spark.createDataFrame([], "a string, b string")).count() == 0
