import hashlib
import random

import pytest
from marketloom.llm import chunks
from marketloom.llm.common import table

from .helpers import SF, awkward, documents, empty


def plain(data):
    """Boundaries byte by byte."""
    h, flags = 0, []
    for b in data:
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        flags.append(h)
    ends, start = [], 0
    while len(data) - start > chunks.LEAST:
        end = min(start + chunks.MOST, len(data))
        for at in range(start + chunks.LEAST, end + 1):
            zeros = chunks.STRICT if at < start + chunks.USUAL else chunks.LOOSE
            if flags[at - 1] >> (32 - zeros) == 0:
                end = at
                break
        ends.append(end)
        start = end
    return ends + ([len(data)] if start < len(data) else [])


@pytest.mark.parametrize("seed", range(10))
def test_boundaries_match_a_byte_loop(seed):
    rng = random.Random(seed)
    data = bytes(rng.choice(b"abcdefgh \n") for _ in range(rng.choice([0, 1, 24, 25, 100, 5000])))
    assert chunks.boundaries(data) == plain(data)


def test_inserted_text_moves_boundaries_along():
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(10**5)}" for _ in range(2000))
    a, b = chunks.chunk_set(text), chunks.chunk_set(text[:3000] + "some new words " + text[3000:])
    assert chunks.containment(a, b) > 0.97 and chunks.containment(a, a) == 1.0
    assert chunks.containment(a, chunks.chunk_set(" ".join(f"v{rng.randrange(10**5)}" for _ in range(2000)))) == 0.0


def expected(rows):
    out = {}
    order = sorted(rows)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        a, x, b = chunks.chunk_set(t), chunks.chunk_set(e), chunks.chunk_set(n)
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), chunks.as_text(a), chunks.as_text(x), chunks.containment(a, x), chunks.containment(a, b))
    return out


def test_query_matches_a_plain_walk(spark):
    docs = table(spark, SF, "documents")
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    rows = chunks.digest(docs).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)


def test_awkward_rows(spark):
    rows = chunks.digest(awkward(spark)).collect()
    assert len(rows) == 11
    assert {(r.n_chars, r.fingerprint) for r in rows if r.doc_id in (3, 4)} == {(0, "")}
    assert next(r for r in rows if r.doc_id == 3).near_next == 1.0
    one = chunks.digest(documents(spark, [(5, "abcdef", "s")])).collect()
    assert [tuple(r) for r in one] == [(5, *expected([(5, "abcdef")])[5])]
    assert chunks.digest(empty(spark)).count() == 0
    assert chunks.fingerprints(awkward(spark), ["doc_id", "source"]).count() == 11
