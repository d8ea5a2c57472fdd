from marketloom.llm import preference
from marketloom.llm.common import table
from pyspark.sql import functions as F

from .helpers import SF

TURNS = "array<struct<role: string, text: string>>"


def render(turns):
    text, spans = "", []
    for role, t in turns:
        text += f"<|{role}|>\n"
        if role == "assistant":
            spans.append((len(text), len(text) + len(t) + len("<|end|>\n")))
        text += t + "<|end|>\n"
    return text, spans


def plain(c, r):
    n = 0
    while n < min(len(c), len(r)) and c[n] == r[n]:
        n += 1
    return (n, render(c[:n])[0], *render(c[n:]), *render(r[n:]))


def check(rows, pairs):
    got = {r.k: (r.prompt_turns, r.prompt, r.chosen, [tuple(s) for s in r.chosen_spans], r.rejected, [tuple(s) for s in r.rejected_spans]) for r in rows}
    assert got == {k: plain(c or [], r or []) for k, c, r in pairs}


def test_pairs_match_plain_rendering(spark):
    u, a = ("user", "hi"), ("assistant", "it's\nme")
    pairs = [
        (1, [u, a], [u, ("assistant", "no")]), (2, [u, a, u, a], [u, a]), (3, [a], [u]), (4, [u, a], [u, a]), (5, [], [u]), (6, None, [a]), (7, [], []),
        (8, [("", ""), a], [("", ""), u]), (9, [u] * 50 + [a], [u] * 50 + [u]), (10, [u, a], [u, a, u]),
    ]
    df = spark.createDataFrame(pairs, f"k int, chosen {TURNS}, rejected {TURNS}")
    check(preference.format_pairs(df, ["k"]).collect(), pairs)


def test_query_on_the_given_table(spark):
    turns = table(spark, SF, "conversations")
    convs = {}
    for r in sorted(turns.collect()):
        convs.setdefault(r.conv_id, []).append((r.role, r.text))
    rows = preference.digest(turns).collect()
    with_reply = {k for k, t in convs.items() if any(role == "assistant" for role, _ in t)}
    assert {r.conv_id for r in rows} == with_reply == {r.donor for r in rows} and len(rows) == len(with_reply)
    for r in rows:
        c = convs[r.conv_id]
        last = max(i for i, (role, _) in enumerate(c) if role == "assistant")
        reply = [t for t in convs[r.donor] if t[0] == "assistant"][-1]
        want = plain(c, c[:last] + [reply])
        assert (r.prompt_turns, r.prompt, r.chosen, [tuple(s) for s in r.chosen_spans], r.rejected) == want[:5]
        assert all(r.chosen[a:b].endswith("<|end|>\n") for a, b in r.chosen_spans)


def test_awkward_turns(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, 1, "assistant", "x"), (None, 0, "assistant", "y"), (2, None, "assistant", None), (3, 0, "user", "only")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumns({"n": F.lit(1), "last": F.lit(2), "_all": F.lit(3)})
    got = preference.digest(turns).collect()
    assert sorted((r.conv_id is None, r.conv_id or 0) for r in got) == [(False, 1), (False, 2), (True, 0)]
    one = preference.digest(turns.filter("conv_id = 1")).collect()
    assert len(one) == 1 and one[0].chosen == "" and one[0].prompt_turns == 3
    assert preference.digest(turns.limit(0)).count() == 0
