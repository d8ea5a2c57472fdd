import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from marketloom.llm import repair
from marketloom.llm.common import table
from pyspark.sql import functions as F

from .helpers import SF

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def edits(symbols):
    """The cheapest edits by plain search over all rows, states and edits: (cost, audit)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, inserts):
        found = [(0, "")] if i == len(symbols) and state in ("", "a") else []
        if inserts < 2:
            for r in "ua":
                if (state, r) in step:
                    c, a = best(i, step[state, r], inserts + 1)
                    found.append((c + 3, "I" + a))
        if i < len(symbols):
            role, fault = symbols[i]
            c, a = best(i + 1, state, 0)
            found.append((c + 4, "D" + a))
            if fault in (None, "truncated"):
                late = 3 if fault else 0
                if (state, role) in step:
                    c, a = best(i + 1, step[state, role], 0)
                    found.append((c + late, "K" + a))
                for r in "ua":
                    if (state, r) in step:
                        c, a = best(i + 1, step[state, r], 0)
                        found.append((c + late + 3, "R" + a))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def plain(rows):
    """One conversation's summary and repaired rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
    seen, symbols, faults = set(), [], []
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
        symbols.append((role[:1], fault))
    cost, audit = edits(tuple(symbols))
    turns = [r[1] for r in rows if r[1] is not None]
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    lines, at, last = [], 0, ""
    for letter in audit:
        if letter == "K":
            last = rows[at][2][:1]
            lines.append(f"{rows[at][2]}:{rows[at][3]}")
        elif letter != "D":
            last = "a" if last == "u" else "u"
            lines.append(("assistant" if last == "a" else "user") + ":" + ("" if letter == "I" else rows[at][3]))
        at += letter != "I"
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    groups = {r[0]: [] for r in rows}
    for r in damage(rows):
        groups[r[0]].append(r)
    return {k: plain(v) for k, v in groups.items()}


def got(df):
    out = {}
    for r in repair.digest(df).collect():
        assert r.conv_id not in out
        out[r.conv_id] = tuple(r)[1:]
    return out


def hard_rows(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "open", "  ", "", None, f"word {rng.random()}?", "Yes.  \n", "ünï "])
            rows.append((rng.choice([c, c, c, c, None]), rng.choice([t, t, t, None, 3]), role, text))
    return rows


def test_query_matches_brute_force(spark):
    df = table(spark, SF, "conversations")
    want = expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert got(df) == want and len({w[6] for w in want.values()}) > 10


@pytest.mark.parametrize("seed,bits", [(0, 16), (1, 2), (2, 1)])
def test_hard_rows_and_split_conversations(spark, monkeypatch, seed, bits):
    """Null and odd values, ties, repeated rows; with small blocks every conversation is cut into several."""
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rows = hard_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"key": F.lit(1), "block": F.lit(2), "text_x": F.lit("z")})
    assert got(df) == expected(rows)


def test_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 8)
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"line {rng.randrange(2000)}" + rng.choice([".", ""])) for t in range(3000)] + [(8, 0, "user", "Hi. " * 50_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    fixed = repair.repair(df)
    long_, short = sorted(fixed.summary.collect())
    roles = [r.role[0] for r in fixed.rows.filter("conv_id = 7").orderBy("block", "seq").collect()]
    assert "".join(roles) == "ua" * (len(roles) // 2) and len(long_.audit) >= 3000 and short.audit == "KI"
    seen, dups = set(), 0
    for r in rows[:3000]:
        dups += r[2:] in seen
        seen.add(r[2:])
    assert long_.duplicate == dups
    truncated_kept = sum(a != "D" and not r[3].endswith(".") for a, r in zip([x for x in long_.audit if x != "I"], rows))
    assert long_.cost == 4 * long_.audit.count("D") + 3 * (long_.audit.count("I") + long_.audit.count("R") + truncated_kept)


def test_small_tables(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == {}
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = got(spark.createDataFrame([(dropped, 0, "user", "Hello.")], SCHEMA))
    assert one == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
