from collections import Counter

import re

from marketloom.llm import decontaminate
from marketloom.llm.common import table
from pyspark.sql import functions as F

from .helpers import SF, awkward, documents, empty

ITEM = [f"item{i}" for i in range(50)]


def shingles(words):
    k = min(5, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def best(text, item):
    """The highest similarity of a window as long as the item, at any place."""
    words, n = re.findall(r"[^\W_]+", (text or "").lower()), len(item)
    want, top = shingles(item), 0.0
    for start in range(-n // 5, max(1, len(words) - n + n // 5 + 1)):
        got = shingles(words[max(0, start): start + n])
        top = max(top, sum((got & want).values()) / max(1, sum((got | want).values())))
    return top


def test_matches_every_window(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    wanted = {r.item_id: re.findall(r"[^\W_]+", r.text.lower()) for r in items.collect()}
    extra = documents(spark, [
        (900 + k, "before this " + " ".join(w for i, w in enumerate(wanted[k]) if i != len(wanted[k]) // 2) + " and after", "s") for k in range(20)
    ])
    all_ = docs.union(extra)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.digest(all_, items).collect()}
    want = {}
    for r in all_.collect():
        words = " ".join(re.findall(r"[^\W_]+", r.text.lower()))
        for k, item in wanted.items():
            if any(" ".join(s) in words for s in shingles(item)) and (s := best(r.text, item)) >= 0.8:
                want[r.doc_id, k] = s
    assert want and {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_edits_and_ends(spark):
    item = spark.createDataFrame([(1, " ".join(ITEM)), (2, ""), (3, None), (4, "three word item")], "item_id bigint, text string")
    edited = list(ITEM)
    edited[20] = "other"
    broken = [w if i % 4 else "x" for i, w in enumerate(ITEM)]
    docs = documents(spark, [
        (1, "start " + " ".join(ITEM).upper() + " end", "a"), (2, "start, " + ", ".join(edited) + ".", "a"), (3, " ".join(broken), "a"),
        (4, " ".join(ITEM[3:]) + " tail", "a"), (5, "a three-word item", "a"), (6, "nothing of it", "a"),
    ])
    rows = {(r.doc_id, r.item_id): r for r in decontaminate.digest(docs, item).collect()}
    assert set(rows) == {(1, 1), (2, 1), (4, 1), (5, 4)}
    assert rows[1, 1].similarity == 1.0 and rows[1, 1].first_word == 1 and rows[1, 1].differing_bits == 0
    assert rows[2, 1].similarity == 41 / 51
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, item).collect()} == {3, 6}


def test_awkward_rows(spark):
    items = table(spark, SF, "benchmark")
    assert decontaminate.digest(awkward(spark), items).count() == 0
    clash = awkward(spark).withColumns({"w": F.lit(1), "text_key": F.lit("x"), "item_id": F.lit(2)})
    kept = decontaminate.drop_contaminated(clash, items)
    assert kept.columns == clash.columns and kept.count() == 11
    assert decontaminate.digest(empty(spark), items).count() == 0
    assert decontaminate.drop_contaminated(awkward(spark), items.limit(0)).count() == 11


def test_no_python_in_the_plan(spark):
    plan = decontaminate.digest(table(spark, SF, "documents"), table(spark, SF, "benchmark"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_edits_at_the_edge_are_found_whatever_their_bits(spark):
    """Of items with their last words replaced (similarity 0.8 and more) 1 to 3 in 100 differ in over 14 bits."""
    items, rows = [], []
    for seed, (n, k) in enumerate([(54, 5), (59, 5), (19, 1), (39, 3)] * 100):
        words = [f"e{seed}x{i}" for i in range(n)]
        items.append((seed, " ".join(words)))
        rows.append((seed, "before " + " ".join(words[: n - k] + [f"o{seed}x{i}" for i in range(k)]) + " after", "s"))
    for seed, (n, k) in enumerate([(54, 10), (39, 7), (19, 3)] * 100, 1000):
        words = [f"e{seed}x{i}" for i in range(n)]
        items.append((seed, " ".join(words)))
        rows.append((seed, "before it " + " ".join(words[: n - k]), "s"))
    held = decontaminate.digest(documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = {(i, i) for (i, text, _), (_, item) in zip(rows, items) if best(text, item.split()) >= 0.8}
    assert len(want) >= 600 and {(r.doc_id, r.item_id) for r in held} == want
    assert max(r.differing_bits for r in held) > decontaminate.RADIUS
