import random

import numpy as np
import pytest
from marketloom.llm import language
from marketloom.llm.common import table
from pyspark.sql import functions as F

from .helpers import SF, awkward, empty

ENGLISH = "the house on the hill where they were waiting for the other one and this was thought to be right with some truth"
GERMAN = "das haus auf dem hügel und die straße wo sie nicht gewartet haben aber ich möchte über das wetter sprechen zwischen"
RUSSIAN = "дом на холме где они ждали другого человека и это было правильно потому что мы хотели говорить о погоде"
UKRAINIAN = "будинок на пагорбі де вони чекали іншого чоловіка і це було правильно тому що ми хотіли говорити про погоду їжак"


def corpus(spark, extra=()):
    rng = random.Random(0)
    rows = []
    for i in range(240):
        name, source = rng.choice([("en", ENGLISH), ("de", GERMAN), ("ru", RUSSIAN), ("uk", UKRAINIAN)])
        rows.append((i, " ".join(rng.choices(source.split(), k=40)), name))
    return spark.createDataFrame(rows + list(extra), "doc_id bigint, text string, lang string")


def plain_labels(scores, switch):
    """The best labelling of one text by a full table of all languages and predecessors."""
    n, width = scores.shape
    best = [list(scores[0])]
    came = []
    for t in range(1, n):
        row, from_ = [], []
        for k in range(width):
            options = [best[-1][j] - (switch if j != k else 0) for j in range(width)]
            row.append(max(options) + scores[t, k])
            from_.append(options.index(max(options)))
        best.append(row)
        came.append(from_)
    return max(best[-1])


@pytest.mark.parametrize("seed", range(3))
def test_labels_reach_the_best_sum(seed):
    rng = np.random.default_rng(seed)
    lengths = [1, 7, 30, 2, 30, 1]
    text = np.repeat(np.arange(len(lengths)), lengths)
    scores = rng.normal(0, 4, (len(text), 3))
    got = language.best_labels(scores, text, 5.0)
    for d in range(len(lengths)):
        mine, labels = scores[text == d], got[text == d]
        total = mine[np.arange(len(labels)), labels].sum() - 5.0 * (labels[1:] != labels[:-1]).sum()
        assert abs(total - plain_labels(mine, 5.0)) < 1e-9


def test_words_and_buckets_do_not_depend_on_grouping(monkeypatch):
    texts = ["Ab cé, d1e", "", "ПриветHello мир", "école á", "123 !?", "हिन्दी भाषा", "x" * 5000 + " yz"]
    whole = language.words(texts)
    cut = [[texts[d][a - whole.first[d]: b - whole.first[d]] for a, b, d in zip(whole.start, whole.end, whole.text) if d == i] for i in range(7)]
    assert cut[0] == ["Ab", "cé", "d", "e"] and cut[2] == ["Привет", "Hello", "мир"] and cut[3] == ["école", "á"] and cut[4] == [] and cut[5] == ["हिन्दी", "भाषा"]
    all_ = np.concatenate([b for _, _, b, _ in whole.pieces()])
    monkeypatch.setattr(language, "PIECE", 3)
    assert np.array_equal(all_, np.concatenate([b for _, _, b, _ in whole.pieces()]))
    alone = np.concatenate([b for t in texts for _, _, b, _ in language.words([t]).pieces()])
    assert np.array_equal(all_, alone)


def test_counts_are_those_of_a_plain_loop(spark):
    docs = corpus(spark)
    model = language.train(docs, F.lit(True))
    rows = docs.collect()
    counts = {}
    for r in rows:
        for _, _, buckets, _ in language.words([r.text]).pieces():
            for b in buckets.tolist():
                counts[b, r.lang] = counts.get((b, r.lang), 0) + 1
    sums = {k: sum(n for (_, lang), n in counts.items() if lang == k) for k in model.languages}
    for (b, lang), n in counts.items():
        want = np.log((n + 0.1) / (sums[lang] + 0.1 * language.BUCKETS))
        assert abs(model.log_share[b, model.languages.index(lang)] - want) < 1e-4


def test_mixed_texts_are_cut_into_spans(spark):
    model = language.train(corpus(spark), F.lit(True))
    english, german, russian = (" ".join(x.split()[:9]) for x in (ENGLISH, GERMAN, RUSSIAN))
    text = f"{english}. {german}! {russian} {english} ΑΒΓ"
    docs = spark.createDataFrame([(1, text), (2, f"{english} χολη {english}"), (3, "ждали")], "doc_id bigint, text string")
    one, two, three = language.spans(docs, model, ["doc_id"]).orderBy("doc_id").collect()
    assert [s.lang for s in one.spans] == ["en", "de", "ru", "en"] and one.lang == "en"
    assert [text[s.start:s.end].split()[0] for s in one.spans] == ["the", "das", "дом", "the"]
    assert 0.3 < one.score < 0.7 and [s.lang for s in two.spans] == ["en"] and two.score > 0.99
    assert three.lang == "ru" and 0.5 < three.score <= 1


def test_query_is_right_on_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = language.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_read(spark):
    docs = table(spark, SF, "documents")
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "zz").otherwise(F.col("lang")))
    get = lambda d: sorted(tuple(r) for r in language.digest(d).collect())
    assert get(docs) == get(other)


def test_awkward_rows(spark):
    docs = awkward(spark).withColumns({"score": F.lit(1), "spans": F.lit(2), "_text": F.lit("x")})
    rows = language.digest(docs).collect()
    assert len(rows) == 11 and [r.lang_pred for r in rows if r.doc_id in (3, 4, 8)] == ["und"] * 3
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 5, 6, 7)} == {"en"} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert language.digest(empty(spark)).count() == 0
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.digest(unknown).collect()} == {"und"}
