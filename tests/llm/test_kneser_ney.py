import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from marketloom.llm import kneser_ney
from pyspark.sql import functions as F

from .helpers import awkward, documents, empty


def tokens(text):
    return (text or "").encode().lower().split() + ["end"]


def discounts(n):
    if min(n[1], n[2], n[3], n[4]) == 0:
        return 0.5, 1.0, 1.5
    y = n[1] / (n[1] + 2 * n[2])
    return tuple(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) for k in (1, 2, 3))


class Plain:
    """The same model in dictionaries."""

    def __init__(self, texts):
        self.c, self.pairs = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.c.update(w)
            self.pairs.update(zip(["start", *w], w))
        self.c_start = len(texts)
        self.d = discounts(Counter(self.pairs.values()))
        before, after = defaultdict(set), defaultdict(list)
        for (a, b), n in self.pairs.items():
            before[b].add(a)
            after[a].append(n)
        self.l = {w: len(x) for w, x in before.items()}
        self.e = discounts(Counter(self.l.values()))
        self.after, self.total = after, sum(self.l.values())
        self.rest = sum(self.e[min(n, 3) - 1] for n in self.l.values()) / max(self.total, 1) if self.l else 1.0

    def p(self, a, b):
        low = self.rest / (len(self.c) + 1)
        if b in self.l:
            low += max(self.l[b] - self.e[min(self.l[b], 3) - 1], 0) / self.total
        if a not in self.after:
            return low
        n = self.c_start if a == "start" else self.c[a]
        c = self.pairs.get((a, b), 0)
        gone = sum(self.d[min(x, 3) - 1] for x in self.after[a])
        return (max(c - self.d[min(c, 3) - 1], 0) if c else 0) / n + gone / n * low

    def score(self, text):
        w = tokens(text)
        return sum(math.log10(self.p(a, b)) for a, b in zip(["start", *w], w))

    def base(self, text):
        return sum(math.log10((self.c[w] + 1) / (sum(self.c.values()) + len(self.c) + 1)) for w in tokens(text))


def corpus(spark, n=120):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    return documents(spark, [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(60)], k=rng.randrange(40))), "s") for i in range(n)])


def test_matches_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "GATHER", 300)
    monkeypatch.setattr(kneser_ney, "LOOKUP", 100)
    docs = corpus(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    model = Plain([t for i, t in texts.items() if i not in held])
    rows = kneser_ney.digest(docs).collect()
    assert len(rows) == len(texts) and {r.doc_id for r in rows if r.held_out} == held
    for r in rows:
        w = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in model.c for x in w), sum(model.c.values()))
        assert r.base_score == pytest.approx(model.base(texts[r.doc_id]), abs=1e-9)
        assert r.score == pytest.approx(model.score(texts[r.doc_id]), abs=1e-6)


def test_probabilities_sum_to_one(spark):
    texts = [r.text for r in corpus(spark).collect()]
    plain = Plain(texts)
    model = kneser_ney.train(corpus(spark))
    for context in ("w0", "w7", "never"):
        words = [f"w{i}" for i in range(60) if f"w{i}".encode() in plain.c]
        tries = [kneser_ney.token_hashes(f"{context} {w}") for w in [*words, "unseen"]]
        log_p, _ = kneser_ney.token_scores(tries, model)
        end, _ = kneser_ney.token_scores([kneser_ney.token_hashes(context)], model)
        assert sum(10 ** log_p[1::3]) + 10 ** end[1] == pytest.approx(1.0, abs=1e-9)


def test_held_out_texts_fit_better_than_the_base(spark):
    text = [f"a{i} b{i} c{i}" for i in range(40)]
    docs = documents(spark, [(i, " ".join(random.Random(i).choices(text, k=30)), "s") for i in range(100)])
    rows = kneser_ney.digest(docs).filter("held_out").collect()
    assert rows and all(r.score > r.base_score for r in rows)


def test_awkward_rows(spark):
    rows = kneser_ney.digest(awkward(spark)).collect()
    assert len(rows) == 11 and all(r.score <= 0 and np.isfinite(r.score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 8)} == {1}
    assert kneser_ney.digest(empty(spark)).count() == 0
    model = kneser_ney.train(empty(spark))
    scored = kneser_ney.score(awkward(spark).withColumn("score", F.lit(1)), model).collect()
    assert len(scored) == 11 and all(np.isfinite(r.score) for r in scored)
