"""Language identification: script ranges narrow the candidates, and Viterbi over word scores labels spans of one language."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .toxicity import fold

#: A character with its neighbours in the word falls into one of BUCKETS; the model has a number for each and each language.
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
CHUNK = 4096
SMOOTHING = 0.1
#: Cost (nats) of a change of language between two words.
SWITCH = 10.0
#: A language is a candidate for words in a script that has at least this share of its letters.
SCRIPT_SHARE = 0.05
FORBIDDEN = -1e6
#: Code points that are handled together; a longer text is handled alone, its scores in pieces of this size.
PIECE = 1 << 22
NONE = "und"

#: The Unicode blocks of scripts. Letters elsewhere are one script more.
SCRIPTS = [
    ("Latin", [(0x0041, 0x024F), (0x0250, 0x02AF), (0x1D00, 0x1DBF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)]),
    ("Greek", [(0x0370, 0x03FF), (0x1F00, 0x1FFF)]),
    ("Cyrillic", [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("Armenian", [(0x0530, 0x058F), (0xFB13, 0xFB17)]),
    ("Hebrew", [(0x0590, 0x05FF), (0xFB1D, 0xFB4F)]),
    ("Arabic", [(0x0600, 0x06FF), (0x0750, 0x077F), (0x0870, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFE)]),
    ("Syriac", [(0x0700, 0x074F)]),
    ("Thaana", [(0x0780, 0x07BF)]),
    ("Devanagari", [(0x0900, 0x097F), (0xA8E0, 0xA8FF)]),
    ("Bengali", [(0x0980, 0x09FF)]),
    ("Gurmukhi", [(0x0A00, 0x0A7F)]),
    ("Gujarati", [(0x0A80, 0x0AFF)]),
    ("Oriya", [(0x0B00, 0x0B7F)]),
    ("Tamil", [(0x0B80, 0x0BFF)]),
    ("Telugu", [(0x0C00, 0x0C7F)]),
    ("Kannada", [(0x0C80, 0x0CFF)]),
    ("Malayalam", [(0x0D00, 0x0D7F)]),
    ("Sinhala", [(0x0D80, 0x0DFF)]),
    ("Thai", [(0x0E00, 0x0E7F)]),
    ("Lao", [(0x0E80, 0x0EFF)]),
    ("Tibetan", [(0x0F00, 0x0FFF)]),
    ("Myanmar", [(0x1000, 0x109F)]),
    ("Georgian", [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)]),
    ("Hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)]),
    ("Ethiopic", [(0x1200, 0x139F), (0x2D80, 0x2DDF)]),
    ("Khmer", [(0x1780, 0x17FF)]),
    ("Mongolian", [(0x1800, 0x18AF)]),
    ("Kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)]),
    ("Han", [(0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)]),
]
OTHER = len(SCRIPTS) + 1
#: Marks that go with any script, as U+0301.
INHERITED = 255


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its script (0: no part of a word), whether it is a letter, and its lower case where that is one code point."""
    every = range(0x110000)
    kind = np.fromiter((ord(unicodedata.category(chr(i))[0]) for i in every), np.uint8, 0x110000)
    script = np.where((kind == ord("L")) | (kind == ord("M")), OTHER, 0).astype(np.uint8)
    script[(kind == ord("M")) & (np.arange(0x110000) < 0x0370)] = INHERITED
    for i, (_, ranges) in enumerate(SCRIPTS):
        for a, b in ranges:
            part = script[a: b + 1]
            part[(part != 0) & (part != INHERITED)] = i + 1
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(kind == ord("L")).tolist():
        small = chr(i).lower()
        if len(small) == 1:
            lower[i] = ord(small)
    return script, kind == ord("L"), lower


@dataclass
class Words:
    """The words of some texts: place in ``points`` (their code points, lower-cased), text, script and number of letters."""

    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    first: np.ndarray

    def pieces(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first word, end, buckets, where each word's buckets begin) of some words at a time: a bucket for each character."""
        at = 0
        while at < len(self.start):
            to = max(at + 1, int(np.searchsorted(self.start, self.start[at] + PIECE)))
            lengths = self.end[at:to] - self.start[at:to]
            begin = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(begin - self.start[at:to], lengths)
            here = self.points[place].astype(np.uint64)
            before, after = np.concatenate(([0], here[:-1])).astype(np.uint64), np.concatenate((here[1:], [0])).astype(np.uint64)
            before[begin] = 0
            after[begin + lengths - 1] = 0
            mixed = (before * np.uint64(0x1F123BB5) + here) * np.uint64(0x9E3779B97F4A7C15) + after * np.uint64(0xC2B2AE3D27D4EB4F)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield at, to, (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), begin
            at = to


def words(texts: list[str]) -> Words:
    """Words are runs of letters and marks of one script."""
    script_of, letter_of, lower = tables()
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    script = script_of[points]
    inherits = script == INHERITED
    if inherits.any():
        script = script[np.maximum.accumulate(np.where(inherits, 0, np.arange(len(script))))]
        script[script == INHERITED] = 0
    edge = np.flatnonzero(script[1:] != script[:-1]) + 1
    bounds = np.concatenate(([0], edge, [len(script)])) if len(script) else np.zeros(1, np.int64)
    start, end = bounds[:-1], bounds[1:]
    real = script[start] != 0 if len(start) else np.zeros(0, bool)
    start, end = start[real], end[real]
    total = np.concatenate(([0], np.cumsum(letter_of[points])))
    letters = total[end] - total[start]
    start, end, letters = start[letters > 0], end[letters > 0], letters[letters > 0]
    return Words(lower[points], start, end, np.searchsorted(first, start, "right") - 1, script[start], letters, first)


def grouped(texts: list[str]) -> Iterator[list[int]]:
    """Places of texts, longest first, in groups of about PIECE code points: texts of like length are labelled together."""
    group, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        if group and size + len(texts[i]) > PIECE:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(texts[i])
    if group:
        yield group


@dataclass
class Model:
    """Log-probability of each bucket by language, and which languages are candidates by script."""

    languages: list[str]
    log_share: np.ndarray
    allowed: np.ndarray

    def scores(self, found: Words) -> np.ndarray:
        """A score for each word and language. Languages that do not use the word's script are out, unless none does."""
        out = np.zeros((len(found.start), len(self.languages)), np.float32)
        for a, b, buckets, begin in found.pieces():
            out[a:b] = np.add.reduceat(self.log_share[buckets], begin, axis=0)
        allowed = self.allowed[found.script]
        some = allowed.any(axis=1)
        out[~some] = 0
        out[some[:, None] & ~allowed] = FORBIDDEN
        return out


def train(docs: DataFrame, use: Column, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows that fulfil ``use`` and have a language: nothing is sampled.

    Each task sums buckets by language; sums of all tasks are added by (language, chunk of buckets). The driver gets
    BUCKETS numbers a language. A null text teaches nothing, a language without letters has no candidates of its own.
    """
    def rows(sums: dict[tuple[str, int], np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["lang", "chunk", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            named, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for one in sorted(set(named)):
                mine = [t for t, n in zip(texts, named) if n == one]
                own = found.setdefault(one, np.zeros(BUCKETS, np.int64))
                letters = scripts.setdefault(one, np.zeros(256, np.int64))
                for group in grouped(mine):
                    these = words([mine[i] for i in group])
                    np.add.at(letters, these.script, these.letters)
                    for _, _, buckets, _ in these.pieces():
                        own += np.bincount(buckets, minlength=BUCKETS)
        for one in found:
            parts = {(one, c): found[one][c * CHUNK: (c + 1) * CHUNK] for c in range(BUCKETS // CHUNK)}
            yield rows({k: v for k, v in parts.items() if v.any()} | {(one, -1): scripts[one]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for one, chunk, counts in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.frombuffer(counts, np.int64)
                sums[one, chunk] = sums[one, chunk] + counts if (one, chunk) in sums else counts
        if sums:
            yield rows(sums)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "lang string, chunk int, counts binary"
    known = docs.filter(use & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    found = known.mapInArrow(count, schema).repartition(parts, "lang", "chunk").mapInArrow(add, schema).toArrow().to_pylist()
    languages = sorted({r["lang"] for r in found})
    counts = np.zeros((BUCKETS, len(languages)))
    letters = np.zeros((256, len(languages)))
    for r in found:
        numbers = np.frombuffer(r["counts"], np.int64)
        if r["chunk"] < 0:
            letters[:, languages.index(r["lang"])] = numbers
        else:
            counts[r["chunk"] * CHUNK: (r["chunk"] + 1) * CHUNK, languages.index(r["lang"])] = numbers
    share = (counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)
    allowed = (letters > 0) & (letters >= SCRIPT_SHARE * letters.sum(axis=0))
    return Model(languages, np.log(share).astype(np.float32), allowed)


def best_labels(scores: np.ndarray, text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The labels of the words that maximise the sum of scores less ``switch`` for each change inside a text.

    ``text`` numbers the texts, in runs. All texts go forward together, word by word, the longest first, and then back.
    Of equal choices a word keeps its predecessor's label, or else takes the first language.
    """
    if not len(scores):
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    lengths = np.diff(np.concatenate((starts, [len(text)])))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    width = scores.shape[1]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left").tolist()
    back = np.empty(scores.shape, np.uint16)
    value = np.zeros((len(starts), width))
    own = np.arange(width, dtype=np.uint16)
    for t, k in enumerate(active):
        v = value[:k]
        from_ = v.argmax(axis=1)
        least = v[np.arange(k), from_, None] - switch
        at = starts[:k] + t
        back[at] = np.where(v >= least, own, from_[:, None])
        v = np.maximum(v, least) + scores[at]
        value[:k] = v - v.max(axis=1, keepdims=True)
    out = np.empty(len(scores), np.int64)
    now = value.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        at = starts[: active[t]] + t
        out[at] = now[: active[t]]
        now[: active[t]] = back[at, now[: active[t]]]
    return out


def spans(docs: DataFrame, model: Model, keep: list[str], text: str = "text", switch: float = SWITCH) -> DataFrame:
    """The columns ``keep`` with ``lang``, ``score`` and ``spans``, an array of (start, end, lang), for every row.

    Each word of a text gets a language (``best_labels``); words of one language in a row are a span, by code points.
    ``lang`` is the one with the most letters (of equals the first by name), ``score`` its share of the letters times its
    probability among the languages by the words that it labels. A null text, one without letters, and any text
    if the model has no language: ``und``, score 0, no spans. Whole texts are read, of any length; no row meets another,
    so repeated rows and null keys are rows like any others, an empty table gives an empty table. ``keep`` may hold any
    columns but those three.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        width = max(1, len(model.languages))
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            n = len(texts)
            lang, share, runs = [NONE] * n, np.zeros(n), []
            for group in grouped(texts) if model.languages else []:
                found = words([texts[i] for i in group])
                if not len(found.start):
                    continue
                scores = model.scores(found)
                labels = best_labels(scores, found.text, switch)
                letters = np.bincount(found.text * width + labels, found.letters, len(group) * width).reshape(-1, width)
                first = letters.argmax(axis=1)
                chosen = labels == first[found.text]
                total = np.zeros((len(group), width))
                np.add.at(total, found.text[chosen], scores[chosen])
                odds = np.exp(np.clip(total - total[np.arange(len(group)), first, None], -700, 700)).sum(axis=1)
                every = letters.sum(axis=1)
                edge = np.flatnonzero(np.concatenate(([True], (labels[1:] != labels[:-1]) | (found.text[1:] != found.text[:-1]))))
                ends = np.concatenate((edge[1:], [len(labels)])) - 1
                for a, b in zip(edge.tolist(), ends.tolist()):
                    d = found.text[a]
                    runs.append((group[d], int(found.start[a] - found.first[d]), int(found.end[b] - found.first[d]), model.languages[labels[a]]))
                for d, i in enumerate(group):
                    if every[d]:
                        lang[i] = model.languages[first[d]]
                        share[i] = letters[d, first[d]] / every[d] / max(odds[d], 1.0)
            at = [[] for _ in range(n)]
            for i, a, b, one in runs:
                at[i].append({"start": a, "end": b, "lang": one})
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang), pa.array(share), pa.array(at, kind)], names=[*keep, "lang", "score", "spans"])

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", lang string, score double, spans array<struct<start: bigint, end: bigint, lang: string>>"
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """What the language query returns: one row for each row of ``docs``; a third of the ids, by checksum, teach nothing."""
    held_out = fold("doc_id", 3) == 1
    model = train(docs, ~held_out)
    found = spans(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), F.col("lang").alias("lang_pred"), "score", F.size("spans").alias("n_spans"))
