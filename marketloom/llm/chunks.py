"""Document fingerprints by content-defined chunking."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

LEAST, USUAL, MOST = 24, 64, 256
#: A boundary before the usual size needs STRICT zero bits at the top of the hash, one after it only LOOSE.
STRICT, LOOSE = 7, 5
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], np.uint32)


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``.

    The gear hash at a byte is the sum of the table values of the last 32 bytes, each shifted by its distance. It is
    built for all bytes at once by doubling the window, so it does not depend on where a chunk began, and boundaries
    move along with the text. A chunk ends at the first strict boundary from LEAST bytes on, else at the first loose
    one from USUAL bytes on, else after MOST bytes.
    """
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = GEAR[np.frombuffer(data, np.uint8)]
    for shift in (1, 2, 4, 8, 16):
        if shift < n:
            h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift))
    loose = np.flatnonzero(h >> np.uint32(32 - LOOSE) == 0)
    strict = (loose[h[loose] >> np.uint32(32 - STRICT) == 0] + 1).tolist()
    loose = (loose + 1).tolist()
    ends, start = [], 0
    while n - start > LEAST:
        end = min(start + MOST, n)
        i = bisect_left(strict, start + LEAST)
        if i < len(strict) and strict[i] < start + USUAL:
            end = min(end, strict[i])
        else:
            i = bisect_left(loose, start + USUAL)
            if i < len(loose):
                end = min(end, loose[i])
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def chunk_set(text: str) -> dict[int, int]:
    """48-bit digest -> length of the distinct chunks of a text, by its UTF-8 bytes."""
    data = text.encode("utf-8", "surrogatepass")
    out, start = {}, 0
    for end in boundaries(data):
        out[xxhash.xxh64_intdigest(data[start:end]) >> 16] = end - start
        start = end
    return out


def as_text(chunks: dict[int, int]) -> str:
    """The fingerprint: for each chunk 12 hex digits of digest and 4 of length, in order of digest."""
    return "".join(f"{d:012x}{chunks[d]:04x}" for d in sorted(chunks))


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of the chunk bytes of ``a`` that ``b`` has too; an empty text is contained in an empty one only."""
    if not a:
        return 0.0 if b else 1.0
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def edited(text: str, other: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first code points of ``other``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``fingerprint`` for every row; a null text counts as empty, with an empty fingerprint."""
    types = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            prints = [as_text(chunk_set(texts[i].as_py() or "")) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints, pa.string())], names=[*batch.schema.names[:-1], "fingerprint"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", fingerprint string")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: natural text is then about half as large in the shuffle."""
    for batch in batches:
        texts = batch.column(2)
        packed = [zlib.compress(texts[i].as_py().encode("utf-8", "surrogatepass"), 1) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(packed, pa.binary())], names=["doc_id", "tie", "packed"])


RESULT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(text: str, chunks: dict[int, int], after: str, after_chunks: dict[int, int]) -> tuple:
    new = edited(text, after)
    new_chunks = chunk_set(new)
    return (
        len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), as_text(chunks), as_text(new_chunks),
        containment(chunks, new_chunks), containment(chunks, after_chunks),
    )


def digest(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, of its edited text, and how far the next document holds it.

    The next document by ascending doc_id (null first; equal ids by text) has to meet its predecessor: the rows are
    range-partitioned by doc_id and sorted, each text is shuffled once (packed), and each task walks its rows in order. The last
    row of a task waits for the first row of the next: those two texts for each task are written beside the results, and
    paired afterwards. The last document's next is the first. One document is its own next. Null text: empty.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    placed = named.mapInArrow(_pack, "doc_id bigint, tie bigint, packed binary").repartitionByRange(parts, "doc_id", "tie")
    walked = placed.sortWithinPartitions("doc_id", "tie").select("doc_id", "packed", F.spark_partition_id().alias("part"))
    schema = f"doc_id bigint, {RESULT}, part int, place int, text string"
    names = ["doc_id", *[c.split()[0] for c in RESULT.split(", ")], "part", "place", "text"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.string()]
    blank = (None,) * 6

    def table_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = part = None
        for batch in batches:
            out = []
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, key in enumerate(ids):
                text = zlib.decompress(texts[i].as_py()).decode("utf-8", "surrogatepass")
                chunks = chunk_set(text)
                if before is None:
                    part = batch.column(2)[i].as_py()
                    out.append((key, *blank, part, 0, text))
                else:
                    out.append((before[0], *_row(*before[1:], text, chunks), part, None, None))
                before = (key, text, chunks)
            yield table_of(out)
        if before is not None:
            yield table_of([(before[0], *blank, part, 1, before[1])])

    done = cut(walked.mapInArrow(walk, schema))
    # two rows for each task
    edges = done.filter("place IS NOT NULL").select("part", "place", "doc_id", "text")
    order = Window.orderBy("part")
    firsts = edges.filter("place = 0").select("part", F.col("text").alias("first_text"), F.row_number().over(order).alias("_i"))
    many = firsts.count()
    after = firsts.select((F.pmod(F.col("_i") - 2, F.lit(max(many, 1))) + 1).alias("_i"), F.col("first_text").alias("after"))
    numbered = firsts.select("part", "_i").join(after, "_i")
    lasts = edges.filter("place = 1").join(numbered, "part").select("doc_id", "text", "after")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, *_row(t, chunk_set(t), a, chunk_set(a))) for k, t, a in zip(*[c.to_pylist() for c in batch.columns])]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds[:7])], names=names[:7])

    return done.filter("place IS NULL").select(*names[:7]).union(lasts.mapInArrow(close, f"doc_id bigint, {RESULT}"))
