"""Conversation structure repair: cheapest edits by a suffix-shared automaton over role/fault signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import null_safe_join

BLANKS = " \t\n\x0b\x0c\r"
#: Rows of a conversation that are handled as one block (a power of two as bits).
BLOCK_BITS = 16
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
FAR = 1 << 40
#: States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a. NEXT: the state after the user or assistant that a state allows.
NEXT = (2, 2, 3, 2)
FINAL = (0, 2 * INSERT, INSERT, 0)
FINAL_INSERTS = ("", "II", "I", "")
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "x": {}}

Node = tuple[tuple[int, ...], tuple[str, ...], tuple[int, ...]]


def node(symbol: str, after: tuple[int, ...]) -> Node:
    """(cost-to-go, first edit, state after it) for each grammar state, before a row ``symbol`` that ``after`` follows.

    Symbols: D for a row that must go (blank or duplicate); s, u, a, x by role, in capitals if truncated. ``after`` holds
    the cost-to-go behind the row. Of edits of equal cost the letter that sorts first is taken: each letter leads to one
    state only, so this gives the least string. Two insertions in a row are the most that can help.
    """
    plain: list[tuple[int, str, int]] = []
    kept = KEPT[symbol.lower()] if symbol != "D" else {}
    extra = TRUNCATED if symbol.isupper() else 0
    for q in range(4):
        best = (DELETE + after[q], "D", q)
        if symbol != "D":
            if q in kept:
                best = min(best, (extra + after[kept[q]], "K", kept[q]))
            best = min(best, (extra + REROLE + after[NEXT[q]], "R", NEXT[q]))
        plain.append(best)
    inserted = [(INSERT + plain[NEXT[q]][0], "I", NEXT[q]) for q in range(4)]
    once = [min(p, i) for p, i in zip(plain, inserted)]
    done = [min(once[q], (INSERT + once[NEXT[q]][0], "I", NEXT[q])) for q in range(4)]
    return tuple(d[0] for d in done), tuple(d[1] for d in done), tuple(d[2] for d in done)


def audit(path: list[Node], q: int, final: bool) -> tuple[str, int]:
    """The edits from state ``q`` along the nodes (the last of ``path`` comes first), and the state at the end."""
    out = []
    at = len(path) - 1
    while at >= 0:
        _, edit, then = path[at]
        letter = edit[q]
        out.append(letter)
        q = then[q]
        at -= letter != "I"
    return "".join(out) + (FINAL_INSERTS[q] if final else ""), q


def solved(words: DataFrame) -> DataFrame:
    """Adds ``costs`` (from each grammar state), ``audits`` and ``exits`` to distinct (signature, ends).

    ``ends`` is the cost-to-go behind the signature; null: the conversation ends there. Words are range-partitioned and
    sorted by ends and reversed signature, so words with a common suffix follow each other. A node of the automaton is a
    distinct suffix behind one end: it is made when first met, kept on a stack while the words go through it, and
    serves all conversations on it. A task holds the nodes of one word.
    """
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = words.withColumn("_r", F.reverse("signature")).repartitionByRange(parts, "ends", "_r").sortWithinPartitions("ends", "_r")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path: list[Node] = []
        last, behind = "", None
        for batch in batches:
            costs, audits, exits = [], [], []
            for word, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                back = word[::-1]
                final = ends is None
                ends = FINAL if final else tuple(ends)
                same = 0
                if behind == (final, ends):
                    most = min(len(back), len(path))
                    while same < most and back[same] == last[same]:
                        same += 1
                del path[same:]
                for symbol in back[same:]:
                    path.append(node(symbol, path[-1][0] if path else ends))
                last, behind = back, (final, ends)
                found = [audit(path, q, final) for q in range(4)]
                costs.append(list(path[-1][0] if path else ends))
                audits.append([a for a, _ in found])
                exits.append([q for _, q in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32()))],
                names=["signature", "ends", "costs", "audits", "exits"],
            )

    schema = "signature string, ends array<bigint>, costs array<bigint>, audits array<string>, exits array<int>"
    return placed.select("signature", "ends").mapInArrow(run, schema)


def _backwards(blocks: pa.Table) -> pa.Table:
    """The cost-to-go behind each block of one conversation, from the blocks' costs between grammar states."""
    rows = blocks.sort_by([("block", "descending")]).to_pylist()
    after, ends = list(FINAL), []
    for i, row in enumerate(rows):
        ends.append(None if i == 0 else after)
        after = [min(row["costs"][to][q] + after[to] for to in range(4)) for q in range(4)]
    columns = [pa.array([r[c] for r in rows], blocks.schema.field(c).type) for c in ("key", "block", "signature")]
    return pa.Table.from_arrays([*columns, pa.array(ends, pa.list_(pa.int64()))], names=["key", "block", "signature", "ends"])


def _forwards(blocks: pa.Table) -> pa.Table:
    """The grammar state before each block of one conversation."""
    rows = blocks.sort_by("block").to_pylist()
    q, starts = 0, []
    for row in rows:
        starts.append(q)
        q = row["exits"][q]
    columns = [pa.array([r[c] for r in rows], blocks.schema.field(c).type) for c in ("key", "block")]
    return pa.Table.from_arrays([*columns, pa.array(starts, pa.int32())], names=["key", "block", "start"])


def _outputs(blocks: DataFrame, key_type: str) -> DataFrame:
    """(key, block, outputs): what a block's edits leave, in order, as (index of the item, -1: inserted; given role, null: the row's own)."""
    def left(signature: str, counts: list[int], letters: str, q: int) -> list[dict]:
        starts, total = {}, 0
        for i, n in enumerate(counts):
            starts[total] = i
            total += n
        out, at = [], 0
        for letter in letters:
            if letter != "D":
                own = letter == "K"
                out.append({"item": -1 if letter == "I" else starts[at], "role": None if own else "assistant" if q == 2 else "user"})
                q = KEPT[signature[at].lower()][q] if own else NEXT[q]
            at += letter != "I"
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("item", pa.int32()), ("role", pa.string())]))
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([left(*r) for r in rows], kind)], names=["key", "block", "outputs"])

    schema = f"key {key_type}, block bigint, outputs array<struct<item: int, role: string>>"
    return blocks.select("key", "block", "signature", "counts", "audit", "start").mapInArrow(run, schema)


def _shown(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(key, turn, role, text, hash): null roles and texts as one space."""
    space = F.lit(" ")
    return turns.select(
        F.col(key).alias("key"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
    ).withColumn("hash", F.unhex(F.md5(F.encode("text", "UTF-8"))))


def marked(shown: DataFrame) -> DataFrame:
    """(key, turn, role, hash, n, fault, code): distinct rows with their number ``n`` and the fault and symbol of the first of them.

    Texts do not travel: what decides is counted per map task first. Further ones of the n rows are duplicates (or blank).
    """
    trimmed = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(trimmed == "", "blank").when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), "none").otherwise("truncated")
    rows = cut(shown.select("key", "turn", "role", "hash", fault.alias("fault")).groupBy("key", "turn", "role", "hash", "fault").agg(F.count("*").alias("n")))
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("at"))
    again = rows.filter("fault <> 'blank'").groupBy("key", "role", "hash").agg(F.min(place).alias("first"), F.count("*").alias("_k")).filter("_k > 1").drop("_k")
    seen = null_safe_join(rows, again, ["key", "role", "hash"], "left")
    late = F.col("first").isNotNull() & (F.col("fault") != "blank") & (F.col("first") < place)
    all_ = seen.withColumn("fault", F.when(late, "duplicate").otherwise(F.col("fault"))).drop("first")
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return all_.withColumn("code", F.when(F.col("fault").isin("blank", "duplicate"), "D").when(F.col("fault") == "truncated", F.upper(code)).otherwise(code))


def _blocks(rows: DataFrame) -> DataFrame:
    """One row for each conversation and block: its items in order, signature, counts and what the summary needs.

    All rows are range-partitioned in conversation order and numbered, so a conversation of any size spreads over tasks.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in ("key", "turn", "role", "hash")]
    placed = cut(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()))
    item = F.struct("at", "turn", "role", "hash", "n", "code")
    extra = F.col("n") - 1
    return (
        placed.groupBy("key", F.shiftright("at", BLOCK_BITS).alias("block")).agg(
            F.sort_array(F.collect_list(item)).alias("items"),
            F.sum(F.when(F.col("fault") == "blank", F.col("n")).otherwise(0)).alias("blank"),
            F.sum(F.when(F.col("fault") == "blank", 0).when(F.col("fault") == "duplicate", F.col("n")).otherwise(extra)).alias("duplicate"),
            F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"),
            F.sum("n").alias("n"),
        )
        .withColumn("counts", F.expr("transform(items, i -> cast(i.n AS int))"))
        .withColumn("signature", F.expr("array_join(transform(items, i -> concat(i.code, repeat('D', cast(i.n - 1 AS int)))), '')"))
        .withColumn("initials", F.expr("transform(items, i -> substring(i.role, 1, 1))"))
        .withColumn("first", F.expr("element_at(initials, 1)"))
        .withColumn("last", F.expr("element_at(initials, -1)"))
        # pairs of unlike rows that follow each other well; all other pairs are counted as illegal
        .withColumn("legal", F.expr(
            "size(filter(zip_with(slice(initials, 1, size(initials) - 1), slice(initials, 2, size(initials)), (x, y) -> concat(x, y)), p -> p IN ('su', 'ua', 'au')))"
        ))
        .drop("initials")
    )


@dataclass
class Repair:
    """``summary``: one row a conversation; ``rows``: (key, block, seq, role, text, edit) in order of block and seq."""

    summary: DataFrame
    rows: DataFrame


def repair(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Finds each conversation's faults and the cheapest edits that give its roles the form (s?(ua)+)?.

    Rows go by turn (nulls first), then role, then a hash of the text. A row's first fault counts: blank, duplicate
    (role and text seen earlier in the conversation), truncated. Costs and symbols: ``node``. ``summary`` holds key,
    gaps, blank, duplicate, truncated, illegal, cost and audit; conversations are those of ``turns``.

    Distinct signatures are solved once, whatever the number of conversations that share them (``solved``). A
    conversation of more than 2^BLOCK_BITS rows, or one that meets the end of a task's range, is several blocks: these
    are solved once for each grammar state at their end, joined from the back, and solved again with the cost that
    really follows. So no task holds a conversation, except for the audit, which is one text.

    A null key is a conversation of its own, null roles and texts are one space, wholly equal rows are duplicates of
    each other, a row with an empty role keeps no place in the grammar. An empty table gives empty results. Texts of any
    length are only hashed, and shuffled once with the rows that stay. Other columns take no part.
    """
    shown = _shown(turns, key, turn, role, text)
    key_type = shown.schema["key"].dataType.simpleString()
    rows = marked(shown)
    blocks = cut(_blocks(rows))
    counted = blocks.groupBy("key").agg(F.count("*").alias("_blocks"))
    many = cut(null_safe_join(blocks.select("key", "block", "signature"), counted.filter("_blocks > 1").drop("_blocks"), ["key"]))
    no_end = F.lit(None).cast("array<bigint>")
    unit = F.array(*[F.array(*[F.lit(0 if i == j else FAR).cast("bigint") for i in range(4)]) for j in range(4)])
    ends = F.posexplode(unit).alias("to", "ends")
    between = solved(many.select("signature").distinct().select("signature", ends).select("signature", "ends"))
    matrix = between.groupBy("signature").agg(F.sort_array(F.collect_list(F.struct(F.array_position("ends", F.lit(0).cast("bigint")).alias("to"), "costs"))).alias("_m"))
    linked = many.join(matrix.select("signature", F.col("_m.costs").alias("costs")), "signature")
    schema = f"key {key_type}, block bigint, signature string, ends array<bigint>"
    behind = cut(linked.select("key", "block", "signature", "costs").groupBy("key").applyInArrow(_backwards, schema))
    single = null_safe_join(blocks.select("key", "block", "signature"), counted.filter("_blocks = 1").drop("_blocks"), ["key"]).withColumn("ends", no_end)
    words = cut(solved(single.select("signature", "ends").union(behind.select("signature", "ends")).distinct()))

    found = null_safe_join(behind, words, ["signature", "ends"])
    starts = found.select("key", "block", "exits").groupBy("key").applyInArrow(_forwards, f"key {key_type}, block bigint, start int")
    wanted = ["key", "block", "start", F.expr("audits[start]").alias("audit"), F.expr("costs[start]").alias("cost")]
    last = words.filter("ends IS NULL").drop("ends")
    best = single.join(last, "signature").withColumn("start", F.lit(0)).select(*wanted).union(null_safe_join(found, starts, ["key", "block"]).select(*wanted))
    chosen = cut(null_safe_join(blocks, best, ["key", "block"]))

    meets = F.concat(F.lag("last").over(Window.partitionBy("key").orderBy("block")), F.col("first")).isin("su", "ua", "au")
    pieces = chosen.select("key", "block", "blank", "duplicate", "truncated", "n", "audit", "cost", (F.col("legal") + F.coalesce(meets.cast("int"), F.lit(0))).alias("legal"))
    summed = pieces.groupBy("key").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        (F.sum("n") - 1 - F.sum("legal")).alias("illegal"), F.min_by("cost", "block").alias("cost"),
        F.sort_array(F.collect_list(F.struct("block", "audit"))).alias("audits"),
    )
    gaps = rows.groupBy("key").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    summary = null_safe_join(summed, gaps, ["key"]).select(
        F.col("key").alias(key), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.array_join("audits.audit", "").alias("audit"))

    outputs = null_safe_join(chosen.select("key", "block", "items"), _outputs(chosen, key_type), ["key", "block"]).select(
        "key", "block", F.posexplode("outputs").alias("seq", "out"), "items")
    edits = outputs.select("key", "block", "seq", F.col("out.role").alias("given"), F.expr("if(out.item < 0, null, items[out.item])").alias("item"))
    given = cut(edits.select("key", "block", "seq", "given", F.col("item").isNull().alias("new"), "item.turn", "item.role", "item.hash"))
    texts = shown.groupBy("key", "turn", "role", "hash").agg(F.first("text").alias("text"))
    kept = null_safe_join(texts, given.filter("NOT new"), ["key", "turn", "role", "hash"])
    edit = F.when(F.col("given").isNull(), "K").otherwise("R").alias("edit")
    repaired = kept.select("key", "block", "seq", F.coalesce("given", "role").alias("role"), "text", edit).union(
        given.filter("new").select("key", "block", "seq", "given", F.lit(""), F.lit("I")))
    return Repair(summary, repaired.withColumnRenamed("key", key))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversation rows with faults put in by a checksum of conversation and turn: one in 20 each is dropped, emptied,
    loses its full stops, is repeated, or becomes the user's. Nulls are one space, but for the columns conv_id and turn themselves."""
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = (F.crc32(F.concat_ws(":", *as_text).cast("binary")) % 20).cast("int")
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    hit = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return hit.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), times.alias("_time")).drop("_time")


def text_digests(rows: DataFrame, key: str) -> DataFrame:
    """(key, repaired_sha256): SHA-256 of each conversation's ``role:text`` lines. Rows stream through, in order; a task holds one hash."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hash_, keys, digests = None, None, [], []
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for one, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if hash_ is not None and one == now:
                    hash_.update(b"\n")
                else:
                    if hash_ is not None:
                        keys.append(now)
                        digests.append(hash_.hexdigest())
                    now, hash_ = one, hashlib.sha256()
                hash_.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(digests, pa.string())], names=[key, "repaired_sha256"])
            keys, digests = [], []
        if hash_ is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([hash_.hexdigest()], pa.string())], names=[key, "repaired_sha256"])

    placed = rows.repartition(parts, key).sortWithinPartitions(key, "block", "seq")
    return placed.select(key, "role", "text").mapInArrow(run, schema)


def digest(turns: DataFrame) -> DataFrame:
    """What the repair query returns: one row for each conversation of the table, which is damaged first.

    A conversation that loses all rows has zeros, an empty audit and the hash of the empty text. Rows with a null
    conversation id are one conversation. Turns are integers; repeated rows, empty tables and other columns: ``repair``.
    """
    fixed = repair(damaged(turns))
    all_ = turns.select("conv_id").distinct()
    joined = null_safe_join(null_safe_join(all_, fixed.summary, ["conv_id"], "left"), text_digests(fixed.rows, "conv_id"), ["conv_id"], "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
