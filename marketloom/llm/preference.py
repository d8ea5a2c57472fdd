"""Preference formatting: one prompt for a pair of conversations, and two completions with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import null_safe_join, seeded, seeded_rank
from ..session import cut

OPEN, BODY, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turns): one row a conversation, its turns in order (ties by role, then text). Null role or text: empty.

    An output row holds a whole conversation, so its turns meet in one row; nothing else is gathered.
    """
    turn = F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return turns.groupBy(key).agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        key, F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def common_prefix(a: str, b: str) -> Column:
    """Number of first turns that are the same in both."""
    return F.expr(f"coalesce(array_position(zip_with({a}, {b}, (x, y) -> x IS NOT NULL AND y IS NOT NULL AND x.role = y.role AND x.text = y.text), false) - 1, 0)")


def rendered(turns: str) -> Column:
    """(text, spans): the turns as text, and the (start, end) character ranges a model learns from.

    Those are the words and end mark of each assistant turn; headers and other turns are masked out.
    """
    head = f"concat('{OPEN}', t.role, '{BODY}')"
    body = f"concat(t.text, '{CLOSE}')"
    text = f"concat(s.text, {head}, {body})"
    start = f"length(s.text) + length({head})"
    span = f"named_struct('start', {start}, 'end', {start} + length({body}))"
    spans = f"if(t.role = '{LEARNED}', concat(s.spans, array({span})), s.spans)"
    empty = "named_struct('text', '', 'spans', CAST(array() AS array<struct<start: int, `end`: int>>))"
    return F.expr(f"aggregate({turns}, {empty}, (s, t) -> named_struct('text', {text}, 'spans', {spans}))".replace("\n", "\\n"))


def format_pairs(pairs: DataFrame, key: list[str]) -> DataFrame:
    """Prompt and completions for pairs (key columns, chosen, rejected), each side an array of (role, text).

    The longest common run of first turns is rendered once as ``prompt``; the turns after it are the completions, each
    with its spans to learn from (``chosen_spans``, ``rejected_spans``, counted from the completion's start). Equal
    conversations have empty completions; without a common first turn the prompt is empty. A null side counts as empty.
    """
    none = F.expr("CAST(array() AS array<struct<role: string, text: string>>)")
    both = pairs.select(*key, F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    # beyond the shorter side zip_with pads with null, which is a difference; equal sides have none
    n = F.when(F.col("c") == F.col("r"), F.size("c")).otherwise(common_prefix("c", "r").cast("int"))
    cut_ = both.withColumn("n", n)
    after = "slice({0}, n + 1, size({0}))"
    done = cut_.select(
        *key, F.col("n").alias("prompt_turns"), rendered("slice(c, 1, n)").alias("p"),
        rendered(after.format("c")).alias("c"), rendered(after.format("r")).alias("r"),
    )
    return done.select(
        *key, "prompt_turns", F.col("p.text").alias("prompt"), F.col("c.text").alias("chosen"), F.col("c.spans").alias("chosen_spans"),
        F.col("r.text").alias("rejected"), F.col("r.spans").alias("rejected_spans"),
    )


def swapped_replies(turns: DataFrame, key: str = "conv_id", seed: str = "swap-1") -> DataFrame:
    """Pairs (key, donor, chosen, rejected): a conversation, and the same up to its last assistant turn, which is
    replaced by the last assistant turn of another conversation (the next in a seeded random order, in a ring).

    Conversations without an assistant turn make no pair. Donors are found by rank in the random order, which is cut
    into buckets, so no task holds all; only the rank and one reply are joined.
    """
    all_ = cut(conversations(turns, key).withColumn("last", F.expr(
        f"coalesce(array_max(transform(turns, (t, i) -> if(t.role = '{LEARNED}', i, -1))), -1)"
    )).filter("last >= 0"))
    total = all_.count()
    one = all_.select(key, F.expr("turns[last]").alias("reply")).withColumn("_all", F.lit(0))
    counts = cut(one.groupBy("_all").agg(F.count("*").alias("n")))
    ranked = cut(seeded_rank(one, counts, "_all", seeded(seed, key), [F.col(key)]).select(key, "reply", "rank"))
    donors = ranked.select(F.col(key).alias("donor"), F.col("reply").alias("donated"), (F.pmod(F.col("rank") - 2, F.lit(max(total, 1))) + 1).alias("rank"))
    given = ranked.join(donors, "rank").select(key, "donor", "donated")
    joined = null_safe_join(all_, given, [key])
    return joined.select(key, "donor", F.col("turns").alias("chosen"), F.expr("concat(slice(turns, 1, last), array(donated))").alias("rejected"))


def digest(turns: DataFrame) -> DataFrame:
    """What the preference query returns: every conversation with a reply, paired and formatted."""
    return format_pairs(swapped_replies(turns), ["conv_id", "donor"])
