"""Mixing sources to target weights by a Pfair schedule of blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import null_safe_join, seeded, seeded_rank, strata

SEED = "mix-1"
BLOCK = 32
UNITS = 1000
EPOCHS = 4
POWER = 0.9
#: Sources under one unit: inside their entry, one with OWN of its 1000 parts has its own turns, and the others go in groups of GROUP parts.
OWN = 20
GROUP = 32


def tempered(counts: DataFrame, power: float = POWER) -> DataFrame:
    """Target weights from row counts (source, n): n to a power under 1 lifts small sources."""
    return counts.select(counts.columns[0], F.pow(F.col("n").cast("double"), F.lit(power)).alias("weight"))


def period(entries: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One period of the schedule for ``entries`` (sid from 0 without gaps, units >= 1): (sid, turn, slot), for each ``by``.

    W, the sum of the units, is the period. The j-th block (from 0) of an entry with u units is released at slot
    floor(j W / u) and due by slot ceil((j + 1) W / u). Slot after slot takes, of the released blocks, the one due
    first (ties: the lowest sid). All windows can be met on one lane, and after t slots an entry has had more than
    t u / W - 1 and less than t u / W + 1 blocks. After W slots every entry has had exactly its units, so the schedule
    repeats; W depends on the resolution of the weights and not on the data, which is why one row may hold it.
    """
    one = entries.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col("sid"), F.col("units").cast("long").alias("units")))).alias("e")).select(
        *by, F.transform("e", lambda x: x["units"]).alias("u")
    ).withColumn("w", F.expr("aggregate(u, 0L, (a, x) -> a + x)")).filter("w > 0")
    due = "if((j * w) div u[i] <= t, ((j + 1) * w + u[i] - 1) div u[i], 9223372036854775807L)"
    pick = f"array_min(transform(s.had, (j, i) -> named_struct('due', {due}, 'sid', i))).sid"
    step = "named_struct('had', transform(s.had, (j, i) -> if(i = p, j + 1L, j)), 'picks', concat(s.picks, array(p)))"
    start = "named_struct('had', transform(u, x -> 0L), 'picks', CAST(array() AS array<int>))"
    picks = one.select(*by, "w", F.expr(
        f"aggregate(sequence(0L, w - 1), {start}, (s, t) -> transform(array({pick}), p -> {step})[0], s -> s.picks)"
    ).alias("picks"))
    flat = picks.select(*by, "w", F.posexplode("picks").alias("slot", "sid"))
    turn = F.row_number().over(Window.partitionBy(*by, "sid").orderBy("slot")) - 1
    return flat.select(*by, "sid", turn.cast("long").alias("turn"), F.col("slot").cast("long").alias("slot"), "w")


def nested(pool: DataFrame, source: str) -> list[tuple[DataFrame, DataFrame]]:
    """Schedules inside the entry that the sources of ``pool`` (source, share) share: for each level (members, turns).

    ``members`` holds (source, _sched, sid, units, w): the schedule of that level that deals to the source, and its entry
    there. ``turns`` is that level's ``period``. Inside an entry, shares are rounded to 1/UNITS of it. Sources of OWN
    units or more are entries, the rest go by falling share into groups of about GROUP units, and a group of several is
    an entry with a schedule of its own on the next level. A group has about a twentieth of its entry at most, so levels end.
    """
    levels: list[tuple[DataFrame, DataFrame]] = []
    left = cut(pool.select(source, "share", F.lit("").alias("_sched")))
    while not left.isEmpty():
        per = Window.partitionBy("_sched")
        down = per.orderBy(F.desc("share"), source)
        parts = cut(left.withColumn("_of", F.col("share") / F.sum("share").over(per) * UNITS))
        few = F.when(F.col("_of") < OWN, F.col("_of")).otherwise(0.0)
        before = F.coalesce(F.sum(few).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        last = F.greatest(F.lit(1), F.floor(F.sum(few).over(per) / GROUP)) - 1
        group = F.when(F.col("_of") < OWN, F.least(last, F.floor(before / GROUP))).otherwise(-F.row_number().over(down))
        grouped = cut(parts.withColumn("_group", group.cast("long")))
        number = F.row_number().over(per.orderBy(F.desc("_of"), "_group")) - 1
        entries = grouped.groupBy("_sched", "_group").agg(F.sum("_of").alias("_of"), F.count("*").alias("_members")).select(
            "_sched", "_group", "_members", number.alias("sid"), F.greatest(F.lit(1), F.round("_of")).cast("long").alias("units")
        )
        entries = cut(entries.withColumn("w", F.sum("units").over(per)))
        placed = cut(grouped.join(entries, ["_sched", "_group"]))
        levels.append((placed.select(source, "_sched", "sid", "units", "w"), cut(period(entries, ("_sched",)))))
        left = cut(placed.filter("_members > 1").select(source, "share", F.concat_ws(".", "_sched", "sid").alias("_sched")))
    return levels


def mix(
    docs: DataFrame, weights: DataFrame | None = None, key: str = "doc_id", source: str = "source", block: int = BLOCK,
    units: int = UNITS, epochs: int = EPOCHS, seed: str = SEED, ties: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of ``docs`` in a mixture that follows target weights: adds epoch, slot and position (all long).

    Each source's rows, in a seeded random order, are cut into blocks of ``block`` rows, and the Pfair schedule
    (``period``) says which source fills which slot. The mixture ends with the slot in which the last source has given
    every row once. A source that is through earlier starts again (``epoch`` 1, 2, ...) up to ``epochs`` rounds, after
    which its slots stay empty. Every row of ``docs`` is so in the mixture at least once and ``epochs`` times at most.
    As long as no source has used up its rounds, each source is within less than one block of its target at every slot,
    and within less than two if it shares its entry.

    ``weights`` holds (source, weight); default: ``tempered`` counts. A source without a positive weight gets its own
    share of the rows. Weights are rounded to 1/``units``; sources that come to less than one unit share one entry of
    the schedule, so the schedule has units + 1 entries at most, and that entry's blocks are dealt among them by
    schedules of their own weights (``nested``). ``position`` orders the mixture; it skips the places
    of empty slots. A null source is a source; an empty table gives an empty table; rows that share a key are ordered
    by ``ties``; other columns pass through under any name, but for epoch, slot and position, which are replaced.
    """
    own = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    out = [c for c in docs.columns if c not in ("epoch", "slot", "position")]
    key, source, ties = own[key], own[source], tuple(own[t] for t in ties)
    df = docs.toDF(*own.values())
    counts = strata(df, source)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    given = tempered(counts) if weights is None else weights.toDF(source, "weight")
    asked = null_safe_join(counts, given, [source], "left").withColumn("_ok", F.col("weight") > 0)
    sums = asked.agg(F.sum(F.when(F.col("_ok"), F.col("weight"))).alias("w"), F.sum(F.when(F.col("_ok"), F.col("n"))).alias("n")).first()
    rest = (sums["n"] or 0) / max(total, 1)  # the part of the mixture that is dealt by the given weights
    share = F.when(F.col("_ok"), F.col("weight") / F.lit(float(sums["w"] or 1)) * F.lit(rest)).otherwise(F.col("n") / F.lit(max(total, 1)))
    shares = asked.select(source, "n", share.alias("share"))
    small = F.col("share") * units < 1
    # a pooled source goes by the null key; a source that is null itself has named = true
    entry = shares.select(source, "n", "share", F.when(~small, F.col(source)).alias("_entry"), (~small).alias("_named"))
    grouped = entry.groupBy("_named", "_entry").agg(F.sum("n").alias("_rows"), F.sum("share").alias("_share"))
    number = F.row_number().over(Window.orderBy(F.desc("_share"), "_named", "_entry")) - 1
    entries = cut(grouped.select(
        "_named", "_entry", "_rows", number.alias("sid"), F.greatest(F.lit(1), F.round(F.col("_share") * units)).cast("long").alias("units"),
    ))
    turns = cut(period(entries))
    pool = cut(entry.filter("NOT _named").select(source, "share"))
    levels = nested(pool, source) if pool.count() > 1 else []
    placed_in = null_safe_join(entry.drop("share"), entries, ["_named", "_entry"]).select(source, "n", "sid", "units", F.col("sid").cast("string").alias("_leaf"))
    for i, (members, _) in enumerate(levels):
        inner = members.toDF(source, f"_sched{i}", f"_sid{i}", f"_units{i}", f"_w{i}")
        placed_in = null_safe_join(placed_in, inner, [source], "left").withColumn("_leaf", F.concat_ws(".", "_leaf", f"_sid{i}"))
    sources = cut(placed_in)

    def slotted(df: DataFrame) -> DataFrame:
        """Adds ``_slot``, the slot of the source's ``_block``: inner schedules say which of their entry's blocks it is."""
        for i, (_, inside) in reversed(list(enumerate(levels))):
            inner = inside.toDF(f"_sched{i}", f"_sid{i}", "_turn", "_inner", "_period")
            df = df.withColumn("_turn", F.expr(f"_block % _units{i}")).join(inner, [f"_sched{i}", f"_sid{i}", "_turn"], "left").withColumn(
                "_block", F.coalesce(F.expr(f"(_block div _units{i}) * _period + _inner"), F.col("_block"))
            ).drop("_turn", "_inner", "_period")
        return df.withColumn("turn", F.expr("_block % units")).join(F.broadcast(turns), ["sid", "turn"]).withColumn("_slot", F.expr("(_block div units) * w + slot"))

    ends = slotted(sources.withColumn("_block", F.expr(f"(n - 1) div {block}")))
    horizon = ends.agg(F.coalesce(F.max("_slot") + 1, F.lit(0))).first()[0]

    # blocks an entry of u units can have had by the horizon: no more than ceil(horizon * u / w), and so on inside it
    width = turns.agg(F.coalesce(F.max("w"), F.lit(1))).first()[0]
    had = F.expr(f"({horizon} * units + {width} - 1) div {width}")
    for i in range(len(levels)):
        had = F.coalesce(F.ceil(had * F.col(f"_units{i}") / F.col(f"_w{i}")), had)
    rounds = F.least(F.lit(epochs), F.floor(had * block / F.col("n")) + 1)
    strata_of = cut(sources.withColumn("_rounds", rounds.cast("int")).drop("n"))
    by_entry = seeded_rank(
        null_safe_join(df, strata_of, [source]), sources.select("_leaf", "n"), "_leaf", seeded(seed, key), [F.col(key), *[F.col(t) for t in ties]]
    )
    repeated = by_entry.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_rounds") - 1))).withColumn("_at", F.expr("_epoch * n + rank - 1"))
    slots = slotted(repeated.withColumn("_block", F.expr(f"_at div {block}")))
    kept = slots.filter((F.col("_epoch") == 0) | (F.col("_slot") < horizon))
    return kept.select(
        *[F.col(own[c]).alias(c) for c in out], F.col("_epoch").cast("long").alias("epoch"), F.col("_slot").alias("slot"),
        F.expr(f"_slot * {block} + _at % {block}").alias("position"),
    )


def sql() -> str:
    """The production query as SQL: the schedule slot by slot, then every row's places."""
    return f"""
    WITH RECURSIVE counts AS (
      SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {POWER}) AS weight FROM documents GROUP BY source
    ), shares AS (
      SELECT source, n, weight / (SELECT sum(weight) FROM counts) AS share FROM counts
    ), entry AS (
      SELECT source, n, share, share * {UNITS} >= 1 AS named, CASE WHEN share * {UNITS} >= 1 THEN source END AS entry FROM shares
    ), entries AS (
      SELECT named, entry, sum(n)::BIGINT AS n, row_number() OVER (ORDER BY sum(share) DESC, named, entry NULLS FIRST) - 1 AS sid,
        greatest(1, round(sum(share) * {UNITS}))::BIGINT AS units FROM entry GROUP BY named, entry
    ), one AS (
      SELECT list(units ORDER BY sid) AS u, sum(units)::BIGINT AS w FROM entries
    ), schedule AS (
      SELECT -1::BIGINT AS slot, list_transform(u, lambda x: 0::BIGINT) AS had, -1::BIGINT AS sid FROM one
      UNION ALL
      SELECT slot, list_transform(range(1, len(had) + 1), lambda i: had[i] + (i = pick + 1)::BIGINT), pick FROM (
        SELECT s.slot + 1 AS slot, had, list_min(list_transform(range(1, len(had) + 1), lambda i:
          CASE WHEN (had[i] * w) // u[i] <= s.slot + 1 THEN (((had[i] + 1) * w + u[i] - 1) // u[i]) * 1000003 + i - 1 END)) % 1000003 AS pick
        FROM schedule s, one WHERE s.slot + 1 < w
      )
    ), turns AS (
      SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS turn FROM schedule WHERE slot >= 0
    ), horizon AS (
      SELECT max(((n - 1) // {BLOCK} // units) * w + slot) + 1 AS h FROM entries, one, turns
      WHERE turns.sid = entries.sid AND turn = ((n - 1) // {BLOCK}) % units
    ), ranked AS (
      SELECT doc_id, d.source, e.sid, e.units, e.n, row_number() OVER (PARTITION BY e.sid ORDER BY md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST) - 1 AS place
      FROM documents d JOIN entry x ON x.source IS NOT DISTINCT FROM d.source JOIN entries e ON e.named = x.named AND e.entry IS NOT DISTINCT FROM x.entry
    ), repeated AS (
      SELECT r.*, epoch, epoch * n + place AS spot FROM ranked r, generate_series(0, {EPOCHS - 1}) g(epoch)
    ), slots AS (
      SELECT doc_id, source, epoch, spot, (spot // {BLOCK} // units) * w + slot AS slot FROM repeated r JOIN turns t ON t.sid = r.sid AND t.turn = (spot // {BLOCK}) % units, one
    )
    SELECT doc_id, source, epoch::BIGINT AS epoch, slot, slot * {BLOCK} + spot % {BLOCK} AS position FROM slots, horizon WHERE epoch = 0 OR slot < h
    """
