"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_for, null_safe_join, seeded, seeded_rank, strata
from ..session import cut

SEED = "shard-1"


def shard(
    docs: DataFrame, shards: int, key: str = "doc_id", stratum: str = "source", seed: str = SEED, ties: tuple[str, ...] = (),
) -> DataFrame:
    """All rows of ``docs`` with ``shard`` (int, 0 to shards-1) and ``slot`` (long, gapless from 0 inside a shard).

    The rows of each stratum are put in a seeded random order; the row of rank r among n has the fractional rank
    (r - 1/2) / n. All rows are ordered by it (then by stratum), and the order is cut into ``shards`` runs whose row
    counts differ by one at most. Every run so holds each stratum in proportion, to within about one row.

    Law: row counts. Copies of a text are rows like any others, and may fall into different shards: a text with more
    copies than a shard has rows could not stay whole under this law.

    Ranks need one shuffle by (stratum, random bucket), the global order one by fractional bucket; the offset of a
    fractional bucket follows from the counts alone. No task holds a stratum. A null stratum is a stratum, a null key
    is an empty one. Rows that share a key are ordered by ``ties``; wholly equal rows are interchangeable. An empty
    table gives an empty table. Other columns pass through under any name, but for shard and slot, which are replaced.
    """
    own = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    out = [c for c in docs.columns if c not in ("shard", "slot")]
    key, stratum, ties = own[key], own[stratum], tuple(own[t] for t in ties)
    df = docs.toDF(*own.values())
    counts = strata(df, stratum)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = buckets_for(total)
    tie_columns = [F.col(key), *[F.col(t) for t in ties]]
    ranked = seeded_rank(df, counts, stratum, seeded(seed, key), tie_columns)
    odd = 2 * F.col("rank") - 1
    # rows of a stratum of n whose fractional rank lies before bucket b: those with (2r - 1) * buckets < 2 * n * b
    starts = cut(
        counts.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
        .withColumn("_before", F.expr(f"(2 * n * _b + 3 * {buckets} - 1) div (2 * {buckets}) - 1"))
        .groupBy("_b").agg(F.sum("_before").alias("_start"))
    )
    placed = ranked.withColumn("_b", F.expr(f"((2 * rank - 1) * {buckets}) div (2 * n)").cast("int")).withColumn("_fraction", odd / (2 * F.col("n")))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_fraction", F.col(stratum).asc_nulls_first(), "rank"))
    at = null_safe_join(placed.withColumn("_inside", inside), starts, ["_b"]).withColumn("_at", F.col("_start") + F.col("_inside") - 1)
    cut_at = at.withColumn("_shard", F.expr(f"(_at * {shards}) div {max(total, 1)}").cast("int"))
    first = F.expr(f"(_shard * CAST({total} AS BIGINT) + {shards - 1}) div {shards}")
    return cut_at.select(
        *[F.col(own[c]).alias(c) for c in out], F.col("_shard").alias("shard"), (F.col("_at") - first).alias("slot"),
    )


def digest(docs: DataFrame, shards: int) -> DataFrame:
    """What the sharding query returns: the shard and slot of every document, with its size and checksum, without texts."""
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return shard(narrow, shards, ties=("text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Writes one folder per shard, rows in slot order; no shard's folder needs another's rows."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def sql(shards: int) -> str:
    """``digest`` as SQL. CRC-32 goes over the hex digits of the bytes, the low digit of each first, by a table of 16."""
    table = []
    for i in range(16):
        for _ in range(4):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    digits = "list_transform(range(0, 2 * (size - 16)), lambda i: (instr('0123456789ABCDEF', digits[xor(i, 1) + 1]) - 1)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, n: xor(c >> 4, ({table}::BIGINT[])[(xor(c, n) & 15) + 1])), 4294967295::BIGINT)"
    return f"""
    WITH d AS (
      SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size, string_split(hex(encode(coalesce(text, ''))), '') AS digits,
        md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
    ), summed AS (
      SELECT doc_id, source, size, h, {crc} AS text_crc32 FROM d
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, text_crc32, size) AS rank, count(*) OVER (PARTITION BY source) AS n FROM summed
    ), placed AS (
      SELECT *, row_number() OVER (ORDER BY (2 * rank - 1) / (2 * n)::DOUBLE, source NULLS FIRST, rank) - 1 AS place, count(*) OVER () AS total FROM ranked
    ), dealt AS (
      SELECT *, place * {shards} // total AS shard FROM placed
    )
    SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, place - (shard * total + {shards - 1}) // {shards} AS slot,
      NULL::INTEGER AS grown_shard, source FROM dealt
    """
