"""Ranks and group maxima that hold when one group has most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Rows that one task may number; a larger group is spread.
ROWS = 1_000_000


def ranked(df: DataFrame, group: list[str], order: list[Column], total_of: str | None = None) -> DataFrame:
    """Exact 1-based ``rank`` of every row in its group, whatever the group sizes.

    A window over a group puts the whole group in one task. Here rows are range-partitioned on
    (group, order), so a hot group spreads over many tasks; each task numbers its own rows, and a
    small table of per-task counts gives each task its offset. The order must be total (end it
    with a unique key). ``total_of`` also adds ``running``, the sum of that column up to the row.

    The numbered rows are written once to the shared folder: range boundaries are sampled, and a
    recomputed task must not land on other boundaries.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = group or ["_all"]
    source = df if group else df.withColumn("_all", F.lit(0))
    by = [F.col(k) for k in keys] + order
    placed = cut(
        source.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33))
    )
    counts = placed.groupBy(*keys, "_part").agg(
        F.min("_place").alias("_first"),
        F.count("*").alias("_n"),
        (F.sum(total_of) if total_of else F.lit(0)).alias("_sum"),
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys],
        F.col("_part").alias("_p"),
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
    )
    same = (F.col("_part") == F.col("_p"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    out = placed.join(offsets, same).withColumn("rank", F.col("_place") - F.col("_first") + F.col("_before") + 1)
    if total_of:
        inside = Window.partitionBy(*keys, "_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("running", F.sum(total_of).over(inside) + F.col("_sum_before"))
    return out.select(*df.columns, "rank", *(["running"] if total_of else []))


def placed(df: DataFrame, group: list[str], order: list[Column], rank: str = "rank", rows: int = ROWS) -> DataFrame:
    """Exact 1-based ``rank`` of every row in its group: by a window if no group has more than ``rows``, else as ``ranked``.

    The largest group is counted first, so ``df`` should be a written table. Both ways number alike.
    """
    largest = (df.groupBy(*group).agg(F.count("*").alias("_n")) if group else df.agg(F.count("*").alias("_n"))).agg(F.max("_n")).first()[0]
    if (largest or 0) > rows:
        return ranked(df, group, order).withColumnRenamed("rank", rank)
    window = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    return df.withColumn(rank, F.row_number().over(window.orderBy(*order)).cast("bigint"))


def with_group_max(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Adds the largest ``value`` of the row's group as ``out``.

    For groups that are few and large: the maximum is pre-aggregated and joined back, so no task
    holds a group. Rows with a null group key drop.
    """
    largest = df.groupBy(*group).agg(F.max(value).alias(out))
    return df.join(largest, group)


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group; each task keeps only its own first ``k`` before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, place).filter(F.col(rank) <= k)


def share_in_group(df: DataFrame, group: list[str], count: str, out: str) -> DataFrame:
    """count / sum of counts in the group; for result-sized tables."""
    totals = df.groupBy(*group).agg(F.sum(count).alias("_total"))
    return df.join(totals, group).withColumn(out, F.col(count) / F.col("_total")).drop("_total")
