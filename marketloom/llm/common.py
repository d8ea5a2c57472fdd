"""Small helpers that several training-data operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut

ROWS_PER_BUCKET = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seeded(seed: str, key: str) -> Column:
    """Hex text that orders rows pseudo-randomly by ``key``; a null key counts as empty text."""
    return F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def strata(df: DataFrame, stratum: str) -> DataFrame:
    """(stratum, n): rows of each stratum, written once, so that later joins are planned from its real size."""
    return cut(df.groupBy(stratum).agg(F.count("*").alias("n")))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the result holds the keys once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def seeded_rank(df: DataFrame, counts: DataFrame, stratum: str, order: Column, ties: list[Column]) -> DataFrame:
    """Adds ``n`` (rows of the row's stratum) and ``rank`` (1-based, by ``order`` then ``ties``).

    ``order`` is hex text that is uniform over the rows (``seeded``). A stratum is cut along that text into
    buckets of about ROWS_PER_BUCKET rows, so that one that holds most rows still spreads over many tasks; a
    bucket's offset is the sum of the counts before it. Nothing is sampled: a task that runs again finds the
    same buckets. Rows that are equal in order and ties take their ranks in any way.
    """
    place = F.conv(F.substring("_order", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    buckets = F.ceil(F.col("n") / F.lit(ROWS_PER_BUCKET))
    sized = null_safe_join(df.withColumn("_order", order), counts, [stratum]).withColumn("_bucket", F.floor(place * buckets))
    before = Window.partitionBy(stratum).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(
        sized.groupBy(stratum, "_bucket").agg(F.count("*").alias("_n"))
        .select(stratum, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(stratum, "_bucket").orderBy("_order", *ties))
    return null_safe_join(sized.withColumn("_inside", inside), starts, [stratum, "_bucket"]).withColumn(
        "rank", F.col("_inside") + F.col("_start")
    ).drop("_inside", "_start", "_bucket", "_order")


def buckets_for(rows: int) -> int:
    return max(1, math.ceil(rows / ROWS_PER_BUCKET))
