"""Left joins in which rows without a key never pile up in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shares over which the rows without a key are dealt.
DEALT = 4096


def left_join_keyed(rows: DataFrame, table: DataFrame, key: str, spread: list[str]) -> DataFrame:
    """``rows`` left-joined with ``table`` on ``key``; a null or blank key matches nothing.

    Such rows are dealt over the tasks by a hash of the ``spread`` columns, as part of the join key, so the input is read and
    shuffled once.
    """
    blank = F.coalesce(F.trim(F.col(key).cast("string")) == "", F.lit(True))
    dealt = rows.withColumn("_deal", F.when(blank, F.pmod(F.xxhash64(*spread), F.lit(DEALT)) + 1).otherwise(F.lit(0)))
    # Zero, in a form that is not folded: a constant would take the column out of the join key.
    other = table.withColumn("_deal", F.pmod(F.xxhash64(key), F.lit(1)))
    return dealt.join(other, [key, "_deal"], "left").drop("_deal")
