"""Training-set preparation: class index, splits, leakage audit, oversampling, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import source_image_id
from ..functions.numbers import flag, ratio, round_to
from .ranking import ranked, top_k

SEED = 42  # fixed value
DRAWS = 10_000  # draws that one row stands for until they are dealt out
SPLITS = ["train", "val", "test"]
RATIOS = (0.70, 0.15, 0.15)  # fixed values
GROUPED_RATIOS = (4 / 6, 1 / 6, 1 / 6)  # one of three outer folds held out, halved


def hash_order(seed: int, *key: Column) -> Column:
    """A text hash of (seed, key) that orders rows the same way in every engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]))


def add_source_image_id(df: DataFrame, path: str = "relative_path") -> DataFrame:
    return df.withColumn("source_image_id", source_image_id(F.col(path)))


def class_counts(df: DataFrame, class_column: str = "class_name") -> DataFrame:
    return df.groupBy(class_column).agg(F.count("*").alias("n"))


def class_index(df: DataFrame, class_column: str = "class_name") -> DataFrame:
    """Sorted distinct classes with a 0-based index, numbered by range partitions."""
    names = df.select(class_column).filter(F.col(class_column).isNotNull()).distinct()
    return ranked(names, [], [F.col(class_column)]).select((F.col("rank") - 1).cast("int").alias("class_index"), class_column)


def class_balance(df: DataFrame, class_column: str = "class_name") -> DataFrame:
    """Count and percentage per class, with smallest, largest and their ratio on every row."""
    counts = class_counts(df, class_column)
    total, low, high = (counts.select(f("n")).scalar() for f in (F.sum, F.min, F.max))
    return counts.select(
        class_column, "n",
        round_to(ratio(F.col("n"), total) * 100.0, 2).alias("percentage"),
        low.alias("min_count"), high.alias("max_count"), round_to(ratio(high, low), 2).alias("imbalance_ratio"),
    )


def balanced_class_weights(df: DataFrame, class_column: str = "class_name") -> DataFrame:
    """N / (K x n) per class."""
    counts = class_counts(df, class_column)
    total, classes = counts.select(F.sum("n")).scalar(), counts.select(F.count("*")).scalar()
    return counts.select(class_column, "n", round_to(ratio(total, classes * F.col("n")), 6).alias("class_weight"))


def _pick(fraction: Column, shares: tuple[float, ...]) -> Column:
    edges = [sum(shares[: i + 1]) for i in range(len(shares) - 1)]
    out = F.when(fraction < edges[0], F.lit(SPLITS[0]))
    for edge, name in zip(edges[1:], SPLITS[1:]):
        out = out.when(fraction < edge, F.lit(name))
    return out.otherwise(F.lit(SPLITS[len(shares) - 1]))


def check_shares(shares: tuple[float, ...]) -> None:
    if abs(sum(shares) - 1.0) > 1e-9:
        raise ValueError("split shares must sum to 1")


def stratified_split(
    df: DataFrame, key: str, shares: tuple[float, ...] = RATIOS, class_column: str = "class_name", seed: int = SEED
) -> DataFrame:
    """Adds ``split``: each class is put in hash order and cut at the shares.

    Ranks are exact also for a class that holds most of the rows (see ``ranked``).
    """
    check_shares(shares)
    hashed = df.withColumn("_h", hash_order(seed, F.col(key)))
    placed = ranked(hashed, [class_column], [F.asc("_h"), F.asc(key)])
    sized = placed.join(class_counts(df, class_column), class_column)
    return sized.withColumn("split", _pick((F.col("rank") - 0.5) / F.col("n"), shares)).drop("_h", "rank", "n")


def grouped_stratified_split(
    df: DataFrame, group: str = "source_image_id", shares: tuple[float, ...] = GROUPED_RATIOS,
    class_column: str = "class_name", seed: int = SEED,
) -> DataFrame:
    """Adds ``split`` so that a group never straddles splits.

    Per class the groups are put in hash order, and the running row count decides; a group goes
    where its middle falls.
    """
    check_shares(shares)
    if group not in df.columns:
        df = add_source_image_id(df)
    groups = df.groupBy(group).agg(F.min(class_column).alias("_class"), F.count("*").alias("_size"))
    groups = groups.withColumn("_h", hash_order(seed, F.col(group)))
    placed = ranked(groups, ["_class"], [F.asc("_h"), F.asc(group)], total_of="_size")
    totals = groups.groupBy("_class").agg(F.sum("_size").alias("_rows"))
    middle = (F.col("running") - F.col("_size") / 2.0) / F.col("_rows")
    chosen = placed.join(totals, "_class").select(group, _pick(middle, shares).alias("split"))
    return df.join(chosen, group)


def cross_split_overlap(df: DataFrame, key: str = "source_image_id") -> DataFrame:
    """Keys found in more than one split."""
    # min < max says "more than one" with two partial aggregates and no distinct.
    return df.groupBy(key).agg(F.min("split").alias("_a"), F.max("split").alias("_b")).filter("_a <> _b").select(key)


def split_overlap_audit(df: DataFrame, path: str = "relative_path") -> DataFrame:
    """Rows whose source image occurs in several splits. Sort at write time by
    source_image_id, split, relative_path."""
    rows = add_source_image_id(df, path).select("split", "class_name", F.col(path).alias("relative_path"), "source_image_id")
    return rows.join(cross_split_overlap(rows), "source_image_id", "left_semi")


def split_summary(df: DataFrame, path: str = "relative_path") -> DataFrame:
    """One row: rows per split, overlapping ids, rows involved, classes affected."""
    audit = split_overlap_audit(df, path).agg(
        F.countDistinct("source_image_id").alias("overlapping_source_ids"),
        F.count("*").alias("overlap_rows"),
        F.countDistinct("class_name").alias("classes_affected"),
    )
    counts = df.agg(*[F.sum(flag(F.col("split") == s)).alias(f"{s}_rows") for s in SPLITS])
    row = F.struct("overlapping_source_ids", "overlap_rows", "classes_affected")
    return counts.withColumn("_a", audit.select(row).scalar()).select(*counts.columns, "_a.*")


def split_counts(df: DataFrame, class_column: str = "class_name") -> DataFrame:
    """Class x split counts with a total, zero-filled."""
    wide = df.groupBy(class_column).pivot("split", SPLITS).count().na.fill(0)
    return wide.withColumn("total", reduce(lambda a, b: a + b, [F.col(s) for s in SPLITS]))


def targeted_oversample(
    df: DataFrame, target: int | None, key: str, class_column: str = "class_name", seed: int = SEED
) -> DataFrame:
    """Rows plus repeated rows of the classes below ``target``, drawn with replacement; no target: the largest class.

    ``copy`` is 0 on originals and the draw number on repeats; ``shuffle_key`` orders the output when
    it is written. Only short classes are numbered, by range partitions, and the draws of a class are dealt out in
    runs before each run becomes rows: no task holds a class.
    """
    if target is not None and target <= 0:
        raise ValueError("target must be positive")
    counts = class_counts(df, class_column)
    if target is None:
        target = counts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    short = counts.filter(F.col("n") < target)
    of_short = df.join(short.select(class_column), class_column, "left_semi").withColumn("_hash", hash_order(seed, F.col(key)))
    numbered = ranked(of_short, [class_column], [F.col("_hash"), F.col(key)]).drop("_hash").withColumnRenamed("rank", "_row")
    missing = F.lit(target) - F.col("n")
    runs = short.withColumn("_run", F.explode(F.sequence(F.lit(0), F.ceil(missing / DRAWS) - 1))).repartition(class_column, "_run")
    draws = runs.withColumn("copy", F.explode(F.sequence(F.col("_run") * DRAWS + 1, F.least(missing, (F.col("_run") + 1) * DRAWS))))
    number = F.conv(F.substring(hash_order(seed, F.col(class_column), F.col("copy")), 1, 8), 16, 10).cast("bigint")
    draws = draws.select(class_column, F.col("copy").cast("int").alias("copy"), (number % F.col("n") + 1).cast("int").alias("_row"))
    repeats = draws.join(numbered, [class_column, "_row"]).select(*df.columns, "copy")
    everything = df.withColumn("copy", F.lit(0)).unionByName(repeats)
    return everything.withColumn("shuffle_key", hash_order(seed, F.col(key), F.col("copy")))


def oversample_summary(before: DataFrame, after: DataFrame, class_column: str = "class_name") -> DataFrame:
    a = class_counts(before, class_column).withColumnRenamed("n", "before_count")
    b = class_counts(after, class_column).withColumnRenamed("n", "after_count")
    return a.join(b, class_column).select(
        class_column, "before_count", "after_count", (F.col("after_count") - F.col("before_count")).alias("added_rows"),
        round_to(ratio(F.col("after_count"), F.col("before_count")), 2).alias("ratio"),
    )


def sample_per_class(df: DataFrame, rows: int, classes: int, key: str, class_column: str = "class_name", seed: int = SEED) -> DataFrame:
    """``rows`` rows of each of the first ``classes`` classes; each task keeps only its own first rows."""
    chosen = class_index(df, class_column).filter(F.col("class_index") < classes).select(class_column)
    hashed = df.join(chosen, class_column, "left_semi").withColumn("_h", hash_order(seed, F.col(key)))
    return top_k(hashed, [class_column], [F.asc("_h"), F.asc(key)], rows, "sample_rank").drop("_h")


def dataset_checks(df: DataFrame, expected_classes: int, path: str = "relative_path") -> DataFrame:
    """One row of flags: class count, no null class, no duplicate path, every split has every class."""
    classes = df.select(F.countDistinct("class_name")).scalar()
    repeated = df.groupBy(path).agg(F.count("*").alias("n")).filter("n > 1").select(F.count("*")).scalar()
    cells = df.filter(F.col("class_name").isNotNull()).select("class_name", "split").distinct().select(F.count("*")).scalar()
    return df.agg(F.count(F.when(F.col("class_name").isNull(), 1)).alias("_null")).select(
        (classes == expected_classes).alias("class_count_ok"),
        (F.col("_null") == 0).alias("no_null_class"),
        (repeated == 0).alias("no_duplicate_path"),
        (cells == classes * len(SPLITS)).alias("every_split_has_every_class"),
    )
