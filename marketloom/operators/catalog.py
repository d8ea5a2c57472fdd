"""Catalogue events: validation, latest state per entity, overlay on the base tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Tables
from .joins import left_join_keyed
from .ranking import ranked

ISO = "yyyy-MM-dd'T'HH:mm:ss"
ISO_FRACTION = ISO + ".SSSSSS"


def _text(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


def trimmed_ids(df: DataFrame, *names: str) -> DataFrame:
    """Ids that are text without blanks at their ends; other ids as they are."""
    text = [n for n in names if df.schema[n].dataType.simpleString() == "string"]
    return df.withColumns({n: F.trim(F.col(n)) for n in text})


def _blank(name: str) -> Column:
    return F.coalesce(_text(name) == "", F.lit(True))


def first_reason(*rules: tuple[Column, str]) -> Column:
    """Name of the first rule that is broken, or null."""
    broken = F.lit(None).cast("string")
    for condition, name in reversed(rules):
        broken = F.when(condition, F.lit(name)).otherwise(broken)
    return broken


def _iso_time() -> Column:
    """The time as ISO text, with microseconds if it has a fraction of a second."""
    time = F.try_to_timestamp(F.col("created_at"))
    return F.when(F.unix_micros(time) % 1_000_000 == 0, F.date_format(time, ISO)).otherwise(F.date_format(time, ISO_FRACTION))


def _split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = F.col("reject_reason").isNull()
    return checked.filter(ok).drop("reject_reason"), checked.filter(~ok)


def normalise_producer_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid and trimmed, rejected with a reason) producer upserts."""
    reason = first_reason(
        (F.coalesce(F.col("event_type") != "producer_upserted", F.lit(True)), "wrong event_type"),
        (F.try_to_timestamp(F.col("created_at")).isNull(), "invalid created_at"),
        (_blank("producer_id") | _blank("producer_name") | _blank("postcode_area") | _blank("source"), "empty required field"),
    )
    valid, rejected = _split(trimmed_ids(events, "producer_id").withColumn("reject_reason", reason))
    categories = F.filter(F.transform(F.coalesce("categories", F.array().cast("array<string>")), lambda c: F.trim(c)), lambda c: c != "")
    return (
        valid.select(
            "seq", "event_type", "producer_id", _text("producer_name").alias("producer_name"),
            _text("postcode_area").alias("postcode_area"), categories.alias("categories"), "organic_certified",
            _iso_time().alias("created_at"), _text("source").alias("source"),
        ),
        rejected,
    )


def normalise_product_events(events: DataFrame, producers: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) product upserts; unknown producers reject when a producer table is given."""
    seasonal = F.coalesce("seasonal", F.lit(False))
    start, end = F.col("seasonal_start_month"), F.col("seasonal_end_month")
    bad_months = seasonal & ~F.coalesce(start.between(1, 12) & end.between(1, 12), F.lit(False))
    rules = [
        (F.coalesce(F.col("event_type") != "product_upserted", F.lit(True)), "wrong event_type"),
        (bad_months, "months outside 1..12"),
        (F.try_to_timestamp(F.col("created_at")).isNull(), "invalid created_at"),
        (F.coalesce(F.col("price") < 0, F.lit(True)), "invalid price"),
    ]
    events = trimmed_ids(events, "producer_id", "product_id")
    if producers is not None:
        known = producers.select("producer_id").distinct().withColumn("_known", F.lit(True))
        events = left_join_keyed(events, known, "producer_id", ["seq"])
        rules.append((F.col("_known").isNull(), "unknown producer_id"))
    checked = events.withColumn("reject_reason", first_reason(*rules))
    valid, rejected = _split(checked.drop("_known") if producers is not None else checked)
    return (
        valid.select(
            "seq", "event_type", "product_id", "producer_id", _text("product_name").alias("product_name"),
            _text("category").alias("category"), _text("unit").alias("unit"), "price", seasonal.alias("seasonal"),
            F.when(seasonal, start).otherwise(F.lit(1)).alias("seasonal_start_month"),
            F.when(seasonal, end).otherwise(F.lit(12)).alias("seasonal_end_month"),
            F.coalesce("available", F.lit(False)).alias("available"),
            _iso_time().alias("created_at"), _text("source").alias("source"),
        ),
        rejected,
    )


def latest_by_key(events: DataFrame, key: str, time: str = "created_at", seq: str = "seq") -> DataFrame:
    """The latest event of each entity; a later log position wins a tie. Empty ids drop.

    Times compare as times; one that cannot be parsed sorts below and compares as text. A partial
    maximum per task means an entity with very many events still shuffles one row per task.
    """
    named = events.filter(~_blank(key))
    order = F.struct(F.try_to_timestamp(F.col(time)).alias("t"), F.coalesce(F.col(time), F.lit("")).alias("s"), F.col(seq).alias("q"))
    rest = [c for c in events.columns if c != key]
    return named.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("e")).select(key, "e.*")


def catalog_anti_union(base: DataFrame, overlay: DataFrame, key: str) -> DataFrame:
    """Base rows that have no overlay row, and all overlay rows; missing columns become null."""
    return base.join(overlay.select(key), key, "left_anti").unionByName(overlay, allowMissingColumns=True)


def producer_overlay(events: DataFrame) -> DataFrame:
    return latest_by_key(events, "producer_id").select(
        "producer_id", "producer_name", "postcode_area",
        F.col("source").alias("catalog_event_source"), F.col("created_at").alias("catalog_event_created_at"),
    )


def product_overlay(events: DataFrame) -> DataFrame:
    return latest_by_key(events, "product_id").select(
        "product_id", "product_name", F.lit("").alias("description"), "category", "producer_id",
        "seasonal_start_month", "seasonal_end_month", F.col("price").alias("base_price"), "unit",
        F.lit("").alias("allergen_info"), F.lit(None).cast("double").alias("stock_quantity"),
        F.when(F.col("available"), F.lit("available")).otherwise(F.lit("unavailable")).alias("availability_status"),
        F.col("source").alias("catalog_event_source"), F.col("created_at").alias("catalog_event_created_at"),
    )


def apply_producer_events(tables: Tables, valid: DataFrame) -> Tables:
    return tables.with_(producers=catalog_anti_union(tables.producers, producer_overlay(valid), "producer_id"))


def apply_product_events(tables: Tables, valid: DataFrame) -> Tables:
    return tables.with_(products=catalog_anti_union(tables.products, product_overlay(valid), "product_id"))


def apply_catalog_events(tables: Tables, producer_events: DataFrame, product_events: DataFrame) -> Tables:
    """Both overlays; products are checked against the producers known after the producer overlay."""
    with_producers = apply_producer_events(tables, normalise_producer_events(producer_events)[0])
    valid, _ = normalise_product_events(product_events, with_producers.producers)
    return apply_product_events(with_producers, valid)


def catalog_receipts(base: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    """One row for each accepted catalogue event with the distinct ids of the catalogue up to it, in log order.

    An id counts at its first event if the base table does not hold it; the flags are summed over range partitions.
    """
    named = valid.select("seq", key)
    known = base.select(key).filter(F.col(key).isNotNull()).distinct()
    first = named.join(known, key, "left_anti").groupBy(key).agg(F.min("seq").alias("_first"))
    flagged = named.join(first, key, "left").withColumn("_new", F.coalesce(F.col("seq") == F.col("_first"), F.lit(False)).cast("bigint"))
    counted = ranked(flagged.select("seq", key, "_new"), [], [F.col("seq")], total_of="_new")
    before = known.select(F.count("*")).scalar()
    return counted.select("seq", F.lit("ingested").alias("status"), key, (F.col("running") + before).alias("catalog_so_far"))


def catalog_receipt(tables: Tables) -> DataFrame:
    """Distinct producers and products after an ingest."""
    producers = tables.producers.select(F.countDistinct("producer_id")).scalar()
    return tables.products.agg(F.countDistinct("product_id").alias("catalog_products")).withColumn("catalog_producers", producers)
