"""Weekly demand per producer and product, its trend and a next-week forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round_to

# Forecast basis and alert wording by trend.
FORECAST_BASIS = "latest_3_week_moving_average"
ALERT_BY_TREND = {"up": "High demand expected", "down": "Lower demand expected", "stable": "Stable demand expected"}


def weekly_demand(lines: DataFrame) -> DataFrame:
    """Quantity per producer, product, name and Monday-based week; lines without a producer drop."""
    keyed = lines.filter(
        F.col("producer_id").isNotNull() & F.col("product_id").isNotNull() & F.col("product_name").isNotNull()
    )
    week = F.to_date(F.date_trunc("week", "order_date")).alias("week_start")
    return keyed.groupBy("producer_id", "product_id", "product_name", week).agg(F.sum("quantity").alias("quantity_ordered"))


def demand_trend(lines: DataFrame) -> DataFrame:
    """Moving average over the last three observed weeks (gaps are not filled) and its direction."""
    order = Window.partitionBy("producer_id", "product_id").orderBy("week_start", "product_name")
    average = round_to(F.avg("quantity_ordered").over(order.rowsBetween(-2, 0)), 4)
    trended = weekly_demand(lines).withColumn("moving_average_3w", average)
    before = F.lag("moving_average_3w").over(order)
    direction = (
        F.when(F.col("moving_average_3w") > before, F.lit("up"))
        .when(F.col("moving_average_3w") < before, F.lit("down"))
        .otherwise(F.lit("stable"))
    )
    return trended.withColumn("trend_direction", direction)


def demand_forecast(trend: DataFrame) -> DataFrame:
    """Forecast of the week after each product's own last active week."""
    latest = Window.partitionBy("producer_id", "product_id").orderBy(F.desc("week_start"), F.asc("product_name"))
    last = trend.withColumn("_at", F.row_number().over(latest)).filter("_at = 1")
    return last.select(
        "producer_id",
        "product_id",
        "product_name",
        F.date_add("week_start", 7).alias("forecast_week_start"),
        round_to(F.col("moving_average_3w"), 2).alias("predicted_quantity_next_week"),
        F.lit(FORECAST_BASIS).alias("basis"),
        "trend_direction",
    )


def producer_forecast_lookup(forecast: DataFrame, requested: DataFrame, producers: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(first k forecast rows of each requested producer with an alert, requested ids that are unknown)."""
    known = producers.select("producer_id").distinct()
    unknown = requested.select("producer_id").distinct().join(known, "producer_id", "left_anti")
    wanted = requested.select("producer_id").join(known, "producer_id", "left_semi")
    order = Window.partitionBy("producer_id").orderBy(F.desc("predicted_quantity_next_week"), F.asc("product_id"))
    rows = forecast.join(wanted, "producer_id", "left_semi").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    prefix = (
        F.when(F.col("trend_direction") == "up", F.lit(ALERT_BY_TREND["up"]))
        .when(F.col("trend_direction") == "down", F.lit(ALERT_BY_TREND["down"]))
        .otherwise(F.lit(ALERT_BY_TREND["stable"]))
    )
    alert = F.concat(prefix, F.lit(" for "), F.col("product_name"), F.lit(" next week based on recent order trends."))
    return rows.withColumn("alert_text", alert), unknown
