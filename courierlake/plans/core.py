"""Core tables: dimensions and the order fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.functions import day_name, mean_of_rounded, month_start, week_start
from courierlake.plans.timeline import restaurant_daily

# The columns of the order fact.
FACT_COLUMNS = (
    "order_id",
    "customer_id",
    "restaurant_id",
    "rider_id",
    "city",
    "status",
    "order_value",
    "time_slot",
    "order_ts",
    "promised_delivery_ts",
    "order_date",
    "is_weekend",
    "confirmed_ts",
    "accepted_ts",
    "food_ready_ts",
    "picked_up_ts",
    "delivered_ts",
    "prep_time_minutes",
    "delivery_time_minutes",
    "total_time_minutes",
    "is_sla_breached",
    "sla_breach_minutes",
)


def fct_orders(timeline: DataFrame) -> DataFrame:
    return timeline.select(*FACT_COLUMNS)


def dim_riders(riders: DataFrame) -> DataFrame:
    return riders.select("rider_id", "city", "shift_type", "joining_date")


def dim_restaurants(restaurants: DataFrame, timeline: DataFrame) -> DataFrame:
    """Restaurants with lifetime preparation figures.

    The mean is the unweighted mean of the daily means. Counts of restaurants
    without deliveries are 0, their mean is NULL.
    """
    lifetime = (
        restaurant_daily(timeline)
        .groupBy("restaurant_id")
        .agg(
            F.sum("total_orders").alias("orders"),
            F.round(mean_of_rounded(F.col("avg_prep_time_minutes"), 1), 1).alias(
                "avg_prep_time_minutes"
            ),
            F.sum("delayed_orders").alias("delayed"),
        )
    )
    return restaurants.join(lifetime, "restaurant_id", "left").select(
        "restaurant_id",
        "city",
        "cuisine_type",
        "rating_band",
        "onboarding_date",
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        "avg_prep_time_minutes",
        F.coalesce("delayed", F.lit(0)).alias("total_delayed_orders"),
    )


def date_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row with the bounds of a calendar."""
    return spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day"))


def order_date_range(orders: DataFrame) -> DataFrame:
    """One row with the first and last order date."""
    return orders.agg(
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """The calendar between the bounds, both included; one row per day.

    `day_of_week` counts from 0 for Sunday. `year` is the calendar year while
    `iso_week` follows ISO rules, so the two do not form a key.
    """
    day, weekday = F.col("date_day"), F.dayofweek("date_day") - 1
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_day")).select(
        "date_day",
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        weekday.cast("bigint").alias("day_of_week"),
        F.weekofyear(day).cast("bigint").alias("iso_week"),
        weekday.isin(0, 6).alias("is_weekend"),
        day_name(day).alias("day_name"),
        week_start(day).alias("week_start"),
        month_start(day).alias("month_start"),
    )
