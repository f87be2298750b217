"""The five marts. Each is unsorted; `report` gives the reading order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.functions import (
    as_of_date,
    days_between,
    mean_of_rounded,
    percent_change,
    percent_of,
    week_end,
    week_start,
)
from courierlake.functions.temporal import MICROS_PER_MINUTE, mean_minutes, micros_between
from courierlake.operators.percentiles import grouped_percentiles
from courierlake.operators.ranking import add_row_numbers
from courierlake.plans.timeline import delivered_only, rider_daily, with_valid_prep
from courierlake.sources.lake import checkpointed

# Reading order per mart: (column, largest first). The key columns settle ties.
REPORT_ORDER = {
    "sla_breach_analysis": (("breach_rate_pct", True), ("city", False), ("time_slot", False)),
    "restaurant_prep_delays": (("delay_rate_pct", True), ("restaurant_id", False)),
    "refund_drivers": (("refund_count_pct", True), ("refund_driver_category", False)),
    "rider_performance": (("efficiency_score", True), ("rider_id", False)),
    "weekly_trends": (("week_start", False),),
}


def report_order(name: str) -> list[Column]:
    """The reading order of a mart; NULLs come last either way."""
    return [
        F.col(column).desc_nulls_last() if largest_first else F.col(column).asc_nulls_last()
        for column, largest_first in REPORT_ORDER[name]
    ]


def report(name: str, mart: DataFrame) -> DataFrame:
    return mart.orderBy(*report_order(name))


# --- SLA breaches by city and time slot ---------------------------------------------


def sla_daily(timeline: DataFrame) -> DataFrame:
    """Daily figures per city and slot.

    A delivered order without a delivered event counts as an order, not as a
    breach. The breach minutes average over all orders, on-time ones as 0.
    """
    late_us = micros_between("promised_delivery_ts", "delivered_ts")
    late = F.sum(F.when(F.col("is_sla_breached"), late_us).otherwise(0).cast("decimal(38,0)"))
    late = late.cast("double")
    return (
        delivered_only(timeline)
        .groupBy("city", "time_slot", "order_date")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count_if("is_sla_breached").alias("breached_orders"),
            mean_minutes("order_ts", "delivered_ts").alias("avg_delivery_time_minutes"),
            (late / F.count(F.lit(1)) / F.lit(float(MICROS_PER_MINUTE))).alias(
                "avg_breach_minutes"
            ),
        )
    )


def sla_breach_analysis(timeline: DataFrame) -> DataFrame:
    """Breach rate, unweighted means of the daily means, and two ranks."""
    return sla_breaches_of_days(sla_daily(timeline))


def sla_breaches_of_days(daily: DataFrame) -> DataFrame:
    """The mart from its daily figures (:func:`sla_daily`).

    The overall rank is a plain window: there are five rows per city.
    """
    orders, breached = F.sum("total_orders"), F.sum("breached_orders")
    by_slot = (
        daily.groupBy("city", "time_slot")
        .agg(
            orders.alias("total_orders"),
            breached.alias("breached_orders"),
            F.round(percent_of(breached, orders), 2).alias("breach_rate_pct"),
            F.round(F.avg("avg_delivery_time_minutes"), 1).alias("avg_delivery_time_minutes"),
            F.round(F.avg("avg_breach_minutes"), 1).alias("avg_breach_minutes_when_breached"),
            # One row per day already, so counting rows counts distinct days.
            F.count("order_date").alias("days_with_data"),
        )
    )
    worst_first = report_order("sla_breach_analysis")
    overall = F.row_number().over(Window.orderBy(*worst_first))
    in_city = F.row_number().over(Window.partitionBy("city").orderBy(*worst_first))
    return by_slot.withColumns(
        {
            "overall_breach_rank": overall.cast("bigint"),
            "city_breach_rank": in_city.cast("bigint"),
        }
    )


# --- Preparation delays by restaurant -----------------------------------------------


def prep_time_counts(timeline: DataFrame, *by: str) -> DataFrame:
    """Orders and breaches per restaurant and exact preparation time, and per columns `by`.

    Counting equal times before the shuffle spreads a busy restaurant over the
    cluster: its rows are keyed by restaurant and time, not by restaurant.
    """
    return (
        with_valid_prep(timeline)
        .groupBy(
            "restaurant_id", *by, micros_between("accepted_ts", "food_ready_ts").alias("prep_us")
        )
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if("is_sla_breached").alias("breached"),
        )
    )


PREP_FRACTIONS = {"median_us": "0.5", "p95_us": "0.95"}


def prep_percentiles(counts: DataFrame) -> DataFrame:
    """Exact median and 95th percentile of the preparation minutes, unrounded."""
    located = grouped_percentiles(counts, "restaurant_id", "prep_us", "orders", PREP_FRACTIONS)
    return located.select(
        "restaurant_id",
        _minutes(F.col("median_us")).alias("median_prep_time_minutes"),
        _minutes(F.col("p95_us")).alias("p95_prep_time_minutes"),
    )


def restaurant_prep_delays(
    timeline: DataFrame,
    restaurants: DataFrame,
    as_of: dt.date | None = None,
    min_orders: int = 10,
    delay_minutes: float = 20,
    high_risk: tuple[float, float] = (25, 30),
    medium_risk: tuple[float, float] = (20, 20),
) -> DataFrame:
    """Preparation figures and risk class of restaurants with enough orders.

    The risk limits are (mean minutes, delay rate in percent); they compare the
    rounded mean with the unrounded rate.
    """
    # The percentiles read the counts twice; the timeline runs once.
    counts, _ = checkpointed(prep_time_counts(timeline))
    return prep_delays_of_counts(
        counts, restaurants, as_of, min_orders, delay_minutes, high_risk, medium_risk
    )


def prep_delays_of_counts(
    counts: DataFrame,
    restaurants: DataFrame,
    as_of: dt.date | None = None,
    min_orders: int = 10,
    delay_minutes: float = 20,
    high_risk: tuple[float, float] = (25, 30),
    medium_risk: tuple[float, float] = (20, 20),
) -> DataFrame:
    """The mart from its preparation times (:func:`prep_time_counts`)."""
    orders = F.col("orders")
    slow = _minutes(F.col("prep_us")) > delay_minutes
    sums = {
        "total_orders": ("sum", orders),
        "total_us": ("sum", (F.col("prep_us") * orders).cast("decimal(38,0)")),
        "min_us": ("min", F.col("prep_us")),
        "max_us": ("max", F.col("prep_us")),
        "delayed_orders": ("sum", F.when(slow, orders).otherwise(0)),
        "sla_breaches_from_prep": ("sum", F.when(slow, F.col("breached")).otherwise(0)),
    }
    mean_us = F.col("total_us").cast("double") / F.col("total_orders")
    figures = (
        grouped_percentiles(counts, "restaurant_id", "prep_us", "orders", PREP_FRACTIONS, sums)
        .where(F.col("total_orders") >= min_orders)
        .withColumns(
            {
                "avg_prep_time_minutes": F.round(mean_us / F.lit(float(MICROS_PER_MINUTE)), 1),
                "median_prep_time_minutes": _minutes(F.col("median_us")),
                "p95_prep_time_minutes": _minutes(F.col("p95_us")),
                "min_prep_time_minutes": _minutes(F.col("min_us")),
                "max_prep_time_minutes": _minutes(F.col("max_us")),
            }
        )
    )

    rate, mean = percent_of(F.col("delayed_orders"), F.col("total_orders")), "avg_prep_time_minutes"
    risk = (
        F.when((F.col(mean) > high_risk[0]) & (rate > high_risk[1]), "High Risk")
        .when((F.col(mean) > medium_risk[0]) & (rate > medium_risk[1]), "Medium Risk")
        .otherwise("Low Risk")
    )
    about = restaurants.select(
        "restaurant_id", "city", "cuisine_type", "rating_band", "onboarding_date"
    )
    return figures.join(about, "restaurant_id", "left").select(
        "restaurant_id",
        "city",
        "cuisine_type",
        "rating_band",
        "onboarding_date",
        "total_orders",
        mean,
        F.round("median_prep_time_minutes", 1).alias("median_prep_time_minutes"),
        F.round("p95_prep_time_minutes", 1).alias("p95_prep_time_minutes"),
        "min_prep_time_minutes",
        "max_prep_time_minutes",
        "delayed_orders",
        F.round(rate, 2).alias("delay_rate_pct"),
        "sla_breaches_from_prep",
        risk.alias("risk_category"),
        days_between("onboarding_date", as_of_date(as_of)).alias("days_since_onboarding"),
    )


def _minutes(micros: Column) -> Column:
    return micros / F.lit(float(MICROS_PER_MINUTE))


# --- Refund drivers ------------------------------------------------------------------


def refund_drivers(order_refunds: DataFrame) -> DataFrame:
    """Refund counts and amounts per driver category with their shares.

    Only refunds of staged orders take part. The totals are summed over the
    categories, of which there are four, so they need no second pass over the
    refunds and no join.
    """
    amount = F.col("refund_amount")
    by_driver = (
        order_refunds.where("has_refund")
        .groupBy("refund_driver_category")
        .agg(
            F.count(F.lit(1)).alias("refund_count"),
            F.sum(amount).alias("amount"),
            F.round(F.avg(amount), 2).alias("avg_refund_amount"),
            F.min(amount).alias("min_refund_amount"),
            F.max(amount).alias("max_refund_amount"),
        )
    )
    everything = Window.partitionBy()
    totals = by_driver.withColumns(
        {
            "total_refunds": F.sum("refund_count").over(everything),
            "total_amount": F.sum("amount").over(everything),
        }
    )
    return totals.select(
        "refund_driver_category",
        "refund_count",
        F.round(percent_of(F.col("refund_count"), F.col("total_refunds")), 2).alias(
            "refund_count_pct"
        ),
        F.round("amount", 2).alias("refund_amount"),
        F.round(percent_of(F.col("amount"), F.col("total_amount")), 2).alias("refund_amount_pct"),
        "avg_refund_amount",
        "min_refund_amount",
        "max_refund_amount",
        "total_refunds",
        F.round("total_amount", 2).alias("total_refund_amount"),
    )


# --- Rider performance ---------------------------------------------------------------


def rider_summary(daily: DataFrame, min_deliveries: int = 10) -> DataFrame:
    """Totals of the riders with enough deliveries."""
    return (
        daily.groupBy("rider_id")
        .agg(
            F.sum("orders_delivered").alias("total_orders_delivered"),
            F.sum("late_deliveries").alias("total_late_deliveries"),
            F.round(mean_of_rounded(F.col("avg_delivery_time_minutes"), 1), 1).alias(
                "avg_delivery_time_minutes"
            ),
            # One row per day already, so counting rows counts distinct days.
            F.count("order_date").alias("active_days"),
        )
        .where(F.col("total_orders_delivered") >= min_deliveries)
        .withColumn(
            "orders_per_day",
            F.round(F.col("total_orders_delivered") / F.nullif("active_days", F.lit(0)), 1),
        )
    )


def rider_performance(
    timeline: DataFrame,
    riders: DataFrame,
    as_of: dt.date | None = None,
    min_deliveries: int = 10,
) -> DataFrame:
    """On-time rate, efficiency against the city mean, ranks and tier per rider."""
    return rider_performance_of_days(rider_daily(timeline), riders, as_of, min_deliveries)


def rider_performance_of_days(
    daily: DataFrame,
    riders: DataFrame,
    as_of: dt.date | None = None,
    min_deliveries: int = 10,
) -> DataFrame:
    """The mart from the riders' daily figures (:func:`rider_daily`).

    Riders missing from the rider table have no city, and a NULL city has no
    mean, so their efficiency is NULL.
    """
    about = riders.select("rider_id", "city", "shift_type", "joining_date")
    late_share = F.col("total_late_deliveries") / F.col("total_orders_delivered")
    # One row per rider, read by the city means and again by the scores.
    measured, _ = checkpointed(
        rider_summary(daily, min_deliveries)
        .join(about, "rider_id", "left")
        .withColumns(
            {
                "on_time_rate": F.round(1.0 - late_share, 4),
                "tenure_days": days_between("joining_date", as_of_date(as_of)),
            }
        )
    )
    city_means = (
        measured.where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(mean_of_rounded(F.col("orders_per_day"), 1).alias("city_avg_orders_per_day"))
    )
    on_time, pace = F.col("on_time_rate"), F.col("orders_per_day")
    city_pace = F.col("city_avg_orders_per_day")
    tier = (
        F.when((on_time >= 0.95) & (pace >= city_pace), "Star Performer")
        .when(on_time >= 0.90, "Meets Expectations")
        .when(on_time >= 0.80, "Needs Improvement")
        .otherwise("At Risk")
    )
    scored = measured.join(city_means, "city", "left").withColumns(
        {
            "_efficiency": pace / F.nullif(city_pace, F.lit(0.0)) * on_time,
            "performance_tier": tier,
        }
    )
    best_first = [F.col("_efficiency").desc_nulls_last(), F.col("rider_id").asc_nulls_last()]
    ranked = add_row_numbers(
        scored,
        {"city_rank": (["city"], best_first), "overall_rank": ([], best_first)},
    )
    return ranked.select(
        "rider_id",
        "total_orders_delivered",
        "total_late_deliveries",
        "avg_delivery_time_minutes",
        "active_days",
        "orders_per_day",
        "city",
        "shift_type",
        "joining_date",
        "on_time_rate",
        "tenure_days",
        "city_avg_orders_per_day",
        F.round("_efficiency", 3).alias("efficiency_score"),
        F.col("city_rank").cast("bigint").alias("city_rank"),
        F.col("overall_rank").cast("bigint").alias("overall_rank"),
        "performance_tier",
    )


# --- Weekly trends -------------------------------------------------------------------


def weekly_orders(orders: DataFrame) -> DataFrame:
    delivered = F.col("status") == "delivered"
    value = F.col("order_value")
    return orders.groupBy(week_start("order_date").alias("week_start")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(delivered).alias("completed_orders"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled_orders"),
        F.round(F.sum(F.when(delivered, value).otherwise(0.0)), 2).alias("gmv"),
        F.round(F.avg(F.when(delivered, value)), 2).alias("avg_order_value"),
    )


def weekly_refunds(refunds: DataFrame) -> DataFrame:
    return refunds.groupBy(week_start("refund_ts").alias("week_start")).agg(
        F.count(F.lit(1)).alias("refund_count"),
        F.round(F.sum("refund_amount"), 2).alias("refund_amount"),
    )


def weekly_trends(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """Weekly figures and their change against the previous week with orders.

    All refunds count, also those of orders that staging rejects; weeks with
    refunds only are left out. The windows run over one row per calendar week.
    """
    none = F.lit(0)
    weeks = (
        weekly_orders(orders)
        .join(weekly_refunds(refunds), "week_start", "left")
        .withColumns(
            {
                "refund_count": F.coalesce("refund_count", none),
                "refund_amount": F.coalesce("refund_amount", none.cast("double")),
            }
        )
    )
    by_week = Window.orderBy(F.col("week_start").asc_nulls_last())
    changes = {
        f"{name}_wow_pct": percent_change(F.col(name), F.lag(name).over(by_week))
        for name in ("completed_orders", "cancelled_orders", "refund_amount", "gmv")
    }
    rates = {
        "cancellation_rate_pct": percent_of(F.col("cancelled_orders"), F.col("total_orders")),
        "refund_rate_pct": percent_of(F.col("refund_amount"), F.col("gmv")),
    }
    return weeks.select(
        "week_start",
        week_end("week_start").alias("week_end"),
        "total_orders",
        "completed_orders",
        "cancelled_orders",
        "gmv",
        "avg_order_value",
        "refund_count",
        "refund_amount",
        *(F.round(rate, 2).alias(name) for name, rate in rates.items()),
        *(change.alias(name) for name, change in changes.items()),
        F.row_number().over(by_week).cast("bigint").alias("week_number"),
    )
