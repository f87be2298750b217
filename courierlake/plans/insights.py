"""Short questions on the marts, and simpler forms on the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import percent_of, week_start
from courierlake.plans.marts import report

TOP = 5


def worst_sla_slots(mart: DataFrame, n: int = TOP) -> DataFrame:
    return (
        report("sla_breach_analysis", mart)
        .select("city", "time_slot", "total_orders", "breach_rate_pct", "overall_breach_rank")
        .limit(n)
    )


def riskiest_restaurants(mart: DataFrame, n: int = TOP) -> DataFrame:
    at_risk = mart.where(F.col("risk_category").isin("High Risk", "Medium Risk"))
    return (
        report("restaurant_prep_delays", at_risk)
        .select(
            "restaurant_id",
            "city",
            "cuisine_type",
            "total_orders",
            "avg_prep_time_minutes",
            "delay_rate_pct",
            "risk_category",
        )
        .limit(n)
    )


def refund_split(mart: DataFrame) -> DataFrame:
    return report("refund_drivers", mart).select(
        "refund_driver_category",
        "refund_count",
        "refund_count_pct",
        "refund_amount",
        "avg_refund_amount",
    )


def star_riders(mart: DataFrame, n: int = TOP) -> DataFrame:
    stars = mart.where(F.col("performance_tier") == "Star Performer")
    return (
        report("rider_performance", stars)
        .select(
            "rider_id",
            "city",
            "total_orders_delivered",
            F.round(F.col("on_time_rate") * 100, 1).alias("on_time_pct"),
            "efficiency_score",
            "performance_tier",
        )
        .limit(n)
    )


def latest_weeks(mart: DataFrame, n: int = TOP) -> DataFrame:
    return (
        mart.orderBy(F.col("week_start").desc_nulls_last())
        .select(
            F.col("week_start").alias("week"),
            "total_orders",
            "completed_orders",
            "cancelled_orders",
            F.round("gmv", 0).alias("gmv"),
            "cancellation_rate_pct",
            "gmv_wow_pct",
        )
        .limit(n)
    )


# --- The same questions without the marts --------------------------------------------


def orders_with_deliveries(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders LEFT JOIN their delivered events, one row per such event.

    Staged events have one row per order and type, so the right side has no
    hot key, and AQE can split the left one.
    """
    delivered = events.where(F.col("event_type") == "delivered").select(
        "order_id", F.col("event_ts").alias("delivered_ts")
    )
    return orders.join(delivered, "order_id", "left")


def raw_sla_slots(orders: DataFrame, events: DataFrame, n: int = TOP) -> DataFrame:
    delivered = orders.where(F.col("status") == "delivered").select(
        "order_id", "city", "time_slot", "promised_delivery_ts"
    )
    late = F.count_if(F.col("delivered_ts") > F.col("promised_delivery_ts"))
    rows = F.count(F.lit(1))
    return (
        orders_with_deliveries(delivered, events)
        .groupBy("city", "time_slot")
        .agg(
            rows.alias("total_orders"),
            F.round(percent_of(late, rows), 2).alias("breach_rate_pct"),
        )
        .orderBy(F.col("breach_rate_pct").desc_nulls_last(), "city", "time_slot")
        .limit(n)
    )


def raw_busiest_restaurants(orders: DataFrame, n: int = TOP) -> DataFrame:
    return (
        orders.where(F.col("status") == "delivered")
        .groupBy("restaurant_id")
        .agg(F.count(F.lit(1)).alias("total_orders"))
        .orderBy(F.col("total_orders").desc(), F.col("restaurant_id").asc_nulls_last())
        .limit(n)
    )


def raw_refund_reasons(refunds: DataFrame) -> DataFrame:
    return (
        refunds.groupBy("refund_reason")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.round(F.sum("refund_amount"), 2).alias("total_amount"),
        )
        .orderBy(F.col("count").desc(), F.col("refund_reason").asc_nulls_last())
    )


def raw_busiest_riders(events: DataFrame, n: int = TOP) -> DataFrame:
    return (
        events.where(F.col("event_type") == "delivered")
        .groupBy("rider_id")
        .agg(F.count(F.lit(1)).alias("deliveries"))
        .orderBy(F.col("deliveries").desc(), F.col("rider_id").asc_nulls_last())
        .limit(n)
    )


def raw_latest_weeks(orders: DataFrame, n: int = TOP) -> DataFrame:
    return (
        orders.groupBy(week_start("order_date").alias("week"))
        .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("order_value"), 0).alias("gmv"))
        .orderBy(F.col("week").desc_nulls_last())
        .limit(n)
    )
