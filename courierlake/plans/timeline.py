"""Order-level models: the delivery timeline and the refunds of an order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import minutes_between
from courierlake.functions.temporal import mean_minutes
from courierlake.operators.joins import left_join_many

# Timeline column per event type.
MILESTONES = {
    "confirmed_ts": "order_confirmed",
    "accepted_ts": "restaurant_accepted",
    "food_ready_ts": "food_ready",
    "picked_up_ts": "rider_picked_up",
    "delivered_ts": "delivered",
}

# What the timeline takes from an order.
ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "restaurant_id",
    "city",
    "order_ts",
    "promised_delivery_ts",
    "status",
    "order_value",
    "time_slot",
    "order_date",
    "is_weekend",
)


def event_milestones(events: DataFrame) -> DataFrame:
    """One row per order with any event: latest time of each milestone, and its rider."""
    return events.groupBy("order_id").agg(
        *(
            F.max(F.when(F.col("event_type") == event, F.col("event_ts"))).alias(name)
            for name, event in MILESTONES.items()
        ),
        F.max("rider_id").alias("rider_id"),
    )


def order_milestones(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Every staged order with its milestones.

    Events that feed neither a milestone nor the rider are filtered out at the
    scan: the left join can't tell a row of NULLs from no row.
    """
    feeds = F.col("event_type").isin(*MILESTONES.values()) | F.col("rider_id").isNotNull()
    return orders.select(*ORDER_COLUMNS).join(event_milestones(events.where(feeds)), "order_id", "left")


def with_outcome(milestones: DataFrame) -> DataFrame:
    """Durations and SLA outcome of the orders.

    Without a promised time a delivered order counts as not breached, while
    its breach minutes stay NULL.
    """
    delivered, promised = F.col("delivered_ts"), F.col("promised_delivery_ts")
    breached = F.coalesce(delivered > promised, F.lit(False))
    return milestones.withColumns(
        {
            "prep_time_minutes": minutes_between("accepted_ts", "food_ready_ts"),
            "delivery_time_minutes": minutes_between("picked_up_ts", "delivered_ts"),
            "total_time_minutes": minutes_between("order_ts", "delivered_ts"),
            "is_sla_breached": F.when(delivered.isNotNull(), breached),
            "sla_breach_minutes": minutes_between(promised, delivered),
        }
    )


def delivery_timeline(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Every staged order with its milestones, durations and SLA outcome."""
    return with_outcome(order_milestones(orders, events))


def order_refunds(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """Staged orders with their refunds; one row per refund, or one without any."""
    reason = F.col("refund_reason")
    driver = (
        F.when(reason == "Delay", "Delay")
        .when(reason.isin("Missing_Items", "Wrong_Order"), "Missing Items")
        .when(reason == "Cancellation", "Cancellation")
        .otherwise("Other")
    )
    orders = orders.select(
        "order_id", "customer_id", "restaurant_id", "city", "status", "order_value", "order_date"
    )
    refunds = refunds.select(
        "order_id", "refund_id", "refund_ts", "refund_reason", "refund_amount"
    )
    return left_join_many(orders, refunds, "order_id").withColumns(
        {"has_refund": F.col("refund_id").isNotNull(), "refund_driver_category": driver}
    )


def delivered_only(timeline: DataFrame) -> DataFrame:
    return timeline.where(F.col("status") == "delivered")


def with_valid_prep(timeline: DataFrame) -> DataFrame:
    return delivered_only(timeline).where(F.col("prep_time_minutes") > 0)


def rider_daily(timeline: DataFrame) -> DataFrame:
    """Deliveries, late deliveries and mean delivery time per rider and day."""
    return (
        delivered_only(timeline)
        .where(F.col("rider_id").isNotNull())
        .groupBy("rider_id", "order_date")
        .agg(
            F.count(F.lit(1)).alias("orders_delivered"),
            F.count_if("is_sla_breached").alias("late_deliveries"),
            F.round(mean_minutes("picked_up_ts", "delivered_ts"), 1).alias(
                "avg_delivery_time_minutes"
            ),
        )
    )


def restaurant_daily(timeline: DataFrame, delay_minutes: float = 20) -> DataFrame:
    """Orders, mean preparation time and delayed orders per restaurant and day."""
    return (
        with_valid_prep(timeline)
        .groupBy("restaurant_id", "order_date")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.round(mean_minutes("accepted_ts", "food_ready_ts"), 1).alias("avg_prep_time_minutes"),
            F.count_if(F.col("prep_time_minutes") > delay_minutes).alias("delayed_orders"),
        )
    )
