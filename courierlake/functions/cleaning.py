"""Field normalisation and row-level quality flags."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from courierlake.functions.temporal import as_of_timestamp

# The event vocabulary in the order an order passes through it.
# The last three are alternative endings.
EVENT_TYPES = (
    "order_confirmed",
    "restaurant_accepted",
    "food_prep_started",
    "food_ready",
    "rider_assigned",
    "rider_picked_up",
    "out_for_delivery",
    "delivered",
    "delivery_failed",
    "cancelled",
)

# Events that only a rider can cause.
RIDER_EVENT_TYPES = ("rider_assigned", "rider_picked_up", "out_for_delivery", "delivered")


def tidy(column: str) -> Column:
    return F.trim(F.col(column))


def tidy_upper(column: str) -> Column:
    return F.upper(tidy(column))


def default_unknown(value: Column) -> Column:
    return F.coalesce(value, F.lit("UNKNOWN"))


def null_if_negative(column: str) -> Column:
    value = F.col(column)
    return F.when(value < 0, None).otherwise(value)


def has_null_customer() -> Column:
    return F.col("customer_id").isNull()


def invalid_order_value() -> Column:
    value = F.col("order_value")
    return value.isNull() | (value <= 0)


def future_order(as_of: dt.datetime | None = None) -> Column:
    return F.col("order_ts") > as_of_timestamp(as_of)


def missing_promised_time() -> Column:
    return F.col("promised_delivery_ts").isNull()


def invalid_event_type() -> Column:
    return ~F.col("event_type").isin(*EVENT_TYPES)


def missing_rider() -> Column:
    return F.col("event_type").isin(*RIDER_EVENT_TYPES) & F.col("rider_id").isNull()
