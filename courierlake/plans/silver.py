"""Bronze to silver: readable, deduplicated, normalised, flagged rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake import functions as fn
from courierlake.operators.joins import flag_orphans, flag_unknown, unknown_ids
from courierlake.operators.latest import latest_rows
from courierlake.sources.schemas import CORRUPT, RAW_TABLES

ORDER_FLAGS = ("_dq_has_null_customer", "_dq_invalid_order_value", "_dq_future_order")
EVENT_FLAGS = ("_dq_orphan_order", "_dq_invalid_event_type", "_dq_missing_rider")


def drop_corrupt(df: DataFrame) -> DataFrame:
    if CORRUPT not in df.columns:
        return df
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def normalise_orders(orders: DataFrame) -> DataFrame:
    """Trim and upper-case text, fill the payment mode, blank negative values."""
    return orders.withColumns(
        {
            "city": fn.tidy_upper("city"),
            "status": fn.tidy("status"),
            "payment_mode": fn.default_unknown(fn.tidy_upper("payment_mode")),
            "order_value": fn.null_if_negative("order_value"),
        }
    )


def add_order_calendar(orders: DataFrame) -> DataFrame:
    """Date, hour, slot, weekday (1 is Sunday) and weekend of the order time."""
    hour, weekday = F.hour("order_ts"), F.dayofweek("order_ts")
    return orders.withColumns(
        {
            "order_date": F.col("order_ts").cast("date"),
            "order_hour": hour,
            "time_slot": fn.time_slot(hour),
            "day_of_week": weekday,
            "is_weekend": weekday.isin(1, 7),
        }
    )


def flag_orders(orders: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    return orders.withColumns(
        {
            "_dq_has_null_customer": fn.has_null_customer(),
            "_dq_invalid_order_value": fn.invalid_order_value(),
            "_dq_future_order": fn.future_order(as_of),
        }
    )


def flag_missing_promise(orders: DataFrame) -> DataFrame:
    """Extra flag, off by default: no promised time, so a breach cannot be told."""
    return orders.withColumn("_dq_missing_promised_ts", fn.missing_promised_time())


def latest_orders(bronze: DataFrame) -> DataFrame:
    """The readable orders with their day, all else of silver follows from the row."""
    rows = latest_rows(drop_corrupt(bronze), RAW_TABLES["orders"].key)
    return rows.withColumn("order_date", F.col("order_ts").cast("date"))


def finish_orders(rows: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    return flag_orders(add_order_calendar(normalise_orders(rows)), as_of)


def silver_orders(bronze: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    return finish_orders(latest_orders(bronze), as_of)


def silver_events(
    bronze: DataFrame, bronze_orders: DataFrame | None, unknown: DataFrame | None = None
) -> DataFrame:
    """Deduplicated events with flags.

    Deduplication comes before the orphan join on purpose. Joining first would
    save a shuffle, as the join's partitioning by order also serves the window,
    but then all copies of one event would meet in one task before any of them
    is dropped. This way map tasks drop copies before the first shuffle.
    With `unknown`, the stored ids of `unknown_orders`, these tell the orphans.
    """
    rows = latest_rows(drop_corrupt(bronze), RAW_TABLES["delivery_events"].key)
    flagged = flag_orphans(rows, bronze_orders) if unknown is None else flag_unknown(rows, unknown)
    return flagged.withColumns(
        {
            "_dq_invalid_event_type": fn.invalid_event_type(),
            "_dq_missing_rider": fn.missing_rider(),
        }
    )


def unknown_orders(bronze_events: DataFrame, bronze_orders: DataFrame) -> DataFrame:
    """Order ids of readable events that no order has."""
    return unknown_ids(drop_corrupt(bronze_events), bronze_orders)


def silver_simple(bronze: DataFrame, key: Sequence[str]) -> DataFrame:
    return latest_rows(drop_corrupt(bronze), key)


def silver(name: str, bronze: DataFrame) -> DataFrame:
    """Silver form of a table that only needs deduplication."""
    return silver_simple(bronze, RAW_TABLES[name].key)
