"""Silver to staging: the columns and rows the models read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns of each staged table.
STAGED_COLUMNS = {
    "orders": (
        "order_id",
        "customer_id",
        "restaurant_id",
        "city",
        "status",
        "payment_mode",
        "time_slot",
        "order_ts",
        "promised_delivery_ts",
        "order_date",
        "order_hour",
        "day_of_week",
        "is_weekend",
        "order_value",
        "_dq_has_null_customer",
        "_dq_invalid_order_value",
        "_ingested_at",
    ),
    "delivery_events": (
        "order_id",
        "rider_id",
        "event_type",
        "event_ts",
        "latitude",
        "longitude",
        "_dq_orphan_order",
        "_ingested_at",
    ),
    "order_items": (
        "order_id",
        "item_id",
        "quantity",
        "item_price",
        "cuisine_type",
        "_ingested_at",
    ),
    "restaurants": (
        "restaurant_id",
        "city",
        "cuisine_type",
        "rating_band",
        "onboarding_date",
        "_ingested_at",
    ),
    "riders": ("rider_id", "city", "shift_type", "joining_date", "_ingested_at"),
    "refunds": (
        "refund_id",
        "order_id",
        "refund_ts",
        "refund_reason",
        "refund_amount",
        "_ingested_at",
    ),
    "support_tickets": (
        "ticket_id",
        "order_id",
        "ticket_type",
        "created_ts",
        "resolution_status",
        "_ingested_at",
    ),
}


def staged(name: str, silver: DataFrame) -> DataFrame:
    rows = silver
    if name == "orders":
        rows = rows.where(~F.col("_dq_invalid_order_value"))
    elif name == "delivery_events":
        # A NULL flag (event without an order id) drops the row as well.
        rows = rows.where(~F.col("_dq_orphan_order"))
    return rows.select(*STAGED_COLUMNS[name])
