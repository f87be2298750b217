"""Raw table registry: explicit schemas, file formats and keys.

File readers treat every column as nullable whatever the schema says, so the
keys' presence is checked by assertions (`courierlake.plans.quality`) instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructField, StructType, StringType

CORRUPT = "_corrupt_record"


def schema_of(**types: str) -> StructType:
    schema = StructType()
    for name, type_name in types.items():
        schema.add(name, type_name)
    return schema


@dataclass(frozen=True)
class RawTable:
    name: str
    schema: StructType
    key: tuple[str, ...]
    format: str = "csv"

    @property
    def file(self) -> str:
        return f"{self.name}.{self.format}"

    @property
    def capturing_schema(self) -> StructType:
        """A copy of the schema with room for the text of unreadable records."""
        return StructType([*self.schema.fields, StructField(CORRUPT, StringType())])


# The columns and types of the raw files.
RAW_TABLES: dict[str, RawTable] = {
    table.name: table
    for table in (
        RawTable(
            "orders",
            schema_of(
                order_id="string",
                customer_id="string",
                restaurant_id="string",
                city="string",
                order_ts="timestamp_ntz",
                promised_delivery_ts="timestamp_ntz",
                status="string",
                order_value="double",
                payment_mode="string",
            ),
            ("order_id",),
        ),
        # Item ids alone repeat across orders, so the order belongs to the key.
        # `latest_rows(df, ["item_id"])` gives the narrower rule.
        RawTable(
            "order_items",
            schema_of(
                order_id="string",
                item_id="string",
                quantity="integer",
                item_price="double",
                cuisine_type="string",
            ),
            ("order_id", "item_id"),
        ),
        RawTable(
            "restaurants",
            schema_of(
                restaurant_id="string",
                city="string",
                cuisine_type="string",
                rating_band="string",
                onboarding_date="date",
            ),
            ("restaurant_id",),
        ),
        RawTable(
            "riders",
            schema_of(
                rider_id="string",
                city="string",
                shift_type="string",
                joining_date="date",
            ),
            ("rider_id",),
        ),
        RawTable(
            "refunds",
            schema_of(
                refund_id="string",
                order_id="string",
                refund_ts="timestamp_ntz",
                refund_reason="string",
                refund_amount="double",
            ),
            ("refund_id",),
        ),
        RawTable(
            "support_tickets",
            schema_of(
                ticket_id="string",
                order_id="string",
                ticket_type="string",
                created_ts="timestamp_ntz",
                resolution_status="string",
            ),
            ("ticket_id",),
        ),
        RawTable(
            "delivery_events",
            schema_of(
                order_id="string",
                rider_id="string",
                event_type="string",
                event_ts="timestamp_ntz",
                latitude="double",
                longitude="double",
            ),
            ("order_id", "event_type"),
            format="json",
        ),
    )
}

# The parts of the day with their hours, both ends included.
TIME_SLOTS = (
    ("morning", 8, 11, "Morning (8AM-11AM)"),
    ("lunch", 12, 15, "Lunch (12PM-3PM)"),
    ("evening", 16, 19, "Evening (4PM-7PM)"),
    ("dinner", 20, 23, "Dinner (8PM-11PM)"),
    ("late_night", 0, 7, "Late Night (12AM-7AM)"),
)
TIME_SLOTS_SCHEMA = "time_slot string, start_hour int, end_hour int, label string"
