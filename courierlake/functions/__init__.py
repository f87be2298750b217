from courierlake.functions.cleaning import (
    EVENT_TYPES,
    RIDER_EVENT_TYPES,
    default_unknown,
    future_order,
    has_null_customer,
    invalid_event_type,
    invalid_order_value,
    missing_promised_time,
    missing_rider,
    null_if_negative,
    tidy,
    tidy_upper,
)
from courierlake.functions.numbers import mean_of_rounded, percent_change, percent_of
from courierlake.functions.temporal import (
    as_of_date,
    days_between,
    day_name,
    micros_between,
    minutes_between,
    month_start,
    time_slot,
    week_end,
    week_start,
)

__all__ = [
    "EVENT_TYPES",
    "RIDER_EVENT_TYPES",
    "as_of_date",
    "day_name",
    "days_between",
    "default_unknown",
    "future_order",
    "has_null_customer",
    "invalid_event_type",
    "invalid_order_value",
    "mean_of_rounded",
    "micros_between",
    "minutes_between",
    "missing_promised_time",
    "missing_rider",
    "month_start",
    "null_if_negative",
    "percent_change",
    "percent_of",
    "tidy",
    "tidy_upper",
    "time_slot",
    "week_end",
    "week_start",
]
