from pyspark.sql import functions as F

from courierlake.plans import quality, silver
from courierlake.plans.staging import staged
from helpers import at, events, raw_table, rows_of, staged_orders, table


def bronze(df, corrupt=None):
    return df.withColumns(
        {
            "_corrupt_record": F.lit(corrupt).cast("string"),
            "_source_file": F.lit("f"),
            "_ingested_at": F.lit(at("2026-02-01 00:00:00")),
            "_batch_id": F.lit("b"),
        }
    )


def order(order_id, **values):
    base = {
        "customer_id": "c",
        "restaurant_id": "r",
        "city": " Pune ",
        "order_ts": at("2026-01-17 20:00:00"),
        "status": " delivered ",
        "order_value": 10.0,
        "payment_mode": " upi",
    }
    return {"order_id": order_id, **base, **values}


def test_silver_orders(spark):
    rows = raw_table(
        spark,
        "orders",
        order("o1"),
        order("o2", payment_mode=None, order_value=-5.0, customer_id=None),
        order("o3", order_value=0.0, order_ts=at("2026-03-01 03:00:00")),
        order("o4", order_value=None, city=None),
        order("o5", order_value=7.0),
        order("o5", order_value=9.0),  # same batch: the larger value wins
    )
    damaged = raw_table(spark, "orders", order("o6"))
    clean = silver.silver_orders(
        bronze(rows).unionByName(bronze(damaged, "o6,???")), as_of=at("2026-02-01")
    )
    assert rows_of(clean, "order_id", "city", "status", "payment_mode", "order_value") == [
        ("o1", "PUNE", "delivered", "UPI", 10.0),
        ("o2", "PUNE", "delivered", "UNKNOWN", None),
        ("o3", "PUNE", "delivered", "UPI", 0.0),
        ("o4", None, "delivered", "UPI", None),
        ("o5", "PUNE", "delivered", "UPI", 9.0),
    ]
    assert rows_of(clean, "order_id", *silver.ORDER_FLAGS) == [
        ("o1", False, False, False),
        ("o2", True, True, False),
        ("o3", False, True, True),
        ("o4", False, True, False),
        ("o5", False, False, False),
    ]
    calendar = clean.where("order_id in ('o1', 'o3')")
    assert rows_of(calendar, "order_hour", "time_slot", "day_of_week", "is_weekend") == [
        (20, "dinner", 7, True),
        (3, "late_night", 1, True),
    ]
    assert "_corrupt_record" not in clean.columns
    assert rows_of(staged("orders", clean), "order_id") == [("o1",), ("o5",)]


def test_silver_events(spark):
    log = events(
        spark,
        ("o1", "delivered", "2026-01-17 20:00:00"),
        ("o1", "delivered", "2026-01-17 20:05:00"),
        ("o1", "order_confirmed", "2026-01-17 19:00:00"),
        ("o1", "warped", "2026-01-17 19:00:00"),
        ("gone", "rider_assigned", "2026-01-17 19:30:00", "d1"),
        (None, "food_ready", "2026-01-17 19:30:00"),
    )
    clean = silver.silver_events(bronze(log), table(spark, "order_id string", ("o1",)))
    assert rows_of(clean, "order_id", "event_type", *silver.EVENT_FLAGS) == [
        ("gone", "rider_assigned", True, False, False),
        ("o1", "delivered", False, False, True),
        ("o1", "order_confirmed", False, False, False),
        ("o1", "warped", False, True, False),
        (None, "food_ready", None, False, False),
    ]
    # NULL flags drop rows as TRUE ones do.
    assert staged("delivery_events", clean).count() == 3
    assert silver.silver_events(bronze(log), None).where("_dq_orphan_order").count() == 0


def test_item_key(spark):
    items = bronze(
        raw_table(
            spark,
            "order_items",
            {"order_id": "o1", "item_id": "i1", "quantity": 1},
            {"order_id": "o2", "item_id": "i1", "quantity": 2},
            {"order_id": "o2", "item_id": "i1", "quantity": 2},
        )
    )
    assert silver.silver("order_items", items).count() == 2
    assert rows_of(silver.silver_simple(items, ["item_id"]), "order_id") == [("o2",)]


def test_missing_promise_flag(spark):
    orders = staged_orders(
        spark, {"order_id": "o1"}, {"order_id": "o2", "promised_delivery_ts": None}
    )
    flagged = silver.flag_missing_promise(orders)
    assert rows_of(flagged, "order_id", "_dq_missing_promised_ts") == [("o1", False), ("o2", True)]


def test_flag_summary(spark):
    df = table(spark, "a boolean, b boolean", (True, None), (False, None), (True, True))
    summary = quality.flag_summary(df, ["a", "b", "absent"])
    assert rows_of(summary) == [("a", 3, 2, 66.67), ("b", 3, 1, 33.33)]
    empty = quality.flag_summary(df.where("false"), ["a"])
    assert rows_of(empty) == [("a", 0, 0, 0.0)]
    report = quality.quality_report({"t": (df, ["a"]), "u": (df, ["b"])})
    assert quality.format_report(report) == "t.a: 2 of 3 (66.67%)\nu.b: 1 of 3 (33.33%)"


def test_assertions(spark):
    df = table(spark, "k string", ("a",), ("a",), ("b",), (None,), (None,))
    assert rows_of(quality.not_unique(df, "k")) == [("a", 2)]
    assert quality.is_null(df, "k").count() == 2
    shares = table(spark, "refund_count_pct double", (60.0,), (40.05,))
    assert quality.refund_shares_off(shares).count() == 0
    assert rows_of(quality.refund_shares_off(shares.limit(1))) == [(60.0,)]
    assert quality.refund_shares_off(shares.where("false")).count() == 0
    riders = table(spark, "rider_id string", ("a",), ("a",), (None,))
    assert rows_of(quality.check_tables({"stg_riders": riders})) == [
        ("stg_riders", "not_null rider_id", 1),
        ("stg_riders", "unique rider_id", 1),
    ]


def test_order_value_review(spark):
    orders = staged_orders(
        spark,
        {"order_id": "o1", "customer_id": None},
        {"order_id": "o2", "order_value": 0.0},
        {"order_id": "o3"},
    )
    assert rows_of(quality.order_value_review(orders)) == [(3, 1, 1)]
