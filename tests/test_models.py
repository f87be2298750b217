import datetime as dt

import pytest

from courierlake.plans import core, insights, marts
from courierlake.plans import timeline as tl
from helpers import at, events, plan_of, raw_table, rows_of, staged_orders, table

DAY = dt.date(2026, 1, 19)  # a Monday


def delivered_orders(spark, *specs):
    """Timeline rows from (order, restaurant, rider, day, prep minutes, total minutes)."""
    orders, log = [], []
    for order_id, restaurant, rider, day, prep, total in specs:
        start = dt.datetime.combine(day, dt.time(12))
        orders.append(
            {
                "order_id": order_id,
                "restaurant_id": restaurant,
                "order_ts": start,
                "promised_delivery_ts": start + dt.timedelta(minutes=40),
            }
        )
        steps = {"restaurant_accepted": 0, "food_ready": prep, "delivered": total}
        log += [
            (
                order_id,
                event,
                str(start + dt.timedelta(minutes=minutes)),
                rider if event == "delivered" else None,
            )
            for event, minutes in steps.items()
            if minutes is not None
        ]
    return tl.delivery_timeline(staged_orders(spark, *orders), events(spark, *log))


def test_timeline(spark):
    orders = staged_orders(
        spark,
        {"order_id": "late"},
        {"order_id": "early"},
        {"order_id": "open"},
        {"order_id": "unpromised", "promised_delivery_ts": None},
    )
    log = events(
        spark,
        ("late", "order_confirmed", "2026-01-19 12:01:00"),
        ("late", "restaurant_accepted", "2026-01-19 12:02:00"),
        ("late", "food_ready", "2026-01-19 12:20:30"),
        ("late", "rider_picked_up", "2026-01-19 12:25:00", "d1"),
        ("late", "delivered", "2026-01-19 12:40:00.000001", "d2"),
        ("early", "delivered", "2026-01-19 12:20:00", "d1"),
        ("early", "delivered", "2026-01-19 12:40:00", "d1"),  # the latest counts
        ("open", "food_prep_started", "2026-01-19 12:05:00"),
        ("unpromised", "delivered", "2026-01-19 14:00:00", "d1"),
        ("unknown", "delivered", "2026-01-19 14:00:00", "d1"),
    )
    timeline = tl.delivery_timeline(orders, log)
    found = {row.order_id: row for row in timeline.collect()}
    assert found.keys() == {"late", "early", "open", "unpromised"}
    late = found["late"]
    assert (late.prep_time_minutes, late.rider_id, late.is_sla_breached) == (18.5, "d2", True)
    assert late.sla_breach_minutes == pytest.approx(1 / 60e6, rel=1e-12)
    assert late.delivery_time_minutes == pytest.approx(15 + 1 / 60e6, rel=1e-12)
    assert (found["early"].is_sla_breached, found["early"].sla_breach_minutes) == (False, 0.0)
    assert found["open"].is_sla_breached is None and found["open"].rider_id is None
    unpromised = found["unpromised"]
    assert (unpromised.is_sla_breached, unpromised.sla_breach_minutes) == (False, None)
    assert core.fct_orders(timeline).columns == list(core.FACT_COLUMNS)


def test_timeline_reads_needed_columns_only(spark, folder):
    path = f"{folder}/events"
    events(spark, ("o1", "delivered", "2026-01-19 12:00:00")).write.parquet(path)
    orders = staged_orders(spark, {"order_id": "o1"})
    plan = plan_of(tl.delivery_timeline(orders, spark.read.parquet(path)))
    assert "latitude" not in plan
    assert "Or(In(event_type" in plan


def test_order_refunds(spark):
    orders = staged_orders(spark, *({"order_id": o} for o in ("o1", "o2", "o3", "o4")))
    refunds = raw_table(
        spark,
        "refunds",
        {"refund_id": "f1", "order_id": "o1", "refund_reason": "Delay", "refund_amount": 1.0},
        {"refund_id": "f2", "order_id": "o1", "refund_reason": "Wrong_Order", "refund_amount": 2.0},
        {"refund_id": "f3", "order_id": "o2", "refund_reason": None, "refund_amount": None},
        {"refund_id": None, "order_id": "o4", "refund_reason": "Cancellation"},
        {"refund_id": "f5", "order_id": "gone", "refund_reason": "Delay", "refund_amount": 9.0},
        {"refund_id": "f6", "order_id": None, "refund_reason": "Delay", "refund_amount": 9.0},
    )
    joined = tl.order_refunds(orders, refunds)
    columns = ("order_id", "refund_id", "has_refund", "refund_driver_category")
    assert rows_of(joined, *columns) == [
        ("o1", "f1", True, "Delay"),
        ("o1", "f2", True, "Missing Items"),
        ("o2", "f3", True, "Other"),
        ("o3", None, False, "Other"),
        ("o4", None, False, "Cancellation"),
    ]
    mart = marts.refund_drivers(joined)
    assert rows_of(mart, "refund_driver_category", "refund_count", "refund_count_pct") == [
        ("Delay", 1, 33.33),
        ("Missing Items", 1, 33.33),
        ("Other", 1, 33.33),
    ]
    other = mart.where("refund_driver_category = 'Other'").first()
    assert (other.refund_amount, other.refund_amount_pct, other.total_refund_amount) == (
        None,
        None,
        3.0,
    )
    # Orders without refunds are not even read for the mart.
    assert "LeftAnti" not in plan_of(mart)
    assert rows_of(insights.raw_refund_reasons(refunds), "refund_reason", "count") == [
        ("Cancellation", 1),
        ("Delay", 3),
        ("Wrong_Order", 1),
        (None, 1),
    ]


def test_zero_refund_total(spark):
    orders = staged_orders(spark, {"order_id": "o1"})
    refunds = raw_table(
        spark, "refunds", {"refund_id": "f1", "order_id": "o1", "refund_amount": 0.0}
    )
    row = marts.refund_drivers(tl.order_refunds(orders, refunds)).first()
    assert (row.refund_count_pct, row.refund_amount_pct) == (100.0, None)


def test_sla_mart(spark):
    timeline = delivered_orders(
        spark,
        ("a", "r", "d", DAY, 5, 50),
        ("b", "r", "d", DAY, 5, 30),
        ("c", "r", "d", DAY, 5, None),  # delivered by status only
        ("d", "r", "d", DAY + dt.timedelta(days=1), 5, 60),
    )
    row = marts.sla_breach_analysis(timeline).first()
    assert (row.city, row.time_slot, row.total_orders, row.breached_orders) == ("PUNE", "lunch", 4, 2)
    assert row.breach_rate_pct == 50.0
    # Mean of the daily means (40 and 60), not of the orders.
    assert row.avg_delivery_time_minutes == 50.0
    # Day one: (10 + 0 + 0) / 3; day two: 20.
    assert row.avg_breach_minutes_when_breached == 11.7
    assert (row.days_with_data, row.overall_breach_rank, row.city_breach_rank) == (2, 1, 1)


def test_sla_ranks_break_ties_by_key(spark):
    cities = ("A", "B", None)
    orders = staged_orders(spark, *({"order_id": f"{c}", "city": c} for c in cities))
    timeline = tl.delivery_timeline(orders, events(spark))
    mart = marts.sla_breach_analysis(timeline)
    assert [
        (row.city, row.overall_breach_rank, row.city_breach_rank)
        for row in marts.report("sla_breach_analysis", mart).collect()
    ] == [("A", 1, 1), ("B", 2, 1), (None, 3, 1)]


def test_restaurant_mart(spark):
    specs = [(f"a{n}", "slow", "d", DAY, 21 + n, 50) for n in range(10)]
    specs += [(f"b{n}", "few", "d", DAY, 30, 50) for n in range(9)]
    specs += [(f"c{n}", "fine", "d", DAY, 10 if n else 25, 30) for n in range(10)]
    specs += [(f"d{n}", "mid", "d", DAY, 18 if n < 7 else 27, 30) for n in range(10)]
    specs += [("e0", "fine", "d", DAY, -3, 30), ("e1", "fine", "d", DAY, None, 30)]
    specs += [(f"f{n}", None, "d", DAY, 5, 30) for n in range(10)]
    restaurants = raw_table(
        spark,
        "restaurants",
        {"restaurant_id": "slow", "city": "Pune", "onboarding_date": dt.date(2025, 12, 31)},
        {"restaurant_id": "idle", "city": "Delhi"},
    )
    timeline = delivered_orders(spark, *specs)
    mart = marts.restaurant_prep_delays(timeline, restaurants, dt.date(2026, 1, 31))
    columns = (
        "restaurant_id",
        "total_orders",
        "avg_prep_time_minutes",
        "median_prep_time_minutes",
        "p95_prep_time_minutes",
        "delayed_orders",
        "delay_rate_pct",
        "sla_breaches_from_prep",
        "risk_category",
    )
    assert rows_of(mart, *columns) == [
        ("fine", 10, 11.5, 10.0, 18.3, 1, 10.0, 0, "Low Risk"),
        ("mid", 10, 20.7, 18.0, 27.0, 3, 30.0, 0, "Medium Risk"),
        ("slow", 10, 25.5, 25.5, 29.6, 10, 100.0, 10, "High Risk"),
        (None, 10, 5.0, 5.0, 5.0, 0, 0.0, 0, "Low Risk"),
    ]
    slow = mart.where("restaurant_id = 'slow'").first()
    assert (slow.city, slow.days_since_onboarding) == ("Pune", 31)
    assert [row.restaurant_id for row in insights.riskiest_restaurants(mart).collect()] == [
        "slow",
        "mid",
    ]
    assert mart.where("restaurant_id = 'few'").count() == 0
    dim = core.dim_restaurants(restaurants, timeline)
    assert rows_of(dim, "restaurant_id", "total_orders", "avg_prep_time_minutes") == [
        ("idle", 0, None),
        ("slow", 10, 25.5),
    ]


def test_rider_mart(spark):
    days = [DAY + dt.timedelta(days=n) for n in range(5)]
    specs = [(f"a{n}", "r", "quick", days[n % 4], 5, 30) for n in range(20)]
    specs += [(f"b{n}", "r", "slow", days[n % 5], 5, 30 if n < 9 else 90) for n in range(10)]
    specs += [(f"c{n}", "r", "stray", days[n % 5], 5, 30) for n in range(10)]
    specs += [(f"d{n}", "r", "rookie", days[n % 5], 5, 30) for n in range(9)]
    specs += [(f"e{n}", "r", "twin1", days[n % 5], 5, 30) for n in range(10)]
    specs += [(f"f{n}", "r", "twin2", days[n % 5], 5, 30) for n in range(10)]
    riders = raw_table(
        spark,
        "riders",
        {"rider_id": "quick", "city": "Pune", "joining_date": dt.date(2026, 1, 1)},
        {"rider_id": "slow", "city": "Pune"},
        {"rider_id": "rookie", "city": "Pune"},
        {"rider_id": "twin1", "city": "Delhi"},
        {"rider_id": "twin2", "city": "Delhi"},
    )
    mart = marts.rider_performance(
        delivered_orders(spark, *specs),
        riders,
        as_of=dt.date(2026, 1, 31),
    )
    columns = (
        "rider_id",
        "city",
        "orders_per_day",
        "on_time_rate",
        "city_avg_orders_per_day",
        "efficiency_score",
        "city_rank",
        "overall_rank",
        "performance_tier",
    )
    assert rows_of(mart, *columns) == [
        ("quick", "Pune", 5.0, 1.0, 3.5, 1.429, 1, 1, "Star Performer"),
        ("slow", "Pune", 2.0, 0.9, 3.5, 0.514, 2, 4, "Meets Expectations"),
        ("stray", None, 2.0, 1.0, None, None, 1, 5, "Meets Expectations"),
        ("twin1", "Delhi", 2.0, 1.0, 2.0, 1.0, 1, 2, "Star Performer"),
        ("twin2", "Delhi", 2.0, 1.0, 2.0, 1.0, 2, 3, "Star Performer"),
    ]
    assert mart.where("rider_id = 'quick'").first().tenure_days == 30
    assert [row.rider_id for row in insights.star_riders(mart, 2).collect()] == ["quick", "twin1"]


def weekly_inputs(spark):
    first, third = DAY, DAY + dt.timedelta(days=14)  # no orders in the week between
    orders = [
        ("o1", first, "delivered", 100.0),
        ("o2", first, "delivered", 50.0),
        ("o3", first, "cancelled", 70.0),
        ("o4", third, "delivered", 300.0),
        ("o5", third, "in_progress", 40.0),
        ("o6", third + dt.timedelta(days=7), "cancelled", 10.0),
    ]
    rows = [
        {
            "order_id": o,
            "order_ts": dt.datetime.combine(day, dt.time(9)),
            "status": status,
            "order_value": value,
        }
        for o, day, status, value in orders
    ]
    refunds = raw_table(
        spark,
        "refunds",
        {"refund_id": "f1", "order_id": "o1", "refund_ts": at("2026-01-25 23:59:59"), "refund_amount": 30.0},
        {"refund_id": "f2", "order_id": "gone", "refund_ts": at("2026-01-19 00:00:00"), "refund_amount": 15.0},
        {"refund_id": "f3", "order_id": "o1", "refund_ts": at("2026-01-27 00:00:00"), "refund_amount": 99.0},
        {"refund_id": "f4", "order_id": "o1", "refund_ts": None, "refund_amount": 99.0},
    )
    return staged_orders(spark, *rows, {"order_id": "lost", "order_ts": None}), refunds


def test_weekly_trends(spark):
    mart = marts.weekly_trends(*weekly_inputs(spark))
    found = [tuple(row) for row in marts.report("weekly_trends", mart).collect()]
    monday = [DAY, DAY + dt.timedelta(days=14), DAY + dt.timedelta(days=21), None]
    sunday = [
        None if day is None else dt.datetime.combine(day, dt.time()) + dt.timedelta(days=6)
        for day in monday
    ]
    assert found == [
        (monday[0], sunday[0], 3, 2, 1, 150.0, 75.0, 2, 45.0, 33.33, 30.0, None, None, None, None, 1),
        (monday[1], sunday[1], 2, 1, 0, 300.0, 300.0, 0, 0.0, 0.0, 0.0, -50.0, -100.0, -100.0, 100.0, 2),
        (monday[2], sunday[2], 1, 0, 1, 0.0, None, 0, 0.0, 100.0, None, -100.0, None, None, -100.0, 3),
        (None, None, 1, 1, 0, 100.0, 100.0, 0, 0.0, 0.0, 0.0, None, -100.0, None, None, 4),
    ]
    latest = insights.latest_weeks(mart, 2).collect()
    assert [row.week for row in latest] == [monday[2], monday[1]]


def test_raw_insights(spark):
    orders = staged_orders(
        spark,
        {"order_id": "o1", "city": "A", "restaurant_id": "r2"},
        {"order_id": "o2", "city": "A", "restaurant_id": "r1"},
        {"order_id": "o3", "city": "B", "status": "cancelled"},
        {"order_id": "o4", "city": "C", "promised_delivery_ts": None},
    )
    log = events(
        spark,
        ("o1", "delivered", "2026-01-19 13:00:00", "d1"),
        ("o1", "delivered", "2026-01-19 12:30:00", "d2"),
        ("o3", "delivered", "2026-01-19 13:00:00", "d1"),
        ("o4", "delivered", "2026-01-19 13:00:00", None),
    )
    assert rows_of(insights.raw_sla_slots(orders, log)) == [
        ("A", "lunch", 3, 33.33),
        ("C", "lunch", 1, 0.0),
    ]
    assert [tuple(r) for r in insights.raw_busiest_riders(log).collect()] == [
        ("d1", 2),
        ("d2", 1),
        (None, 1),
    ]
    assert [tuple(r) for r in insights.raw_busiest_restaurants(orders).collect()] == [
        ("r1", 2),
        ("r2", 1),
    ]
    assert [tuple(r) for r in insights.raw_latest_weeks(orders).collect()] == [(DAY, 4, 400.0)]


def test_dim_date(spark):
    bounds = core.date_range(spark, dt.date(2025, 12, 28), dt.date(2026, 1, 5))
    days = core.dim_date(bounds).orderBy("date_day").collect()
    assert len(days) == 9
    assert tuple(days[0]) == (
        dt.date(2025, 12, 28), 2025, 12, 28, 0, 52, True, "Sunday",
        dt.date(2025, 12, 22), dt.date(2025, 12, 1),
    )
    # Calendar year next to ISO week.
    assert (days[1].year, days[1].iso_week) == (2025, 1)
    assert core.dim_date(core.order_date_range(staged_orders(spark))).count() == 0
    orders = staged_orders(spark, {"order_id": "o1"}, {"order_id": "o2", "order_ts": at("2026-01-21")})
    assert core.dim_date(core.order_date_range(orders)).count() == 3


def test_refund_split_order(spark):
    mart = table(
        spark,
        "refund_driver_category string, refund_count long, refund_count_pct double,"
        " refund_amount double, avg_refund_amount double",
        ("Delay", 1, 25.0, 1.0, 1.0),
        ("Other", 2, 50.0, 1.0, 1.0),
        ("Cancellation", 1, 25.0, 1.0, 1.0),
    )
    assert [row[0] for row in insights.refund_split(mart).collect()] == [
        "Other",
        "Cancellation",
        "Delay",
    ]


def test_expectations_join_events_once(spark, folder, monkeypatch):
    """The dimension is made from the stored fact."""
    from parity.queries import queries
    from parity.views import TEST_TABLES, Views

    day, n = at("1996-05-01"), 60
    rows = {
        "nation": [(0, "PERU", 0)],
        "customer": [(1, "c", 0, 5.0, "FOOD")],
        "supplier": [(i, "s", 0, 1.0) for i in range(3)],
        "orders": [(i, 1, "F", 8.0, day, "HIGH") for i in range(n)],
        "lineitem": [(i, 22 + k, 1, k, 5.0, 8.0, 0.02, 0.01, "R", "O", day) for i in range(n) for k in range(1, 8)],
        "conversations": [(1, 0, "user", "a"), (1, 1, "user", "b")],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, TEST_TABLES[name]).write.parquet(f"{folder}/{name}.parquet")
    asked, timeline = [], Views.timeline
    monkeypatch.setattr(Views, "timeline", lambda self: asked.append(1) or timeline(self))
    found = {(r.table_name, r.check): r.violations for r in queries()["expectations"](spark, folder).collect()}
    assert len(asked) == 1
    assert len(found) == 18 and {check for check, off in found.items() if off} == {("stg_support_tickets", "unique ticket_id")}
