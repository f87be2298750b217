import datetime as dt

import pytest
from pyspark.sql import functions as F

from courierlake import functions as fn
from courierlake.functions import temporal
from courierlake.session import setting
from courierlake.sources import lake
from helpers import at, rows_of, table


@pytest.mark.parametrize(
    ("start", "end", "minutes"),
    [
        ("2026-01-15 10:00:00", "2026-01-15 10:20:30", 20.5),
        ("2026-01-15 10:00:00", "2026-01-15 09:59:00", -1.0),
        ("2026-01-15 10:00:00.000001", "2026-01-15 10:00:00.000004", 3 / 60e6),
        # The session zone skips this hour; zone-less times do not.
        ("2026-03-08 01:30:00", "2026-03-08 03:30:00", 120.0),
        ("2026-03-08 01:30:00", "2026-03-08 02:15:00", 45.0),
        ("1926-01-15 10:00:00", "2026-01-15 10:00:00.5", 36525 * 1440 + 0.5 / 60),
    ],
)
def test_minutes_between(spark, start, end, minutes):
    df = table(spark, "a timestamp_ntz, b timestamp_ntz", (at(start), at(end)))
    assert df.select(fn.minutes_between("a", "b")).first()[0] == pytest.approx(minutes, rel=1e-12)


def test_minutes_between_null(spark):
    df = table(spark, "a timestamp_ntz, b timestamp_ntz", (None, at("2026-01-15")))
    assert df.select(fn.minutes_between("a", "b")).first()[0] is None


def test_time_slot_edges(spark):
    expected = {
        0: "late_night",
        7: "late_night",
        8: "morning",
        11: "morning",
        12: "lunch",
        15: "lunch",
        16: "evening",
        19: "evening",
        20: "dinner",
        23: "dinner",
        None: "late_night",
    }
    df = table(spark, "h int", *((hour,) for hour in expected))
    assert dict(df.select("h", fn.time_slot("h")).collect()) == expected


def test_slot_lookup_agrees_with_expression(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("order_hour"))
    labelled = lake.label_time_slots(hours)
    assert labelled.count() == 24
    assert labelled.where(F.col("slot") != fn.time_slot("order_hour")).count() == 0


def test_null_hour_is_late_night(spark):
    hours = table(spark, "order_hour int", (None,), (9,))
    assert sorted(lake.label_time_slots(hours).select("slot", "label").collect()) == [
        ("late_night", "Late Night (12AM-7AM)"),
        ("morning", "Morning (8AM-11AM)"),
    ]


def test_now_follows_the_data_not_the_session(spark):
    """With the session far west, an order placed just now in India lies not in the future."""
    now = dt.datetime.now(dt.timezone.utc)
    ist = (now + dt.timedelta(hours=5, minutes=30)).replace(tzinfo=None)
    with setting(spark, "spark.sql.session.timeZone", "UTC"):
        row = spark.range(1).select(
            temporal.as_of_timestamp(None).alias("here"), temporal.now_in("UTC").alias("utc")
        ).first()
    assert abs((row.here - ist).total_seconds()) < 120
    assert abs((row.utc - now.replace(tzinfo=None)).total_seconds()) < 120


def test_weeks_and_months(spark):
    df = table(spark, "d date", (dt.date(2026, 3, 1),), (dt.date(2026, 3, 2),), (None,))
    result = df.select(
        fn.week_start("d"), fn.week_end(fn.week_start("d")), fn.month_start("d"), fn.day_name("d")
    ).collect()
    assert tuple(result[0]) == (
        dt.date(2026, 2, 23),
        dt.datetime(2026, 3, 1),
        dt.date(2026, 3, 1),
        "Sunday",
    )
    assert result[1][0] == dt.date(2026, 3, 2)
    assert tuple(result[2]) == (None, None, None, None)


def test_ratios_guard_zero(spark):
    df = table(spark, "a long, b long", (1, 3), (1, 0), (None, 3))
    shares = rows_of(df.select(F.round(fn.percent_of(F.col("a"), F.col("b")), 2)))
    assert shares == [(33.33,), (None,), (None,)]
    changes = df.select(fn.percent_change(F.col("a"), F.col("b"))).collect()
    assert [row[0] for row in changes] == [-66.67, None, None]


def test_mean_of_rounded_ignores_null(spark):
    df = table(spark, "x double", (0.1,), (0.2,), (None,), (0.3,))
    assert df.select(fn.mean_of_rounded(F.col("x"), 1)).first()[0] == 0.6 / 3
    assert df.where("x > 9").select(fn.mean_of_rounded(F.col("x"), 1)).first()[0] is None


def test_days_between(spark):
    df = table(spark, "d date", (dt.date(2026, 1, 1),), (None,))
    days = df.select(fn.days_between("d", fn.as_of_date(dt.date(2026, 3, 1)))).collect()
    assert [row[0] for row in days] == [59, None]
