import datetime as dt
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from courierlake.operators import joins, late, ranking, sequence
from courierlake.operators.latest import latest_rows
from courierlake.operators.percentiles import grouped_percentiles
from courierlake.plans.silver import silver_events
from courierlake.session import setting
from courierlake.sources import lake
from helpers import at, events, plan_of, rows_of, staged_orders, table

LOG = "k string, v int, _ingested_at timestamp_ntz, _batch_id string"


def test_latest_rows_order(spark):
    early, later = at("2026-01-01"), at("2026-01-02")
    df = table(
        spark,
        LOG,
        ("a", 9, early, "b2"),
        ("a", 1, later, "b1"),
        ("b", 1, early, "b1"),
        ("b", 2, early, "b2"),
        ("c", 1, early, "b1"),  # tie up to the value
        ("c", 3, early, "b1"),
        ("c", None, early, "b1"),
        (None, 1, early, "b1"),
        (None, 2, None, "b3"),
    )
    expected = [("a", 1), ("b", 2), ("c", 3), (None, 1)]
    for parts in (1, 5):
        assert rows_of(latest_rows(df.repartition(parts), ["k"]), "k", "v") == expected


def test_latest_rows_limits_before_shuffle(spark):
    plan = plan_of(latest_rows(table(spark, LOG).repartition(3), ["k"]))
    assert plan.index("Exchange hashpartitioning(k") < plan.rindex("WindowGroupLimit")


def test_left_join_many_equals_left_join(spark):
    left = table(spark, "k string, x int", ("a", 1), ("b", 2), ("c", 3), (None, 4))
    right = table(spark, "k string, y int", ("a", 1), ("a", 2), ("a", None), ("z", 5), (None, 6))
    joined = joins.left_join_many(left, right, "k")
    assert rows_of(joined) == rows_of(left.join(right, "k", "left"))


def test_left_join_many_splits_hot_key(spark):
    """A key with nearly all rows of the right side runs in several tasks."""
    left = spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    right = spark.range(400_000).select(
        F.when(F.col("id") % 50 == 0, F.col("id") % 2000).otherwise(7).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("y"),
    )
    joined = joins.left_join_many(left, right.repartition(8), "k")
    with (
        setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"),
        setting(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"),
        setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1MB"),
        setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB"),
    ):
        result = joined.agg(F.count("*"), F.count("y"))
        # 40 keys besides the hot one have matches.
        assert tuple(result.collect()[0]) == (400_000 + 2000 - 41, 400_000)
        assert "skew=true" in plan_of(result)


def test_orphans(spark):
    log = events(spark, ("o1", "delivered", None), ("zz", "delivered", None), (None, "x", None))
    orders = table(spark, "order_id string", ("o1",), ("o1",), (None,))
    flagged = joins.flag_orphans(log, orders)
    assert rows_of(flagged, "order_id", "_dq_orphan_order") == [
        ("o1", False),
        ("zz", True),
        (None, None),
    ]
    assert rows_of(joins.flag_orphans(log, None), "_dq_orphan_order") == [(False,)] * 3
    assert rows_of(joins.orphan_events(log, orders), "order_id") == [("zz",)]


@pytest.mark.parametrize("unit", [1, 1_000_000, 60_000_000, 999_983])
def test_percentiles_match_numpy(spark, unit):
    rng = np.random.default_rng(7)
    groups = {
        "one": [5],
        "two": [1, 4],
        "ties": [3] * 11 + [9] * 2,
        "many": rng.integers(1, 5000, 1501).tolist(),
        None: [2, 2, 8, 10],
    }
    counts = (
        table(spark, "g string, v long", *((g, v * unit) for g, vs in groups.items() for v in vs))
        .groupBy("g", "v")
        .agg(F.count("*").alias("n"))
    )
    result = grouped_percentiles(counts, "g", "v", "n", {"mid": "0.5", "p95": "0.95", "top": "1"})
    found = {row.g: row for row in result.collect()}
    assert found.keys() == groups.keys()
    for group, values in groups.items():
        assert found[group].mid == median(values) * unit
        expected = np.percentile(values, 95) * unit
        assert found[group].p95 == pytest.approx(expected, rel=1e-9)
        assert found[group].top == max(values) * unit


def test_percentile_is_exact_at_rounding_edge(spark):
    """25 + 0.85 * 3 is 27.55, which rounds to 27.6."""
    minute = 60_000_000
    counts = table(
        spark,
        "g string, v long, n long",
        ("a", 20 * minute, 21),
        ("a", 25 * minute, 1),
        ("a", 28 * minute, 2),
    )
    p95 = grouped_percentiles(counts, "g", "v", "n", {"p": "0.95"}).first().p
    assert p95 / 60e6 == 27.55


def test_row_numbers(spark):
    """A third of the rows share group and score; only the id tells them apart."""
    rows = [
        ("hot" if i % 3 == 0 else f"g{i % 7}" if i % 11 else None, 0.0 if i % 3 == 0 else i % 50, i)
        for i in range(3000)
    ]
    df = table(spark, "city string, score double, id long", *((c, float(s), i) for c, s, i in rows))
    order = [F.col("score").desc_nulls_last(), F.col("id").asc()]
    ranked = ranking.add_row_numbers(
        df.repartition(7), {"in_city": (["city"], order), "overall": ([], order)}
    )
    ordered = sorted(rows, key=lambda row: (-row[1], row[2]))
    overall = {row[2]: place for place, row in enumerate(ordered, 1)}
    seen, in_city = {}, {}
    for city, _, id_ in ordered:
        seen[city] = in_city[id_] = seen.get(city, 0) + 1
    found = ranked.collect()
    assert len(found) == 3000
    assert {row.id: row.overall for row in found} == overall
    assert {row.id: row.in_city for row in found} == in_city


def test_range_sorted_ranking_has_no_window_over_rows(spark):
    df = table(spark, "city string, score double", *(("a", float(i)) for i in range(50)))
    ranked = ranking.add_row_numbers(df, {"place": ([], [F.col("score").desc()])})
    window = [line for line in plan_of(ranked).splitlines() if "Window [" in line]
    assert len(window) == 1 and "_part" in window[0]  # one row per partition


def test_invalid_sequence(spark):
    log = events(
        spark,
        ("o1", "order_confirmed", "2026-01-15 10:00:00"),
        ("o1", "food_ready", "2026-01-15 10:05:00"),
        ("o1", "restaurant_accepted", "2026-01-15 10:06:00"),
        ("o1", "delivered", "2026-01-15 10:30:00"),
        ("o1", "teleported", "2026-01-15 10:31:00"),
        ("o1", "cancelled", "2026-01-15 10:32:00"),
        ("o2", "delivered", "2026-01-15 10:00:00"),
        ("o2", "rider_assigned", None),
    )
    flagged = sequence.flag_invalid_sequence(log).where("_dq_invalid_sequence")
    assert rows_of(flagged, "order_id", "event_type") == [
        ("o1", "restaurant_accepted"),
        ("o2", "rider_assigned"),
    ]
    assert sequence.flag_invalid_sequence(log).where("_dq_invalid_sequence is null").count() == 0


def test_partial_weeks(spark):
    monday = at("2026-01-19 10:00:00")
    days = [monday + dt.timedelta(days=n) for n in (*range(7), 7, 7, 9)]
    orders = staged_orders(
        spark, *({"order_id": str(n), "order_ts": day} for n, day in enumerate(days))
    )
    assert rows_of(sequence.flag_partial_weeks(orders)) == [
        (dt.date(2026, 1, 19), 7, False),
        (dt.date(2026, 1, 26), 2, True),
    ]


def test_reprocess_loses_no_arrival_and_rewrites_touched_days_only(spark, database):
    def batch(name, *rows):
        return events(spark, *rows).withColumns(
            {"_ingested_at": F.lit(at(name)), "_batch_id": F.lit(name)}
        )

    stored = batch(
        "2026-01-17",
        ("old", "delivered", "2026-01-09 10:00:00"),
        ("edge", "delivered", "2026-01-10 10:00:00"),
        ("timeless", "delivered", None),
        ("still", "delivered", None),
        ("o1", "delivered", "2026-01-16 10:00:00"),
        ("o2", "delivered", "2026-01-17 10:00:00"),
    )
    table_name = f"{database}.events"
    lake.save_table(late.with_event_date(stored), table_name, partition_by=late.DAY)
    untouched = {f for f in spark.table(table_name).inputFiles() if "2026-01-09" in f}

    arrived = batch(
        "2026-01-18",
        ("o1", "delivered", "2026-01-17 09:00:00"),  # corrected: leaves the 16th empty
        ("o3", "delivered", "2026-01-17 11:00:00"),
        ("late", "delivered", "2026-01-08 11:00:00"),  # older than the window
        ("edge", "delivered", "2026-01-17 12:00:00"),  # moves into the window, empties the 10th
        ("lost", "delivered", None),
        ("timeless", "delivered", "2026-01-17 13:00:00"),
    )
    for _ in range(2):  # repeating a run changes nothing
        late.reprocess_recent(table_name, arrived, at("2026-01-18 00:00:00"))
        assert rows_of(spark.table(table_name), "order_id", "event_date") == [
            ("edge", dt.date(2026, 1, 17)),
            ("late", dt.date(2026, 1, 8)),
            ("lost", None),
            ("o1", dt.date(2026, 1, 17)),
            ("o2", dt.date(2026, 1, 17)),
            ("o3", dt.date(2026, 1, 17)),
            ("old", dt.date(2026, 1, 9)),
            ("still", None),
            ("timeless", dt.date(2026, 1, 17)),
        ]
    assert untouched == {f for f in spark.table(table_name).inputFiles() if "2026-01-09" in f}


def test_a_day_without_time_left_is_dropped(spark, database):
    stored = events(spark, ("a", "delivered", None)).withColumns(
        {"_ingested_at": F.lit(at("2026-01-17")), "_batch_id": F.lit("1")}
    )
    name = f"{database}.timeless"
    lake.save_table(late.with_event_date(stored), name, partition_by=late.DAY)
    arrived = events(spark, ("a", "delivered", "2026-01-17 13:00:00")).withColumns(
        {"_ingested_at": F.lit(at("2026-01-18")), "_batch_id": F.lit("2")}
    )
    late.reprocess_recent(name, arrived, at("2026-01-18 00:00:00"))
    assert rows_of(spark.table(name), "order_id", "event_date") == [("a", dt.date(2026, 1, 17))]
    assert late.merge_late_events(
        late.with_event_date(stored), late.with_event_date(arrived)
    ).count() == 1
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_event_copies_are_dropped_before_the_first_shuffle(spark):
    log = events(spark, ("o1", "delivered", None)).repartition(3)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = plan_of(silver_events(log, table(spark, "order_id string", ("o1",))))
    limit = plan.rindex("WindowGroupLimit")
    assert plan.index("Exchange hashpartitioning(order_id#") < limit
    assert "Partial" in plan[limit:]
