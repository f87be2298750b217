"""Operators whose results are stored and merged, and joins by bins and by weight."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from courierlake.operators import bands, bitmaps, heaviest, sketches
from courierlake.plans import incremental, marts
from courierlake.plans.timeline import delivery_timeline, rider_daily
from courierlake.sources import lake
from courierlake.streaming import events as stream
from helpers import at, plan_of, raw_table, rows_of, staged_orders, table


def test_merged_sketches_stay_within_the_bound(spark):
    rng = np.random.default_rng(3)
    values = {"big": rng.lognormal(10, 2, 60_000).astype(int), "ties": rng.integers(0, 3, 9_000), "one": np.array([7])}
    rows = [(k, i % 9, int(v)) for k, vs in values.items() for i, v in enumerate(vs)] + [("big", 1, None)]
    df = spark.createDataFrame(rows, "k string, batch int, v bigint").repartition(6)
    daily = sketches.summaries(df, ["k", "batch"], "v")
    found = sketches.approximate_percentiles(sketches.merged(daily, ["k"]), ["k"], {"mid": 0.5, "p95": 0.95})
    assert rows_of(found, "k", "n") == [("big", 60_000), ("one", 1), ("ties", 9_000)]
    counted = df.where("v IS NOT NULL").groupBy("k", "v").agg(F.count("*").alias("n_v"))
    errors = sketches.rank_errors(found, counted, "k", "v", "n_v", {"mid": 0.5, "p95": 0.95}).collect()
    assert len(errors) == 3
    for row in errors:
        assert max(row.mid_rank_error, row.p95_rank_error) <= sketches.RANK_ERROR
    exact = found.where("k = 'one'").first()
    assert (exact.mid, exact.p95) == (7, 7)


def test_days_count_once_over_batches(spark):
    day = dt.date(2026, 1, 1)
    rows = [(f"r{i % 5}", i % 3, day + dt.timedelta(days=int(i * i % 40))) for i in range(300)]
    rows += [("old", 0, dt.date(1901, 1, 1)), ("old", 1, dt.date(2100, 1, 1)), ("none", 0, None), (None, 0, day)]
    df = spark.createDataFrame(rows, "rider_id string, batch int, day date")
    parts = [bitmaps.day_sets(df.where(F.col("batch") == b), ["rider_id"], "day") for b in (0, 1, 2, 0)]
    sets = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    counted = bitmaps.count_days(bitmaps.merged(sets, ["rider_id"]), ["rider_id"])
    expected = df.groupBy("rider_id").agg(F.count_distinct("day").alias("days"))
    assert rows_of(counted) == rows_of(expected)


def test_band_join(spark):
    values = table(spark, "id int, v double", (1, 5.0), (2, 10.0), (3, None), (4, 99.0), (5, -3.0), (6, 7.5))
    spans = table(
        spark, "name string, lo double, hi double", ("a", 0.0, 10.0), ("b", 7.5, 40.0), ("c", -9.0, -3.0), ("d", 9.0, 8.0), ("e", None, 8.0)
    )
    for width in (0.5, 4, 100):
        joined = bands.join_bands(values, "v", spans, "lo", "hi", width)
        assert rows_of(joined, "id", "name") == sorted(
            [(1, "a"), (2, "a"), (2, "b"), (3, None), (4, None), (5, "c"), (6, "a"), (6, "b")], key=str
        )
        assert "NestedLoop" not in plan_of(joined) and "Cartesian" not in plan_of(joined)


def test_slot_labels_follow_the_seed(spark):
    orders = table(spark, "order_id string, order_hour int", *((str(h), h) for h in range(24)), ("none", None))
    slots = lake.time_slots(spark)
    same = {r.order_id: (r.slot, r.label) for r in lake.label_hours(orders, slots).collect()}
    assert same == {r.order_id: (r.slot, r.label) for r in lake.label_time_slots(orders).collect()}
    moved = slots.withColumn("end_hour", F.when(F.col("time_slot") == "lunch", 13).otherwise(F.col("end_hour")))
    changed = {r.order_id: r.slot for r in lake.label_hours(orders, moved).collect()}
    assert {h for h in changed if changed[h] != same[h][0]} == {"14", "15"}
    assert changed["14"] == "late_night"


def test_heaviest_choice(spark):
    rows = [("r1", "B"), ("r1", "A"), ("r1", "B"), ("r2", "B"), ("r2", "A"), ("r3", None), (None, "A")]
    df = table(spark, "rider string, city string", *rows)
    found = heaviest.heaviest_choice(df, ["rider"], "city", name="orders")
    assert rows_of(found) == [("r1", "B", 2, 3, 2), ("r2", "A", 1, 2, 2)]
    weighted = heaviest.heaviest_choice(df.withColumn("w", F.lit(2.5)), ["rider"], "city", F.col("w"), "w")
    assert rows_of(weighted, "rider", "w", "total_w") == [("r1", 5.0, 7.5), ("r2", 2.5, 5.0)]


def test_readers_see_the_old_or_the_new_version(spark, folder, database, monkeypatch):
    name, root = f"{database}.figures", f"{folder}/versions"
    rows = lambda n: spark.range(n).withColumn("day", F.lit(dt.date(2026, 1, 1)))
    for partition_by in (None, "day"):
        name = f"{database}.figures_{partition_by}"
        first, _ = lake.publish_version(rows(3), name, root, partition_by)
        reader = spark.table(name)
        switch = lake.switch

        def between(*args, **kwargs):
            # The new version is complete, the name still stands for the old one.
            assert spark.table(name).count() == 3
            raise RuntimeError("lost before the switch")

        monkeypatch.setattr(lake, "switch", between)
        with pytest.raises(RuntimeError):
            lake.publish_version(rows(5), name, root, partition_by)
        assert spark.table(name).count() == 3
        monkeypatch.setattr(lake, "switch", switch)
        path, written = lake.publish_version(rows(7), name, root, partition_by)
        assert written == 7 and spark.table(name).count() == 7
        assert reader.count() == 3  # a query planned before goes on with the old files
        found = lake.versions(spark, name, root)
        assert len(found) == 3 and any(f.endswith(path.rsplit("/", 1)[-1]) for f in found)
        if partition_by:
            assert "PartitionFilters: [isnotnull" in plan_of(spark.table(name).where("day = DATE'2026-01-02'"))


def bronze(spark, stamp, *rows):
    df = raw_table(
        spark,
        "delivery_events",
        *({"order_id": o, "event_type": kind, "event_ts": at(ts), "rider_id": rider} for o, kind, ts, rider in rows),
    )
    return df.withColumns({"_source_file": F.lit("f"), "_ingested_at": F.lit(at(stamp)), "_batch_id": F.lit(stamp)})


def test_marts_follow_late_events_by_touched_days(spark, folder):
    orders = staged_orders(
        spark,
        *(
            {"order_id": f"o{i}", "restaurant_id": f"r{i % 2}", "order_ts": at(f"2026-01-{10 + i % 4} 12:00:00"), "promised_delivery_ts": at(f"2026-01-{10 + i % 4} 12:40:00")}
            for i in range(60)
        ),
    )
    path = f"{folder}/orders"
    lake.write(orders, path, "order_date")
    orders = lake.read(spark, path).select(*orders.columns)
    steps = [("restaurant_accepted", "12:05:00"), ("food_ready", "12:2{}:00"), ("rider_picked_up", "12:30:00"), ("delivered", "12:4{}:00")]
    log = [
        (f"o{i}", kind, f"2026-01-{10 + i % 4} " + ts.format(i % 7), f"d{i % 3}" if kind == "delivered" else None)
        for i in range(60)
        for kind, ts in steps
    ]
    first = bronze(spark, "2026-01-20", *(r for r in log if r[0] not in ("o5", "o9")))
    # New events of two orders, a correction, and an event of an order nobody knows.
    late = bronze(
        spark, "2026-01-21", *(r for r in log if r[0] in ("o5", "o9")), ("o1", "delivered", "2026-01-11 15:00:00", "d9"), ("who", "delivered", "2026-01-11 15:00:00", None)
    )
    store, figures = stream.EventStore(f"{folder}/events"), f"{folder}/figures"
    incremental.apply_arrivals(first, orders, store, figures, "first")
    for _ in range(2):
        days = incremental.apply_arrivals(late, orders, store, figures, "late")
        assert [str(d) for d in days] == ["2026-01-11"]
    plan = plan_of(incremental.day_timeline(orders, store, days))
    assert plan.count("PartitionFilters: [") >= 2 and "PartitionFilters: []" not in plan

    whole = delivery_timeline(orders, stream.silver_events(spark, orders, store))
    restaurants = raw_table(spark, "restaurants", {"restaurant_id": "r0", "city": "PUNE"})
    riders = raw_table(spark, "riders", {"rider_id": "d1", "city": "PUNE"})
    as_of = dt.date(2026, 2, 1)
    found = incremental.marts_of_figures(spark, figures, restaurants, riders, as_of)
    expected = {
        "mart_sla_breach_analysis": marts.sla_breach_analysis(whole),
        "mart_rider_performance": marts.rider_performance(whole, riders, as_of),
        "mart_restaurant_prep_delays": marts.restaurant_prep_delays(whole, restaurants, as_of),
    }
    for name, mart in expected.items():
        rows = rows_of(mart)
        assert rows and rows_of(found[name].select(*mart.columns)) == rows
    assert rows_of(incremental.figures(spark, figures, "riders", days).select(*rider_daily(whole).columns)) == rows_of(
        rider_daily(whole).where(F.col("order_date").isin(days))
    )
