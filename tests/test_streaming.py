"""Runs over raw files that keep arriving."""

import json
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from courierlake.plans import silver
from courierlake.plans.staging import staged
from courierlake.plans.timeline import delivery_timeline
from courierlake.sources.schemas import CORRUPT, RAW_TABLES
from courierlake.streaming import days, events, ingest, live
from helpers import at, plan_of, raw_table, rows_of, staged_orders
from helpers import events as event_table

EVENTS = RAW_TABLES["delivery_events"]
CONTENT = EVENTS.schema.names
FLAGS = ("_dq_orphan_order", "_dq_invalid_event_type", "_dq_missing_rider")


def event(order, kind, ts, rider=None, latitude=1.0):
    return {
        "order_id": order,
        "rider_id": rider,
        "event_type": kind,
        "event_ts": ts,
        "latitude": latitude,
        "longitude": 2.0,
    }


def deliver(raw_path, name, rows, table=EVENTS):
    """A finished raw file."""
    Path(raw_path, table.file).mkdir(parents=True, exist_ok=True)
    lines = rows if isinstance(rows, str) else "\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows)
    Path(raw_path, table.file, name).write_text(lines)


def test_only_new_files_are_read(spark, folder):
    raw_path, bronze, log = f"{folder}/raw", f"{folder}/bronze", f"{folder}/log"
    header = "order_id,item_id,quantity,item_price,cuisine_type\n"
    items = RAW_TABLES["order_items"]
    deliver(raw_path, "a.csv", header + "o1,i1,1,2.5,thai\no2,i1,many,2.5,thai\n", items)
    run = lambda: ingest.ingest_new_files(spark, items, raw_path, bronze, log)
    assert run() == 2
    assert run() == 0
    deliver(raw_path, "b.csv", header + "o3,i1,1,2.5,thai\n", items)
    assert run() == 1
    rows = ingest.read_bronze(spark, f"{bronze}/order_items", items)
    assert rows_of(rows, "order_id", CORRUPT, "_batch_id", "batch") == [
        ("o1", None, "stream_000000000000", 0),
        ("o2", "o2,i1,many,2.5,thai", "stream_000000000000", 0),
        ("o3", None, "stream_000000000001", 1),
    ]
    assert all(r._source_file.endswith(("a.csv", "b.csv")) and r._ingested_at for r in rows.collect())
    assert ingest.read_bronze(spark, f"{bronze}/order_items", items, after_batch=0).count() == 1


def test_a_batch_that_fails_after_its_write_is_not_doubled(spark, folder, monkeypatch):
    raw_path, bronze, log = f"{folder}/raw", f"{folder}/bronze", f"{folder}/log"
    run = lambda: ingest.ingest_new_files(spark, EVENTS, raw_path, bronze, log)
    deliver(raw_path, "a.json", [event("o1", "delivered", "2026-01-15T10:00:00")])
    run()
    deliver(raw_path, "b.json", [event("o2", "delivered", "2026-01-15T10:00:00"), "{broken"])
    land = ingest.land

    def failing(rows, number, path):
        land(rows, number, path)
        raise RuntimeError("lost between write and commit")

    monkeypatch.setattr(ingest, "land", failing)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.setattr(ingest, "land", land)
    stored = lambda: ingest.read_bronze(spark, f"{bronze}/delivery_events", EVENTS)
    assert stored().count() == 3
    assert run() == 2
    assert rows_of(stored(), "order_id", "batch") == [("o1", 0), ("o2", 1), (None, 1)]
    assert run() == 0 and stored().count() == 3


def orders_with_days(spark):
    return raw_table(
        spark,
        "orders",
        *({"order_id": f"o{i}", "order_ts": at(f"2026-01-{10 + i} 09:00:00")} for i in range(1, 7)),
        {"order_id": "timeless", "order_ts": None},
        {"order_id": None, "order_ts": at("2026-01-11 09:00:00")},
    )


ARRIVALS = [
    [event("o1", "delivered", "2026-01-11T10:00:00", "r1"), event("o2", "picked", "2026-01-12T09:10:00")],
    [
        event("o6", "delivered", "2026-01-16T09:40:00"),
        event("o6", "delivered", "2026-01-16T09:40:00"),
        event("lost", "delivered", "2026-01-16T09:40:00"),
        event(None, "delivered", "2026-01-16T09:40:00"),
        event("timeless", "cancelled", None),
        "not json",
    ],
    # Behind the watermark: a new version of an old event, and a new event.
    [event("o1", "delivered", "2026-01-11T11:00:00", "r2"), event("o3", "delivered", "2026-01-13T09:30:00"), event("o5", "delivered", "2026-01-15T09:30:00")],
    [event("o6", "delivered", "2026-01-16T09:41:00", "r9"), event("lost", "delivered", "2026-01-16T09:50:00"), event(None, "delivered", "2026-01-10T00:00:00")],
]


def test_streamed_events_equal_the_batch_and_survive_restarts(spark, folder):
    raw_path, bronze, log = f"{folder}/raw", f"{folder}/bronze", f"{folder}/log"
    orders, store = orders_with_days(spark), events.EventStore(f"{folder}/events")
    for i, rows in enumerate(ARRIVALS):
        deliver(raw_path, f"{i}.json", rows)
        ingest.ingest_new_files(spark, EVENTS, raw_path, bronze, log)
        touched = events.stream_events(spark, bronze, orders, store, f"{folder}/events-log")
        if i == 3:
            assert [str(d) for d in touched] == ["2026-01-16"]
    # A stream that starts again has nothing left to do.
    assert events.stream_events(spark, bronze, orders, store, f"{folder}/events-log") == []

    stored = ingest.read_bronze(spark, f"{bronze}/delivery_events", EVENTS)
    expected = silver.silver_events(stored.drop("batch"), orders)
    current = lambda: rows_of(events.silver_events(spark, orders, store), *CONTENT, *FLAGS)
    before = {r[0] for r in current()}
    assert "o3" not in before and "o5" in before  # o3 came behind the watermark
    late = events.sweep_late(spark, stored, orders, store)
    assert {str(d) for d in late} == {"2026-01-11", "2026-01-13"}
    assert current() == rows_of(expected, *CONTENT, *FLAGS)
    events.sweep_late(spark, stored, orders, store)
    assert current() == rows_of(expected, *CONTENT, *FLAGS)


def test_events_that_come_before_their_order(spark, folder):
    store, orders = events.EventStore(f"{folder}/events"), orders_with_days(spark)
    rows = raw_table(spark, "delivery_events", {"order_id": "o1", "event_type": "delivered", "event_ts": at("2026-01-11 10:00:00")})
    rows = rows.withColumns({"_source_file": F.lit("f"), "_ingested_at": F.lit(at("2026-01-12 00:00:00")), "_batch_id": F.lit("b")})
    events.merge(spark, rows, orders.where("order_id = 'o2'"), store, "first")
    flags = lambda known: rows_of(events.silver_events(spark, known, store), "order_id", "_dq_orphan_order")
    assert flags(orders.where("order_id = 'o2'")) == [("o1", True)]
    assert [str(d) for d in events.settle_orphans(spark, orders, store)] == ["2026-01-11"]
    assert flags(orders) == [("o1", False)]


def test_replacing_days_reads_and_writes_only_those(spark, folder):
    rows = spark.createDataFrame([(i, at(f"2026-01-{10 + i % 5} 00:00:00").date()) for i in range(50)], "n int, day date")
    path = f"{folder}/days"
    days.replace_days(rows, path, "day", [])
    wanted = [at("2026-01-11 00:00:00").date(), at("2026-01-12 00:00:00").date(), None]
    some = days.read_days(spark, path, rows.schema, "day", wanted)
    assert "PartitionFilters: [" in plan_of(some) and "PartitionFilters: []" not in plan_of(some)
    untouched = {p: p.stat().st_mtime_ns for p in Path(path).glob("day=2026-01-1[034]/*.parquet")}
    # One day loses all its rows, the other keeps one.
    days.replace_days(some.where("n = 2").union(spark.createDataFrame([(99, None)], "n int, day date")), path, "day", wanted)
    found = days.read_days(spark, path, rows.schema, "day")
    assert rows_of(found.where("n in (1, 2, 6, 7, 99)"), "n") == [(2,), (99,)]
    assert found.count() == 32
    assert {p: p.stat().st_mtime_ns for p in untouched} == untouched


def test_live_timeline_of_closed_orders(spark, folder):
    schema = staged_orders(spark, {"order_id": "o"}).schema
    drops = [
        (
            [("o1", "2026-01-15 10:00:00"), ("o2", "2026-01-15 11:00:00")],
            [("o1", "restaurant_accepted", "2026-01-15 10:05:00"), ("o1", "food_ready", "2026-01-15 10:25:00")],
        ),
        (
            [("o3", "2026-01-16 10:00:00")],
            [("o1", "delivered", "2026-01-15 10:50:00", "r1"), ("o3", "delivered", "2026-01-16 10:30:00", "r2")],
        ),
        ([("late", "2026-02-20 10:00:00")], [("late", "delivered", "2026-02-20 11:00:00")]),
        ([("later", "2026-03-20 10:00:00")], [("later", "delivered", "2026-03-20 11:00:00")]),
    ]
    for name in ("orders", "happened"):
        Path(folder, name).mkdir()
    orders = spark.readStream.schema(schema).parquet(f"{folder}/orders")
    happened = spark.readStream.schema(EVENTS.schema).parquet(f"{folder}/happened")
    all_orders, all_events, state = [], [], []
    pairs = live.order_event_pairs(orders, happened)

    for rows, steps in drops:
        given = staged_orders(spark, *({"order_id": o, "order_ts": at(t)} for o, t in rows))
        given.write.mode("append").parquet(f"{folder}/orders")
        event_table(spark, *steps).write.mode("append").parquet(f"{folder}/happened")
        all_orders.append(given)
        all_events.append(event_table(spark, *steps))
        progress = live.follow(pairs, f"{folder}/pairs", f"{folder}/log")
        state.append(progress[-1]["stateOperators"][0]["numRowsTotal"])
    # What the first drops left has gone: the last two orders and their events stay.
    assert state[1] > state[3] and state[2] <= state[1]
    timeline = live.closed_timeline(spark, f"{folder}/pairs", pairs.schema)
    whole = lambda parts: parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    expected = delivery_timeline(whole(all_orders), whole(all_events))
    closed = F.col("order_id").startswith("o")
    assert rows_of(timeline.where(closed)) == rows_of(expected.where(closed).select(*timeline.columns))
    assert timeline.where("order_id = 'o2' AND delivered_ts IS NULL").count() == 1


def test_what_waits_lies_in_one_store_per_partition(spark, folder):
    """Not on the heap, so that the orders of a batch need not fit there."""
    given = staged_orders(spark, {"order_id": "o1", "order_ts": at("2026-01-15 10:00:00")})
    given.write.parquet(f"{folder}/orders")
    event_table(spark, ("o1", "delivered", "2026-01-15 10:30:00")).write.parquet(f"{folder}/happened")
    pairs = live.order_event_pairs(
        spark.readStream.schema(given.schema).parquet(f"{folder}/orders"),
        spark.readStream.schema(EVENTS.schema).parquet(f"{folder}/happened"),
    )
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    operator = live.follow(pairs, f"{folder}/pairs", f"{folder}/log")[-1]["stateOperators"][0]
    assert operator["numStateStoreInstances"] == operator["numShufflePartitions"]
    assert any(name.startswith("rocksdb") for name in operator["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_later_calls_load_what_waits_without_playing_it_back(spark, folder):
    """Else the time of a call would grow with all batches before it."""
    schema = staged_orders(spark, {"order_id": "o"}).schema
    for name in ("orders", "happened"):
        Path(folder, name).mkdir()
    pairs = live.order_event_pairs(
        spark.readStream.schema(schema).parquet(f"{folder}/orders"),
        spark.readStream.schema(EVENTS.schema).parquet(f"{folder}/happened"),
    )
    for day in (15, 16, 17):
        order = {"order_id": f"o{day}", "order_ts": at(f"2026-01-{day} 10:00:00")}
        staged_orders(spark, order).write.mode("append").parquet(f"{folder}/orders")
        happened = event_table(spark, (f"o{day}", "delivered", f"2026-01-{day} 10:30:00"))
        happened.write.mode("append").parquet(f"{folder}/happened")
        progress = live.follow(pairs, f"{folder}/pairs", f"{folder}/log")
        assert not any(p["stateOperators"][0]["customMetrics"].get("rocksdbNumReplayChangelogFiles") for p in progress)
    state = Path(folder, "log", "state")
    assert list(state.rglob("*.zip")) and not list(state.rglob("*.changelog"))
    # What the first call left in the state is still there.
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] > 2
