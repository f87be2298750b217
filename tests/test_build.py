"""The whole run on raw files with every kind of defect."""

import datetime as dt
import json
import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from courierlake.plans import build, quality, silver
from courierlake.session import unless_given
from courierlake.sources import lake, raw
from courierlake.sources.schemas import RAW_TABLES
from helpers import at, plan_of, raw_table, rows_of
from parity import queries

START = dt.datetime(2026, 1, 15, 9)


def write_raw(folder, days=14, per_day=12):
    raw = Path(folder, "raw")
    raw.mkdir()
    orders = ["order_id,customer_id,restaurant_id,city,order_ts,promised_delivery_ts,status,order_value,payment_mode"]
    items, refunds, tickets, events = (
        ["order_id,item_id,quantity,item_price,cuisine_type"],
        ["refund_id,order_id,refund_ts,refund_reason,refund_amount"],
        ["ticket_id,order_id,ticket_type,created_ts,resolution_status"],
        [],
    )
    for n in range(days * per_day):
        start = START + dt.timedelta(days=n // per_day, hours=n % per_day)
        status = "cancelled" if n % 10 == 0 else "delivered"
        line = (
            f"o{n},c{n % 9},r{n % 3}, pune ,{start.isoformat()},"
            f"{(start + dt.timedelta(minutes=40)).isoformat()},{status},{100 + n}.5,upi"
        )
        orders += [line, line] if n % 25 == 0 else [line]
        items.append(f"o{n},i{n},1,10.0,Thai")
        if n % 8 == 0:
            refunds.append(f"f{n},o{n},{start.isoformat()},Delay,5.25")
            tickets.append(f"t{n},o{n},late,{start.isoformat()},open")
        steps = {
            "order_confirmed": 1,
            "restaurant_accepted": 3,
            "food_ready": 3 + 10 + n % 20,
            "rider_picked_up": 30,
            "delivered": 35 + n % 12,
        }
        for event, minutes in steps.items():
            if status == "cancelled" and event not in ("order_confirmed", "restaurant_accepted"):
                continue
            rider = event in ("rider_picked_up", "delivered")
            events.append(
                {
                    "order_id": f"o{n}" if n % 40 else f"ghost{n}",
                    "rider_id": f"d{n % 4}" if rider else None,
                    "event_type": event,
                    "event_ts": (start + dt.timedelta(minutes=minutes)).isoformat(),
                    "latitude": 18.5,
                    "longitude": 73.8,
                }
            )
    orders.append("broken line")
    for name, lines in (
        ("orders", orders),
        ("order_items", items),
        ("refunds", refunds),
        ("support_tickets", tickets),
        ("restaurants", ["restaurant_id,city,cuisine_type,rating_band,onboarding_date"]
         + [f"r{n},Pune,Thai,A,2025-01-0{n + 1}" for n in range(3)]),
        ("riders", ["rider_id,city,shift_type,joining_date"]
         + [f"d{n},Pune,night,2025-02-0{n + 1}" for n in range(4)]),
    ):
        (raw / f"{name}.csv").write_text("\n".join(lines) + "\n")
    (raw / "delivery_events.json").write_text(json.dumps(events, indent=2))
    return str(raw)


def test_full_run(spark, folder, database):
    raw_path = write_raw(folder)
    tables = build.run(
        spark,
        raw_path,
        f"{folder}/lake",
        database,
        at("2026-02-01"),
        json_lines=False,
        order_buckets=4,
        calendar=(dt.date(2026, 1, 15), dt.date(2026, 3, 22)),
    )
    assert tables["fct_orders"].count() == 14 * 12
    assert tables["dim_date"].count() == 67
    assert tables["time_slots"].count() == 5
    sla = tables["mart_sla_breach_analysis"]
    assert sla.agg({"total_orders": "sum"}).first()[0] == tables["fct_orders"].where(
        "status = 'delivered'"
    ).count()
    assert tables["mart_weekly_trends"].count() == 3
    assert tables["mart_restaurant_prep_delays"].count() == 3
    assert tables["mart_rider_performance"].count() == 4
    assert tables["mart_refund_drivers"].first().total_refunds == 21

    expected = tables["expectations"]
    assert {row.table_name for row in expected.collect()} == quality.EXPECTATIONS.keys()
    assert expected.where("violations > 0").count() == 0
    assert tables["refund_shares_off"].count() == 0
    assert tables["dq_report"].count() == 6
    part = tables["fct_orders"].where("order_date = DATE'2026-01-20'")
    assert part.count() == 12 and "PartitionFilters: [isnotnull(order_date" in plan_of(part)

    for name, answer in build.ask(tables).items():
        assert 0 <= answer.count() <= 5, name
    # Views are not stored; the models are.
    stored = lake.list_tables(spark, database)
    assert "fct_orders" in stored and "stg_orders" not in stored

    # Bucketed by order: the order-event join needs no shuffle.
    from courierlake.plans.timeline import delivery_timeline

    plan = plan_of(delivery_timeline(tables["stg_orders"], tables["stg_delivery_events"]))
    assert "Join" in plan and "Exchange hashpartitioning" not in plan


def test_silver_report_and_rerun(spark, folder):
    raw_path = write_raw(folder, days=2)
    from courierlake.sources import raw

    for _ in range(2):  # a full refresh replaces what was there
        written = raw.ingest_all(spark, raw_path, f"{folder}/bronze", batch_id="b1", json_lines=False)
        assert written["orders"] == 24 + 1 + 1
        report = build.build_silver(
            spark, f"{folder}/bronze", f"{folder}/silver", at("2026-01-16 12:00:00")
        )
        found = {(r.table_name, r.dq_flag): r.flagged_count for r in report.collect()}
        assert found[("orders", "_dq_future_order")] == 8
        assert found[("delivery_events", "_dq_orphan_order")] == 2
        assert found[("delivery_events", "_dq_missing_rider")] == 0


def shuffle_files(spark):
    """Names of the shuffle files on this machine's disk."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, folder, database):
    rows = spark.range(1000).selectExpr("id % 7 AS n", "date_add(DATE'2026-01-01', int(id % 3)) AS day")
    before = shuffle_files(spark)
    for step in (
        lambda: lake.write(rows.distinct(), f"{folder}/plain"),
        lambda: lake.write(rows, f"{folder}/days", "day"),
        lambda: lake.save_table(rows, f"{database}.days", "day"),
        lambda: lake.save_bucketed(rows, f"{database}.buckets", "n", 2),
    ):
        step()
        until = time.monotonic() + 10
        while left := shuffle_files(spark) - before:
            assert time.monotonic() < until, left
            time.sleep(0.1)
    assert spark.read.parquet(f"{folder}/days").count() == spark.table(f"{database}.days").count() == 1000


def test_what_follows_from_a_row_is_made_after_the_shuffle(spark, folder, database):
    rows = spark.range(30).selectExpr("id", "date_add(DATE'2026-01-01', int(id % 3)) AS day")
    dealt = []

    def finish(df):
        dealt.append(df._jdf.queryExecution().analyzed().toString())
        return df.withColumn("twice", df.id * 2)

    assert lake.write(rows, f"{folder}/days", "day", finish) == 30
    assert lake.write(rows, f"{folder}/plain", finish=finish) == 30
    assert lake.save_table(rows, f"{database}.days", "day", finish) == 30
    assert lake.publish(rows, "a_view", "view", finish=finish).columns == ["id", "day", "twice"]
    assert ["RebalancePartitions" in plan for plan in dealt] == [True, False, True, False]
    for stored in (lake.read(spark, f"{folder}/days"), spark.table(f"{database}.days")):
        assert stored.where("twice = 2 * id").count() == 30


def test_the_run_stores_zstd_unless_the_application_chose(spark, folder, database, monkeypatch):
    """And reads such files in small pieces, or the sorts of their rows would spill."""
    key, raw_path = "spark.sql.parquet.compression.codec", write_raw(folder, days=2)
    before, pieces, read = spark.conf.get(key), [], "spark.sql.files.maxPartitionBytes"
    for step, module in (("ingest_all", raw), ("build_silver", build), ("build_models", build)):
        given = getattr(module, step)
        noted = lambda *args, given=given, **more: (pieces.append(int(spark.conf.get(read).rstrip("b"))), given(*args, **more))[1]
        monkeypatch.setattr(module, step, noted)
    tables = build.run(spark, raw_path, f"{folder}/lake", database, at("2026-02-01"), json_lines=False)
    assert spark.conf.get(key) == before and tables["fct_orders"].count() == 24
    assert pieces == [build.PACKED_BYTES, build.PACKED_BYTES, 128 * 1024**2]
    files = [*Path(folder, "lake").rglob("*.parquet")]
    assert files and all(file.name.endswith(".zstd.parquet") for file in files)
    with unless_given(spark, "spark.sql.shuffle.partitions", "9"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_orphans_are_told_by_the_ids_that_no_order_has(spark):
    kept = ("order_id", "event_type", "_dq_orphan_order")
    orders = raw_table(spark, "orders", {"order_id": "o1"}, {"order_id": "o1"}, {"order_id": None}, {"order_id": "o3"})
    bronze = raw_table(
        spark,
        "delivery_events",
        *({"order_id": o, "event_type": e} for o in ("o1", "ghost", None, "o3") for e in ("delivered", "delivered", None)),
        _ingested_at=F.lit(at("2026-01-01")),
        _batch_id=F.lit("b"),
        _corrupt_record=F.when(F.col("order_id") == "o3", "{"),
    )
    unknown = silver.unknown_orders(bronze, orders)
    assert rows_of(unknown) == [("ghost",)]
    flagged = silver.silver_events(bronze, orders, unknown)
    expected = silver.silver_events(bronze, orders)
    assert flagged.columns == expected.columns and rows_of(flagged) == rows_of(expected)
    assert {row[0::2] for row in rows_of(flagged, *kept)} == {("o1", False), ("ghost", True), (None, None)}
    assert rows_of(silver.unknown_orders(bronze, orders.where("false"))) == [("ghost",), ("o1",)]


def test_stored_ids_spare_the_events_a_shuffle(spark, folder):
    """As few unknown ids are broadcast, events move for their deduplication only."""
    orders = raw_table(spark, "orders", *({"order_id": f"o{i}"} for i in range(50)))
    events = ({"order_id": f"o{i}", "event_type": "delivered"} for i in range(60))
    bronze = raw_table(spark, "delivery_events", *events, _ingested_at=F.lit(at("2026-01-01")), _batch_id=F.lit("b"))
    lake.write(orders, f"{folder}/bronze/orders")
    lake.write(bronze, f"{folder}/bronze/delivery_events")
    for name in build.SIMPLE_TABLES:
        lake.write(raw_table(spark, name).withColumns({"_ingested_at": F.lit(at("2026-01-01")), "_batch_id": F.lit("b")}), f"{folder}/bronze/{name}")
    plans = []
    write = lake.write

    def noted(df, path, *args, **more):
        plans.append((path, plan_of(df)))
        return write(df, path, *args, **more)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lake, "write", noted)
        build.build_silver(spark, f"{folder}/bronze", f"{folder}/silver")
    plan = dict(plans)[f"{folder}/silver/delivery_events"]
    assert plan.count("Exchange hashpartitioning") == 1 and "bronze/orders" not in plan
    assert lake.read(spark, f"{folder}/silver/delivery_events").where("_dq_orphan_order").count() == 10


def test_raw_files_are_delivered_zipped(spark, folder, monkeypatch):
    monkeypatch.setattr(queries, "RAW_FILE_ROWS", 2)
    rows = {
        "refunds": [{"refund_id": f"f{i}", "order_id": "o,1" if i else None, "refund_amount": i / 4} for i in range(7)],
        "delivery_events": [{"order_id": f"o{i}", "event_ts": at("2026-01-01") if i else None} for i in range(7)],
    }
    given = {name: raw_table(spark, name, *some).coalesce(1) for name, some in rows.items()}
    for name, df in given.items():
        table = RAW_TABLES[name]
        queries._write_raw(SimpleNamespace(raw=given.get), name, f"{folder}/raw")
        files = [file.name for file in Path(folder, "raw", table.file).iterdir() if file.name.startswith("part-")]
        assert len(files) == 4 and all(name.endswith(".gz") for name in files)
        assert raw.ingest(spark, table, f"{folder}/raw", f"{folder}/bronze", "b") == 7
        assert rows_of(lake.read(spark, f"{folder}/bronze/{name}"), *df.columns) == rows_of(df)
