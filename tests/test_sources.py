import datetime as dt
import json
from pathlib import Path

from pyspark.sql import functions as F

from courierlake.plans.silver import drop_corrupt
from courierlake.sources import lake, raw
from courierlake.sources.schemas import CORRUPT, RAW_TABLES
from helpers import at, rows_of, staged_orders, table

ORDERS_CSV = """\
order_id,customer_id,restaurant_id,city,order_ts,promised_delivery_ts,status,order_value,payment_mode
o1,c1,r1, Pune ,2026-01-15 10:00:00,2026-01-15T10:40:00.250001,delivered,120.5,upi
o2,c2,r1,Pune,2026-01-15 11:00:00,,cancelled,,
o3,c3,r1,Pune,yesterday,2026-01-15 10:40:00,delivered,10,COD
o4,c4,r1
"""


def write(folder, name, text):
    Path(folder, "raw").mkdir(exist_ok=True)
    Path(folder, "raw", name).write_text(text)
    return f"{folder}/raw"


def test_csv_keeps_malformed_rows(spark, folder):
    raw_path = write(folder, "orders.csv", ORDERS_CSV)
    table = RAW_TABLES["orders"]
    for batch in ("20260116_000000", "20260117_000000"):  # a second run changes nothing
        assert raw.ingest(spark, table, raw_path, f"{folder}/bronze", batch) == 4
    bronze = lake.read(spark, f"{folder}/bronze/orders")
    assert CORRUPT not in table.schema.names
    assert rows_of(bronze, "order_id", CORRUPT) == [
        ("o1", None),
        ("o2", None),
        ("o3", "o3,c3,r1,Pune,yesterday,2026-01-15 10:40:00,delivered,10,COD"),
        ("o4", "o4,c4,r1"),
    ]
    good = bronze.where("order_id = 'o1'").first()
    assert good.promised_delivery_ts == at("2026-01-15 10:40:00.250001")
    assert good._batch_id == "20260117_000000"
    assert good._source_file.endswith("orders.csv")
    assert bronze.select("_ingested_at").distinct().count() == 1
    assert {row.order_id for row in drop_corrupt(bronze).collect()} == {"o1", "o2"}


def test_json_array_and_lines(spark, folder):
    good = {
        "order_id": "o1",
        "rider_id": None,
        "event_type": "delivered",
        "event_ts": "2026-01-15T10:00:00.000001",
        "latitude": 19.5,
        "longitude": 72,
    }
    bad = {**good, "order_id": "o2", "latitude": "north"}
    table = RAW_TABLES["delivery_events"]
    for lines, text in (
        (False, json.dumps([good, bad], indent=2)),
        (True, "\n".join(map(json.dumps, (good, bad))) + '\n{"order_id": "o3", '),
    ):
        raw_path = write(folder, "delivery_events.json", text)
        raw.ingest(spark, table, raw_path, f"{folder}/bronze-{lines}", "b", json_lines=lines)
        bronze = lake.read(spark, f"{folder}/bronze-{lines}/delivery_events")
        assert bronze.count() == (3 if lines else 2)
        assert rows_of(drop_corrupt(bronze), *table.schema.names) == [
            ("o1", None, "delivered", at("2026-01-15 10:00:00.000001"), 19.5, 72.0)
        ]
        broken = bronze.where(F.col(CORRUPT).isNotNull())
        assert broken.where("_source_file not like '%delivery_events.json'").count() == 0
        assert "north" in broken.where("order_id = 'o2'").first()[CORRUPT]


def test_partitioned_write_reads_back_dates(spark, folder):
    orders = staged_orders(
        spark,
        {"order_id": "o1"},
        {"order_id": "o2", "order_ts": at("2026-01-20 23:59:59")},
        {"order_id": "o3", "order_ts": at("2026-01-20 00:00:00")},
    )
    assert lake.write(orders, f"{folder}/orders", "order_date") == 3
    assert Path(folder, "orders", "order_date=2026-01-20").exists()
    back = lake.read(spark, f"{folder}/orders")
    assert dict(back.dtypes)["order_date"] == "date"
    assert rows_of(back, "order_id", "order_date") == [
        ("o1", dt.date(2026, 1, 19)),
        ("o2", dt.date(2026, 1, 20)),
        ("o3", dt.date(2026, 1, 20)),
    ]
    # The day reaches the scan as a partition filter.
    pruned = back.where("order_date = date'2026-01-19'")
    assert len(pruned.inputFiles()) >= 1 and pruned.count() == 1
    assert "PartitionFilters: [isnotnull(order_date" in pruned._jdf.queryExecution().toString()
    # Back to the usual width settings afterwards.
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


def test_hot_partition_value_is_split(spark, folder):
    """One day with nearly all rows is written by several tasks."""
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "2MB")
    try:
        assert lake.write(rows, f"{folder}/days", "day") == 400_000
    finally:
        spark.conf.set(key, before)
    assert len(list(Path(folder, "days", "day=hot").glob("*.parquet"))) > 3


def test_load_tables_replaces_and_skips(spark, folder, database):
    riders = table(spark, "rider_id string", ("a",), ("b",))
    for expected in (2, 1):
        lake.write(riders.limit(expected), f"{folder}/riders")
        loaded = lake.load_tables(spark, folder, ["riders", "refunds"], database)
        assert loaded == {"riders": expected}
        assert spark.table(f"{database}.riders").count() == expected
    assert lake.list_tables(spark, database) == ["riders"]


def test_publish_modes(spark, database):
    df = table(spark, "x int", (1,), (2,))
    assert lake.publish(df, f"{database}.stored").count() == 2
    assert lake.publish(df, "seen", "view").count() == 2
    assert lake.publish(df, "unseen", "inline") is df
    assert lake.list_tables(spark, database) == ["stored"]
    assert spark.catalog.tableExists("seen") and not spark.catalog.tableExists("unseen")


def test_batch_id_format():
    assert raw.new_batch_id(dt.datetime(2026, 1, 2, 3, 4, 5)) == "20260102_030405"


def test_unreadable_json_file_is_kept_whole(spark, folder):
    raw_path = write(folder, "delivery_events.json", '[{"order_id": "o1"}, {"order_id"')
    table = RAW_TABLES["delivery_events"]
    raw.ingest(spark, table, raw_path, f"{folder}/bronze", "b")
    bronze = lake.read(spark, f"{folder}/bronze/delivery_events")
    assert drop_corrupt(bronze).count() == 0
    assert '[{"order_id": "o1"}' in bronze.where(F.col(CORRUPT).isNotNull()).first()[CORRUPT]


def test_an_array_file_is_read_once(spark, folder):
    """The exact text of a number isn't fetched from the file again."""
    path, n = Path(folder, "a.json"), 3000
    path.write_text("[" + ", ".join('{"order_id": 1.10, "event_type": {"a" : 1e2}, "latitude": %d}' % i for i in range(n)) + "]")
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem

    def bytes_read():
        return sum(s.getBytesRead() for s in statistics.getAllStatistics())

    before = bytes_read()
    rows = raw.read_json(spark, str(path), RAW_TABLES["delivery_events"], lines=False).collect()
    assert len(rows) == n and {(r.order_id, r.event_type) for r in rows} == {("1.10", '{"a" : 1e2}')}
    assert sorted(r.latitude for r in rows) == list(range(n))
    assert bytes_read() - before < 10 * path.stat().st_size
