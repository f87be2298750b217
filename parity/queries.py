"""One entry per operator or model: (session, data folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake import functions as fn
from courierlake.operators import bitmaps, joins, late, sequence, sketches
from courierlake.operators.heaviest import heaviest_choice
from courierlake.operators.latest import latest_rows
from courierlake.plans import build, core, incremental, insights, marts, quality, silver
from courierlake.plans import timeline as tl
from courierlake.plans.staging import STAGED_COLUMNS, staged
from courierlake.session import scratch_path, setting, shuffle_width, stored_bytes, tune
from courierlake.sources import lake, raw
from courierlake.sources.schemas import RAW_TABLES
from courierlake.streaming import events as stream
from courierlake.streaming import ingest as arriving
from courierlake.streaming import live
from courierlake.streaming.days import distinct_days
from parity.views import AS_OF, Views

# Events shipped from this day on play the part of a new arrival.
ARRIVAL_DAY = dt.date(2001, 1, 1)
LATE_AS_OF = dt.datetime(2000, 12, 20)
LATE_HOURS = 48 * 30
# About 140 MB of text, a block of the plain files.
RAW_FILE_ROWS = 1_000_000


def _text_row(df: DataFrame, **replaced) -> DataFrame:
    """All columns as text, some of them replaced."""
    return df.select(
        *(replaced.get(name, F.col(name).cast("string")).alias(name) for name in df.columns)
    )


def _raw_rows(v: Views, name: str) -> DataFrame:
    return v.raw(name).select(*RAW_TABLES[name].schema.names)


def _write_raw(v: Views, name: str, folder: str) -> None:
    """Raw files as an upstream system would deliver them: zipped, and so as many
    that a task, which reads a zipped file whole, doesn't read much more than of plain ones."""
    table, rows = RAW_TABLES[name], _raw_rows(v, name)
    packed = {"compression": "gzip", "maxRecordsPerFile": RAW_FILE_ROWS}
    if table.format == "csv":
        _text_row(rows).write.options(header=True, **packed).csv(f"{folder}/{table.file}")
    else:
        rows.write.options(ignoreNullFields=False, **packed).json(f"{folder}/{table.file}")


def _ingest_text(v: Views, name: str, lines: DataFrame, header: bool = False) -> DataFrame:
    """Raw rows written as a file, ingested, and read back from bronze."""
    raw_path, bronze_path = scratch_path(v.spark, "raw"), scratch_path(v.spark, "bronze")
    table = RAW_TABLES[name]
    if table.format == "csv":
        lines.write.option("header", header).csv(f"{raw_path}/{table.file}")
    else:
        lines.write.text(f"{raw_path}/{table.file}")
    raw.ingest(v.spark, table, raw_path, bronze_path, "20010601_000000", json_lines=True)
    return lake.read(v.spark, f"{bronze_path}/{name}")


def bronze_orders_csv(v: Views) -> DataFrame:
    """Orders from CSV, where every 50th order has a value that is no number."""
    broken = F.col("order_id").cast("bigint") % 50 == 0
    value = F.when(broken, "n/a").otherwise(F.col("order_value").cast("string"))
    rows = _text_row(_raw_rows(v, "orders"), order_value=value)
    return _ingest_text(v, "orders", rows, header=True).withColumns(
        {
            "_source_file": F.col("_source_file").contains("orders.csv"),
            "_ingested_at": F.col("_ingested_at").isNotNull(),
        }
    )


def bronze_events_json(v: Views) -> DataFrame:
    """Events from JSON, where every 40th order has a word for a latitude."""
    broken = F.col("order_id").cast("bigint") % 40 == 0
    latitude = F.when(broken, '"north"').otherwise(F.col("latitude").cast("string"))
    known = F.to_json(F.struct("order_id", "rider_id", "event_type", "event_ts", "longitude"))
    lines = _raw_rows(v, "delivery_events").select(
        F.concat(F.rtrim(known, F.lit("}")), F.lit(', "latitude": '), latitude, F.lit("}"))
    )
    return _ingest_text(v, "delivery_events", lines).select(
        *RAW_TABLES["delivery_events"].schema.names,
        F.col("_corrupt_record").isNotNull().alias("is_corrupt"),
        "_batch_id",
    )


def ingest_all_tables(v: Views) -> DataFrame:
    raw_path, bronze_path = scratch_path(v.spark, "raw"), scratch_path(v.spark, "bronze")
    for name in RAW_TABLES:
        _write_raw(v, name, raw_path)
    written = raw.ingest_all(v.spark, raw_path, bronze_path, json_lines=True)
    counts = [
        lake.read(v.spark, f"{bronze_path}/{name}").agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("bronze_rows"),
            F.lit(rows).cast("bigint").alias("reported_rows"),
            F.count_distinct("_batch_id").alias("batches"),
        )
        for name, rows in written.items()
    ]
    return _union(counts)


def date_partitioned_orders(v: Views) -> DataFrame:
    """Orders in one folder per day, loaded as a table with the day as a date."""
    folder, database = scratch_path(v.spark, "silver"), _new_database(v)
    lake.write(v.clean_orders(), f"{folder}/orders", partition_by="order_date")
    lake.load_tables(v.spark, folder, ["orders"], database)
    return v.spark.table(f"{database}.orders")


def _new_database(v: Views) -> str:
    name = f"courier_{uuid.uuid4().hex[:12]}"
    v.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(v.spark, name)}'")
    return name


def warehouse_tables(v: Views) -> DataFrame:
    """Silver folders as catalog tables; one folder is missing on purpose."""
    folder, database = scratch_path(v.spark, "silver"), _new_database(v)
    lake.write(v.clean_orders(), f"{folder}/orders")
    for name in ("refunds", "riders"):
        lake.write(silver.silver(name, v.raw(name)), f"{folder}/{name}")
    loaded = lake.load_tables(
        v.spark, folder, ["orders", "refunds", "restaurants", "riders"], database
    )
    return _union(
        [
            v.spark.table(f"{database}.{name}").agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("table_rows"),
                F.lit(loaded[name]).cast("bigint").alias("reported_rows"),
            )
            for name in lake.list_tables(v.spark, database)
        ]
    )


def bucketed_timeline(v: Views) -> DataFrame:
    """The timeline over tables bucketed by order, which joins without a shuffle."""
    database = _new_database(v)
    lake.save_bucketed(v.orders(), f"{database}.orders", "order_id", buckets=8)
    lake.save_bucketed(v.events(), f"{database}.events", "order_id", buckets=8)
    return tl.delivery_timeline(
        v.spark.table(f"{database}.orders"), v.spark.table(f"{database}.events")
    )


def full_run_sla(v: Views) -> DataFrame:
    """Raw files through bronze, silver, tables and models to the SLA mart."""
    raw_path, lake_path = scratch_path(v.spark, "raw"), scratch_path(v.spark, "lake")
    for name in RAW_TABLES:
        _write_raw(v, name, raw_path)
    tables = build.run(v.spark, raw_path, lake_path, _new_database(v), AS_OF, json_lines=True)
    return tables["mart_sla_breach_analysis"]


def late_reprocess(v: Views) -> DataFrame:
    """An event table by day after its last days were merged with arrivals."""
    events = v.raw_events()
    arrived = F.col("_ingested_at") >= F.lit(ARRIVAL_DAY)
    stored = latest_rows(events.where(~arrived), RAW_TABLES["delivery_events"].key)
    table = f"{_new_database(v)}.events"
    lake.save_table(late.with_event_date(stored), table, partition_by=late.DAY)
    late.reprocess_recent(table, events.where(arrived), LATE_AS_OF, LATE_HOURS)
    return v.spark.table(table)


def late_event_merge(v: Views) -> DataFrame:
    events = late.with_event_date(v.raw_events())
    arrived = F.col("_ingested_at") >= F.lit(ARRIVAL_DAY)
    return late.merge_late_events(events.where(~arrived), events.where(arrived))


def dim_restaurants(v: Views) -> DataFrame:
    return core.dim_restaurants(v.restaurants(), v.timeline())


def sla_mart(v: Views) -> DataFrame:
    return marts.sla_breach_analysis(v.timeline())


def prep_mart(v: Views) -> DataFrame:
    return marts.restaurant_prep_delays(v.timeline(), v.restaurants(), AS_OF.date())


def refund_mart(v: Views) -> DataFrame:
    return marts.refund_drivers(tl.order_refunds(v.orders(), v.refunds()))


def rider_mart(v: Views) -> DataFrame:
    return marts.rider_performance(v.timeline(), v.riders(), AS_OF.date())


def weekly_mart(v: Views) -> DataFrame:
    return marts.weekly_trends(v.orders(), v.refunds())


def silver_orders(v: Views) -> DataFrame:
    return silver.silver_orders(v.bronze_orders(), AS_OF)


def silver_events(v: Views) -> DataFrame:
    return silver.silver_events(v.bronze_events(), v.order_times())


def dq_report(v: Views) -> DataFrame:
    return quality.quality_report(
        {
            "orders": (silver_orders(v), silver.ORDER_FLAGS),
            "delivery_events": (silver_events(v), silver.EVENT_FLAGS),
        }
    )


def expectations(v: Views) -> DataFrame:
    """Violations per expectation on stored tables.

    Orders are not filtered and tickets not deduplicated here, so some checks fire.
    The dimension is made from the stored fact, as in `build`: events and orders
    are joined once.
    """
    folder = scratch_path(v.spark, "checked")

    def store(name: str, df: DataFrame) -> DataFrame:
        with setting(v.spark, "spark.sql.parquet.compression.codec", "zstd"):
            lake.write(df, f"{folder}/{name}")
        return lake.read(v.spark, f"{folder}/{name}")

    fact = store("fct_orders", core.fct_orders(v.timeline()))
    tables = {
        "stg_orders": silver_orders(v),
        "stg_delivery_events": staged("delivery_events", silver_events(v)),
        "stg_restaurants": v.restaurants(),
        "stg_riders": v.riders(),
        "stg_refunds": v.refunds(),
        "stg_support_tickets": v.raw_tickets(),
        "dim_restaurants": core.dim_restaurants(v.restaurants(), fact),
        "dim_riders": core.dim_riders(v.riders()),
    }
    stored = {name: store(name, df) for name, df in tables.items()}
    return quality.check_tables({**stored, "fct_orders": fact})


def refund_shares_incomplete(v: Views) -> DataFrame:
    """The share test on a mart that lacks a driver category."""
    mart = refund_mart(v).where(F.col("refund_driver_category") != "Delay")
    return quality.refund_shares_off(mart)


def bronze_events_json_array(v: Views) -> DataFrame:
    """Events from files that are one JSON array each, of a thousand orders."""
    return _ingested_array(v, _array_files(v))


def _array_files(v: Views) -> str:
    """The raw folder with the events' array files."""
    rows = _raw_rows(v, "delivery_events")
    file = F.floor(F.col("order_id").cast("bigint") / 1000)
    line = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    arrays = rows.groupBy(file.alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(line), ","), F.lit("]")).alias("value")
    )
    raw_path = scratch_path(v.spark, "raw")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{raw_path}/{RAW_TABLES['delivery_events'].file}")
    return raw_path


def _ingested_array(v: Views, raw_path: str, split_arrays: bool = False) -> DataFrame:
    bronze_path, table = scratch_path(v.spark, "bronze"), RAW_TABLES["delivery_events"]
    raw.ingest(
        v.spark, table, raw_path, bronze_path, "20010601_000000", json_lines=False, split_arrays=split_arrays
    )
    return lake.read(v.spark, f"{bronze_path}/{table.name}").select(
        *table.schema.names, F.col("_corrupt_record").isNotNull().alias("is_corrupt"), "_batch_id"
    )


def loaded_orders_by_day(v: Views) -> DataFrame:
    """Orders per day of the loaded table, one partition each."""
    return date_partitioned_orders(v).groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"))


def bronze_events_split_array(v: Views) -> DataFrame:
    """As bronze_events_json_array, with several tasks per file."""
    raw_path = _array_files(v)
    with setting(v.spark, "spark.sql.files.maxPartitionBytes", str(128 * 1024)):
        return _ingested_array(v, raw_path, split_arrays=True)


def published_versions(v: Views) -> DataFrame:
    """Two versions of each table, the second one in the first one's place."""
    root, database = scratch_path(v.spark, "versions"), _new_database(v)
    counts = []
    for name, day in (("refunds", None), ("orders", "order_date")):
        full = f"{database}.{name}"
        lake.publish_version(v.raw(name), full, root)
        if day:
            v.spark.sql(f"DROP TABLE {full}")
        rows = v.clean_orders() if day else silver.silver(name, v.raw(name))
        _, written = lake.publish_version(rows, full, root, day)
        counts.append(
            v.spark.table(full).agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("table_rows"),
                F.lit(written).cast("bigint").alias("reported_rows"),
                F.lit(len(lake.versions(v.spark, full, root))).cast("bigint").alias("versions"),
            )
        )
    return _union(counts)


# --- Arrivals in several drops --------------------------------------------------------


def _drop_of(column: str):
    """In which of three drops a row comes: by the years of a time."""
    year = F.year(column)
    return F.when(year < 1996, 0).when(year < 1999, 1).otherwise(2)


def streamed_silver_events(v: Views) -> DataFrame:
    """Defective events that arrive by ship date, most of them long after their
    time: new raw files to bronze, the stream over bronze, and the late ones."""
    raw_path, path = scratch_path(v.spark, "raw"), scratch_path(v.spark, "lake")
    table, orders = RAW_TABLES["delivery_events"], v.order_times()
    store = stream.EventStore(f"{path}/events")
    rows = v.bronze_events().withColumn("_drop", _drop_of("_ingested_at")).select("_drop", *table.schema.names)
    for drop in range(3):
        lines = rows.where(F.col("_drop") == drop).drop("_drop")
        lines.write.mode("append").option("ignoreNullFields", False).json(f"{raw_path}/{table.file}")
        arriving.ingest_new_files(v.spark, table, raw_path, f"{path}/bronze", f"{path}/bronze-log")
        stream.stream_events(v.spark, f"{path}/bronze", orders, store, f"{path}/events-log")
    stored = arriving.read_bronze(v.spark, f"{path}/bronze/{table.name}", table)
    stream.sweep_late(v.spark, stored, orders, store)
    found = stream.silver_events(v.spark, orders, store)
    return found.select(*table.schema.names, *silver.EVENT_FLAGS)


# Key and numbers of the marts that follow the stored figures.
INCREMENTAL = {
    "mart_sla_breach_analysis": (
        ("city", "time_slot"),
        ("total_orders", "breached_orders", "breach_rate_pct", "avg_delivery_time_minutes",
         "avg_breach_minutes_when_breached", "days_with_data", "overall_breach_rank", "city_breach_rank"),
    ),
    "mart_rider_performance": (
        ("rider_id", "performance_tier"),
        ("total_orders_delivered", "total_late_deliveries", "avg_delivery_time_minutes", "active_days",
         "orders_per_day", "on_time_rate", "efficiency_score", "city_rank", "overall_rank"),
    ),
    "mart_restaurant_prep_delays": (
        ("restaurant_id", "risk_category"),
        ("total_orders", "avg_prep_time_minutes", "median_prep_time_minutes", "p95_prep_time_minutes",
         "min_prep_time_minutes", "max_prep_time_minutes", "delayed_orders", "delay_rate_pct",
         "sla_breaches_from_prep"),
    ),
}


def incremental_marts(v: Views) -> DataFrame:
    """The marts from daily figures of the first events, brought up to date with
    those that arrived later; one row per mart, key and number."""
    path = scratch_path(v.spark, "figures")
    events = v.raw_events().withColumn("_source_file", F.lit("events"))
    arrived = F.col("_ingested_at") >= F.lit(ARRIVAL_DAY)
    store, orders = stream.EventStore(f"{path}/events"), v.orders()
    # The first build covers all days with orders, also those without an event.
    stream.merge(v.spark, events.where(~arrived), orders, store, "first")
    incremental.refresh(orders, store, path, distinct_days(orders, incremental.DAY))
    incremental.apply_arrivals(events.where(arrived), orders, store, path, "arrived")
    made = incremental.marts_of_figures(v.spark, path, v.restaurants(), v.riders(), AS_OF.date())
    parts = []
    for name, ((first, second), numbers) in INCREMENTAL.items():
        rows = made[name].select(
            F.lit(name).alias("mart"),
            F.col(first).alias("key"),
            F.col(second).alias("class"),
            *(F.col(number).cast("double").alias(number) for number in numbers),
        )
        parts.append(rows.unpivot(["mart", "key", "class"], list(numbers), "measure", "value"))
    return _union(parts).where(F.col("value").isNotNull())


def live_timeline(v: Views) -> DataFrame:
    """Orders and events as two streams in three drops, and two later orders that close them all."""
    path = scratch_path(v.spark, "live")
    orders, events = v.orders(), v.events().select("order_id", "rider_id", "event_type", "event_ts")
    # Events come with the drop of their order: joined once, as a drop is a part of all.
    dealt = orders.select("order_id", _drop_of("order_ts").alias("_drop"))
    placed = events.join(dealt, "order_id")
    placed.write.partitionBy("_drop").parquet(f"{path}/placed")
    placed = v.spark.read.schema(placed.schema).parquet(f"{path}/placed")
    ticks = [
        orders.limit(1).withColumns(
            {"order_id": F.lit("tick"), "order_ts": F.lit(f"{year}-01-01").cast("timestamp_ntz")}
        )
        for year in (2100, 2200)
    ]
    drops = [
        (orders.where(_drop_of("order_ts") == d), placed.where(F.col("_drop") == d).drop("_drop"))
        for d in range(3)
    ]
    tick_events = [
        tick.select("order_id", F.lit(None).cast("string").alias("rider_id"), F.lit("tick").alias("event_type"), F.col("order_ts").alias("event_ts"))
        for tick in ticks
    ]
    schemas = orders.schema, events.schema
    pairs = None
    for given, happened in (*drops, *zip(ticks, tick_events)):
        given.write.mode("append").parquet(f"{path}/orders")
        happened.select(*events.columns).write.mode("append").parquet(f"{path}/events")
        pairs = live.order_event_pairs(
            v.spark.readStream.schema(schemas[0]).parquet(f"{path}/orders"),
            v.spark.readStream.schema(schemas[1]).parquet(f"{path}/events"),
        )
        live.follow(pairs, f"{path}/pairs", f"{path}/log")
    return live.closed_timeline(v.spark, f"{path}/pairs", pairs.schema).where(F.col("order_id") != "tick")


# --- Merged summaries ------------------------------------------------------------------


def approximate_prep_percentiles(v: Views) -> DataFrame:
    """Do percentiles from merged daily sketches stay within the stated rank error?"""
    fractions = {"median_us": 0.5, "p95_us": 0.95}
    counts = marts.prep_time_counts(v.timeline(), "order_date")
    prep = tl.with_valid_prep(v.timeline()).withColumn("prep_us", fn.micros_between("accepted_ts", "food_ready_ts"))
    daily = sketches.summaries(prep, ["restaurant_id", "order_date"], "prep_us")
    found = sketches.approximate_percentiles(sketches.merged(daily, ["restaurant_id"]), ["restaurant_id"], fractions)
    errors = sketches.rank_errors(found, counts, "restaurant_id", "prep_us", "orders", fractions)
    within = lambda name: (F.col(f"{name}_rank_error") <= sketches.RANK_ERROR).alias(f"{name}_within")
    return errors.select("restaurant_id", "n", *map(within, fractions))


def rider_active_days(v: Views) -> DataFrame:
    """Days with deliveries per rider, from bitmaps of three batches, one of which comes twice."""
    rows = tl.delivered_only(v.timeline()).where(F.col("rider_id").isNotNull())
    rows = rows.withColumn("_drop", _drop_of("order_ts"))
    sets = _union([bitmaps.day_sets(rows.where(F.col("_drop") == d), ["rider_id"], "order_date") for d in (0, 1, 2, 1)])
    return bitmaps.count_days(bitmaps.merged(sets, ["rider_id"]), ["rider_id"], "active_days")


def rider_primary_cities(v: Views) -> DataFrame:
    """The city in which each rider has most deliveries."""
    delivered = tl.delivered_only(v.timeline())
    return heaviest_choice(delivered, ["rider_id"], "city", name="deliveries")


def rider_mart_by_primary_city(v: Views) -> DataFrame:
    """The rider mart where riders are ranked in their primary city instead of their home."""
    timeline = v.timeline()
    cities = heaviest_choice(tl.delivered_only(timeline), ["rider_id"], "city").select("rider_id", "city")
    riders = v.riders().drop("city").join(cities, "rider_id", "left")
    return marts.rider_performance(timeline, riders, AS_OF.date())


def order_durations(v: Views) -> DataFrame:
    return v.orders().select(
        "order_id",
        fn.micros_between("order_ts", "promised_delivery_ts").alias("promised_us"),
        fn.minutes_between("order_ts", "promised_delivery_ts").alias("promised_minutes"),
        fn.days_between(F.col("order_ts"), F.lit(AS_OF.date())).alias("age_days"),
    )


def refund_totals(v: Views) -> DataFrame:
    return v.refunds().agg(
        F.count(F.lit(1)).alias("refunds"),
        F.sum("refund_amount").alias("refund_amount"),
        F.min("refund_amount").alias("smallest"),
        F.max("refund_amount").alias("largest"),
    )


def sequence_flags(v: Views) -> DataFrame:
    events = latest_rows(v.bronze_events(), RAW_TABLES["delivery_events"].key)
    return sequence.flag_invalid_sequence(events)


def prep_percentiles(v: Views) -> DataFrame:
    located = marts.prep_percentiles(marts.prep_time_counts(v.timeline()))
    return located.select(
        "restaurant_id",
        F.round("median_prep_time_minutes", 6).alias("median_prep_time_minutes"),
        F.round("p95_prep_time_minutes", 6).alias("p95_prep_time_minutes"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first


_QUERIES: dict[str, Callable[[Views], DataFrame]] = {
    # Sources and sinks
    "bronze_orders_csv": bronze_orders_csv,
    "bronze_events_json": bronze_events_json,
    "bronze_events_json_array": bronze_events_json_array,
    "ingest_all_tables": ingest_all_tables,
    "date_partitioned_orders": date_partitioned_orders,
    "loaded_orders_by_day": loaded_orders_by_day,
    "bronze_events_split_array": bronze_events_split_array,
    "published_versions": published_versions,
    # Arrivals in several drops
    "streamed_silver_events": streamed_silver_events,
    "incremental_marts": incremental_marts,
    "live_timeline": live_timeline,
    # Merged summaries
    "approximate_prep_percentiles": approximate_prep_percentiles,
    "rider_active_days": rider_active_days,
    "rider_primary_cities": rider_primary_cities,
    "rider_mart_by_primary_city": rider_mart_by_primary_city,
    "slot_labels_by_hours": lambda v: lake.label_hours(v.orders(), lake.time_slots(v.spark)).select(
        "order_id", "order_hour", "slot", "label"
    ),
    "warehouse_tables": warehouse_tables,
    "bucketed_timeline": bucketed_timeline,
    "full_run_sla": full_run_sla,
    "slot_labels": lambda v: lake.label_time_slots(v.orders()).select(
        "order_id", "order_hour", "slot", "label"
    ),
    # Silver
    "silver_orders": silver_orders,
    "silver_events": silver_events,
    "silver_order_items": lambda v: silver.silver("order_items", v.raw_order_items()),
    "silver_order_items_by_item": lambda v: latest_rows(v.raw_order_items(), ["item_id"]),
    "silver_restaurants": lambda v: silver.silver("restaurants", v.raw_restaurants()),
    "silver_riders": lambda v: silver.silver("riders", v.raw_riders()),
    "silver_refunds": lambda v: silver.silver("refunds", v.raw_refunds()),
    "silver_support_tickets": lambda v: silver.silver("support_tickets", v.raw_tickets()),
    "orphan_events": lambda v: joins.orphan_events(v.bronze_events(), v.order_times()),
    # Staging
    "stg_orders": lambda v: staged("orders", silver_orders(v)),
    "stg_delivery_events": lambda v: staged("delivery_events", silver_events(v)),
    **{
        f"stg_{name}": (lambda name: lambda v: v.clean(name))(name)
        for name in STAGED_COLUMNS
        if name in build.SIMPLE_TABLES
    },
    # Scalar functions and filters
    "order_durations": order_durations,
    "order_calendar": lambda v: v.clean_orders().select(
        "order_id", "order_date", "order_hour", "time_slot", "day_of_week", "is_weekend"
    ),
    "delivered_orders": lambda v: tl.delivered_only(v.orders()),
    "valid_prep_orders": lambda v: tl.with_valid_prep(v.timeline()).select(
        "order_id", "restaurant_id", "prep_time_minutes"
    ),
    # Order-level models
    "event_milestones": lambda v: tl.event_milestones(v.events()),
    "order_timeline": lambda v: v.timeline(),
    "order_refunds": lambda v: tl.order_refunds(v.orders(), v.refunds()),
    "orders_with_deliveries": lambda v: insights.orders_with_deliveries(
        v.orders().select("order_id", "status", "promised_delivery_ts"), v.events()
    ),
    "rider_daily": lambda v: tl.rider_daily(v.timeline()),
    "restaurant_daily": lambda v: tl.restaurant_daily(v.timeline()),
    # Core
    "dim_restaurants": dim_restaurants,
    "dim_riders": lambda v: core.dim_riders(v.riders()),
    "dim_date": lambda v: core.dim_date(core.order_date_range(v.orders())),
    "fct_orders": lambda v: core.fct_orders(v.timeline()),
    # Steps of the marts
    "sla_daily": lambda v: marts.sla_daily(v.timeline()),
    "prep_percentiles": prep_percentiles,
    "rider_summary": lambda v: marts.rider_summary(tl.rider_daily(v.timeline())),
    "weekly_orders": lambda v: marts.weekly_orders(v.orders()),
    "weekly_refunds": lambda v: marts.weekly_refunds(v.refunds()),
    "refund_totals": refund_totals,
    # Marts
    "mart_sla_breach_analysis": sla_mart,
    "mart_sla_breach_analysis_range_sorted": sla_mart,
    "mart_restaurant_prep_delays": prep_mart,
    "mart_restaurant_prep_delays_sliced": prep_mart,
    "mart_refund_drivers": refund_mart,
    "mart_rider_performance": rider_mart,
    "mart_rider_performance_range_sorted": rider_mart,
    "mart_weekly_trends": weekly_mart,
    # Insights
    "worst_sla_slots": lambda v: insights.worst_sla_slots(sla_mart(v)),
    "riskiest_restaurants": lambda v: insights.riskiest_restaurants(prep_mart(v)),
    "refund_split": lambda v: insights.refund_split(refund_mart(v)),
    "star_riders": lambda v: insights.star_riders(rider_mart(v)),
    "latest_weeks": lambda v: insights.latest_weeks(weekly_mart(v)),
    "raw_sla_slots": lambda v: insights.raw_sla_slots(v.orders(), v.events()),
    "raw_busiest_restaurants": lambda v: insights.raw_busiest_restaurants(v.orders()),
    "raw_refund_reasons": lambda v: insights.raw_refund_reasons(v.refunds()),
    "raw_busiest_riders": lambda v: insights.raw_busiest_riders(v.events()),
    "raw_latest_weeks": lambda v: insights.raw_latest_weeks(v.orders()),
    # Quality
    "dq_report": dq_report,
    "order_value_review": lambda v: quality.order_value_review(silver_orders(v)),
    "not_unique_item_ids": lambda v: quality.not_unique(v.raw_order_items(), "item_id"),
    "null_customer_orders": lambda v: quality.is_null(silver_orders(v), "customer_id").select(
        "order_id"
    ),
    "refund_shares_off": lambda v: quality.refund_shares_off(refund_mart(v)),
    "refund_shares_incomplete": refund_shares_incomplete,
    "expectations": expectations,
    "invalid_sequence": sequence_flags,
    "missing_promise": lambda v: silver.flag_missing_promise(v.raw_orders()).select(
        "order_id", "_dq_missing_promised_ts"
    ),
    "partial_weeks": lambda v: sequence.flag_partial_weeks(v.orders()),
    "late_event_merge": late_event_merge,
    "late_reprocess": late_reprocess,
}


def _widen(spark: SparkSession, path: str) -> None:
    """Fit the shuffles to the input, unless the application has set their width."""
    key = "spark.sql.shuffle.partitions"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, shuffle_width(spark, stored_bytes(spark, path)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, path: str) -> DataFrame:
            tune(spark)
            _widen(spark, path)
            return query(Views(spark, path))

        return run

    return {name: bind(query) for name, query in _QUERIES.items()}
