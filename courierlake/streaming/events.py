"""Silver events as a stream: deduplicated, flagged, stored by the day of their order.

An order's events share the order's day, so a new version of an event replaces
the old one within that day, and a batch rewrites only the days of its orders.
Events without a known order have no such day. They are appended, batch by
batch, and deduplicated when read; `settle_orphans` moves those whose order has
come.

The watermark bounds what the stream remembers, and makes it drop arrivals that
are older. None is lost: `sweep_late` merges them from bronze. All merges keep
the latest row per key, so they may be repeated.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from courierlake import functions as fn
from courierlake.operators.latest import latest_rows
from courierlake.plans.silver import drop_corrupt
from courierlake.session import scratch_path
from courierlake.sources.schemas import CORRUPT, RAW_TABLES
from courierlake.streaming.days import distinct_days, read_days, replace_days
from courierlake.streaming.ingest import BATCH, bronze_schema

EVENTS = RAW_TABLES["delivery_events"]
DAY = "order_date"
DELAY_HOURS = 48
# A bronze row without the text of unreadable records, and the order's day.
ROW = StructType([f for f in bronze_schema(EVENTS).fields if f.name not in (CORRUPT, BATCH)])
STORED = StructType([*ROW.fields, StructField(DAY, DateType())])


@dataclass(frozen=True)
class EventStore:
    """Where the events are: days below `known`, the others below `unknown`."""

    path: str

    @property
    def known(self) -> str:
        return f"{self.path}/known"

    @property
    def unknown(self) -> str:
        return f"{self.path}/unknown"


def _event_time() -> Column:
    """The time that the watermark follows. An event dated after its ingest doesn't push it
    ahead; one without a time doesn't move it and is never late."""
    time = F.when(F.col("event_ts").isNotNull(), F.least("event_ts", "_ingested_at"))
    return time.cast("timestamp")


def order_days(orders: DataFrame) -> DataFrame:
    """order_id and day of the known orders, one row each."""
    return (
        orders.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.min(F.col("order_ts").cast("date")).alias(DAY), F.lit(True).alias("_known"))
    )


def merge(spark: SparkSession, arrived: DataFrame, orders: DataFrame, store: EventStore, label: str) -> list[dt.date | None]:
    """Merge events into the store; the days that were rewritten.

    `label` names the batch among the events of unknown orders: the same label
    replaces what it wrote before. Events of known orders without an order time
    share the day NULL.
    """
    path = scratch_path(spark, "located")
    located = drop_corrupt(arrived).select(*ROW.names).join(order_days(orders), "order_id", "left")
    located.write.parquet(path)
    located = spark.read.schema(located.schema).parquet(path)
    unknown = located.where("_known IS NULL").select(*ROW.names)
    unknown.write.mode("overwrite").parquet(f"{store.unknown}/{BATCH}={label}")
    known = located.where("_known").select(*STORED.names)
    days = distinct_days(known, DAY)
    if days:
        stored = read_days(spark, store.known, STORED, DAY, days)
        replace_days(latest_rows(stored.unionByName(known), EVENTS.key), store.known, DAY, days)
    return days


def stream_events(
    spark: SparkSession,
    bronze_path: str,
    orders: DataFrame,
    store: EventStore,
    checkpoint: str,
    delay_hours: int = DELAY_HOURS,
    files_per_batch: int | None = None,
) -> list[dt.date | None]:
    """Merge the bronze events that no earlier call has seen; the days rewritten.

    A row that is delivered again within `delay_hours` of event time is dropped
    before the merge; versions of an event differ in their ingest time, so they
    all pass and the latest one stays. Arrivals older than the watermark are
    left to `sweep_late`.
    """
    arriving = (
        spark.readStream.schema(bronze_schema(EVENTS))
        .option("maxFilesPerTrigger", files_per_batch or 1_000_000)
        .parquet(f"{bronze_path}/{EVENTS.name}")
    )
    fresh = (
        arriving.withColumn("_event_time", _event_time())
        .withWatermark("_event_time", f"{delay_hours} hours")
        .dropDuplicatesWithinWatermark([*EVENTS.schema.names, CORRUPT, "_ingested_at", "_batch_id"])
    )
    touched: set[dt.date | None] = set()

    def land(rows: DataFrame, number: int) -> None:
        touched.update(merge(spark, rows, orders, store, f"stream-{number}"))

    query = (
        fresh.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted(touched, key=lambda day: (day is not None, day))


def late_arrivals(bronze: DataFrame, after_batch: int = -1, delay_hours: int = DELAY_HOURS) -> DataFrame:
    """Bronze events that may have come behind the watermark of their batch.

    These are the rows more than `delay_hours` older than the latest event up to
    their batch: all that the stream dropped, and possibly more. The window runs
    over one row per batch.
    """
    upto = Window.orderBy(BATCH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    horizons = (
        bronze.groupBy(BATCH)
        .agg(F.max(_event_time()).alias("_latest"))
        .select(BATCH, (F.max("_latest").over(upto) - F.make_dt_interval(hours=F.lit(delay_hours))).alias("_horizon"))
    )
    late = bronze.where(F.col(BATCH) > after_batch).join(F.broadcast(horizons), BATCH)
    return late.where(_event_time() < F.col("_horizon")).drop("_horizon")


def sweep_late(
    spark: SparkSession,
    bronze: DataFrame,
    orders: DataFrame,
    store: EventStore,
    after_batch: int = -1,
    delay_hours: int = DELAY_HOURS,
) -> list[dt.date | None]:
    """Merge what came too late for the stream in the batches after `after_batch`; the days rewritten."""
    late = late_arrivals(bronze, after_batch, delay_hours)
    return merge(spark, late, orders, store, f"late-{after_batch}")


def unknown_events(spark: SparkSession, orders: DataFrame, store: EventStore) -> DataFrame:
    """Events whose order isn't among `orders`, the latest row per key."""
    rows = spark.read.schema(ROW).parquet(store.unknown).select(*ROW.names)
    return latest_rows(rows.join(order_days(orders).select("order_id"), "order_id", "left_anti"), EVENTS.key)


def settle_orphans(spark: SparkSession, orders: DataFrame, store: EventStore) -> list[dt.date | None]:
    """Merge events that came before their order; the days rewritten."""
    rows = spark.read.schema(ROW).parquet(store.unknown).select(*ROW.names)
    found = rows.join(order_days(orders).select("order_id"), "order_id", "left_semi")
    return merge(spark, found, orders, store, "settled")


def silver_events(spark: SparkSession, orders: DataFrame, store: EventStore, days: list | None = None) -> DataFrame:
    """The flagged events; with `days` those of known orders on these days, which reads no other."""
    known = read_days(spark, store.known, STORED, DAY, days).drop(DAY).withColumn("_dq_orphan_order", F.lit(False))
    if days is None:
        orphan = F.when(F.col("order_id").isNotNull(), True)
        known = known.unionByName(unknown_events(spark, orders, store).withColumn("_dq_orphan_order", orphan))
    return known.withColumns(
        {"_dq_invalid_event_type": fn.invalid_event_type(), "_dq_missing_rider": fn.missing_rider()}
    )
