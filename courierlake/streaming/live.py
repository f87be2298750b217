"""The order timeline from two streams, orders and events, with bounded state.

An order waits for its events until the watermark of both streams has passed
the end of its time; then it leaves the state, with a row of its own if it had
no event. Pairs are appended; the timeline pivots them when read.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courierlake.plans.timeline import ORDER_COLUMNS, delivery_timeline
from courierlake.session import setting

ORDER_HOURS, DELAY_HOURS = 48, 48
# What waits lies on the executors' disks, in one store per partition. The default keeps it on
# the heap, in four stores per partition that are loaded and written one by one. Every batch leaves
# its stores as files, the new ones only: a log of changes would be played back by each call, from
# the first batch on.
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": STATE_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
EVENT_COLUMNS = ("rider_id", "event_type", "event_ts")


def order_event_pairs(
    orders: DataFrame, events: DataFrame, order_hours: int = ORDER_HOURS, delay_hours: int = DELAY_HOURS
) -> DataFrame:
    """Staged orders LEFT JOIN their events within `order_hours`, both of them streams.

    Rows up to `delay_hours` behind the latest time of their stream take part.
    Orders or events without a time have no place in a watermark and are left out.
    """
    left = orders.select(*ORDER_COLUMNS).where(F.col("order_ts").isNotNull())
    left = left.withColumn("_ordered", F.col("order_ts").cast("timestamp")).withWatermark("_ordered", f"{delay_hours} hours")
    right = events.select(F.col("order_id").alias("_order_id"), *EVENT_COLUMNS).where(F.col("event_ts").isNotNull())
    right = right.withColumn("_happened", F.col("event_ts").cast("timestamp")).withWatermark("_happened", f"{delay_hours} hours")
    in_time = F.expr(
        f"_order_id = order_id AND _happened >= _ordered AND _happened <= _ordered + INTERVAL {order_hours} HOURS"
    )
    return left.join(right, in_time, "leftOuter").drop("_order_id", "_ordered", "_happened")


def follow(pairs: DataFrame, path: str, checkpoint: str) -> list[dict]:
    """Append the pairs that can be told by now; the progress of every batch.

    The file sink's log makes each batch count once, whatever fails. The first
    call decides how `checkpoint` keeps its state; a log that began with other
    settings goes on with those.
    """
    with ExitStack() as settings:
        for key, value in STATE_SETTINGS.items():
            settings.enter_context(setting(pairs.sparkSession, key, value))
        query = (
            pairs.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return [progress if isinstance(progress, dict) else progress.__dict__ for progress in query.recentProgress]


def closed_timeline(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The delivery timeline of the orders among the appended pairs.

    An order is complete once it is closed; of an open one the events so far are there.
    """
    pairs = spark.read.schema(schema).parquet(path)
    orders = pairs.select(*ORDER_COLUMNS).dropDuplicates(["order_id"])
    events = pairs.where(F.col("event_type").isNotNull()).select("order_id", *EVENT_COLUMNS)
    return delivery_timeline(orders, events)
