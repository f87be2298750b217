"""Parquet reading and writing, and the catalog tables built on top."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from contextlib import AbstractContextManager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from courierlake.functions.temporal import time_slot
from courierlake.operators.bands import join_bands
from courierlake.session import setting, shared_dir
from courierlake.sources.schemas import TIME_SLOTS, TIME_SLOTS_SCHEMA

log = logging.getLogger(__name__)

Finish = Callable[[DataFrame], DataFrame]

# Tables with few rows per order, which buckets need.
BUCKETED = ("orders", "delivery_events")


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """`df` plus an observation that holds its row count once it was written.

    The count rides along with the write, where a later `count()` would run
    the plan again. Apply it last: counted before a shuffle, rows would count
    twice when a lost executor makes Spark repeat tasks.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def checkpointed(df: DataFrame) -> tuple[DataFrame, int]:
    """`df` computed once into the shared folder, and its row count."""
    shared_dir(df.sparkSession)
    rows, seen = counted(df)
    return rows.checkpoint(), seen.get["rows"]


def by_partition(df: DataFrame, column: str) -> DataFrame:
    """`df` with the rows of one partition value in few tasks, ready to write.

    REBALANCE rather than a plain repartition: AQE then splits a value that
    holds a large share of the rows over several tasks. Write under
    `whole_width`, as each value already sits in one task unless it is split:
    merging tasks would not save files, only leave fewer tasks to create them.
    """
    return df.hint("rebalance", F.col(column))


def whole_width(spark: SparkSession) -> AbstractContextManager[None]:
    return setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false")


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """The shuffle files of a write go when it ends. Else they stay on the executors' disks
    until the driver happens to collect its memory, while later writes add theirs."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def write(
    df: DataFrame, path: str, partition_by: str | None = None, finish: Finish | None = None
) -> int:
    """Overwrite `path` with `df`; returns the rows written.

    `finish` adds the columns that follow from others of their row. They are made
    after the shuffle by partition, which so moves narrower rows.
    """
    spark = df.sparkSession
    with shuffles_removed(spark):
        if partition_by is None:
            rows, seen = counted(finish(df) if finish else df)
            rows.write.mode("overwrite").parquet(path)
        else:
            dealt = by_partition(df, partition_by)
            rows, seen = counted(finish(dealt) if finish else dealt)
            with whole_width(spark):
                rows.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return seen.get["rows"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """Parquet below `path`; partition columns come back from the folder names."""
    return spark.read.parquet(path)


def load_tables(
    spark: SparkSession,
    silver_path: str,
    names: Iterable[str],
    database: str = "default",
    order_buckets: int | None = None,
) -> dict[str, int]:
    """Replace one catalog table per silver folder; rows per loaded table.

    The tables are external: they read the silver folders where they are, with
    their partitions. A missing folder is logged and skipped. With `order_buckets`, orders and
    events are bucketed by order: worth its one shuffle per table when several
    models run on them. Leave it off if a few orders may hold most refunds, as
    AQE splits a hot key only where both sides of the join are shuffled.
    """
    loaded = {}
    for name in names:
        try:
            rows = read(spark, f"{silver_path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("%s/%s not found, skipping", silver_path, name)
            continue
        if order_buckets and name in BUCKETED:
            loaded[name] = save_bucketed(rows, f"{database}.{name}", "order_id", order_buckets)
        else:
            register(spark, f"{silver_path}/{name}", f"{database}.{name}")
            loaded[name] = rows.count()
    return loaded


def register(spark: SparkSession, path: str, name: str) -> None:
    """Replace catalog table `name` with one over the Parquet below `path`."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def publish_version(
    df: DataFrame, name: str, root: str, partition_by: str | None = None
) -> tuple[str, int]:
    """Publish `df` as a new version of table `name`; its folder and rows.

    The version is written to a folder of its own below `root`, then one catalog
    operation points the name to it. Readers see the old rows or the new ones;
    a run that fails before the switch leaves the old version in place, and the
    one after it is left for `versions` to list. A partitioned version is
    published as a view of its folder, as a table's partitions would have to be
    moved one by one; the view prunes partitions all the same.
    """
    spark = df.sparkSession
    path = f"{root}/{name.rsplit('.', 1)[-1]}/version-{uuid.uuid4().hex[:12]}"
    rows = write(df, path, partition_by)
    switch(spark, name, path, partitioned=partition_by is not None)
    return path, rows


def switch(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """Point `name` to the Parquet below `path` in one step."""
    if partitioned:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    elif spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.catalog.createTable(name, path=path, source="parquet")
    spark.catalog.refreshTable(name)


def versions(spark: SparkSession, name: str, root: str) -> list[str]:
    """The folders of all versions of `name` that have rows, old and new, by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    below = files.option("pathGlobFilter", "*.parquet").load(f"{root}/{name.rsplit('.', 1)[-1]}")
    folder = F.regexp_extract("path", "^(.*/version-[0-9a-f]+)/", 1)
    return sorted(row[0] for row in below.select(folder).distinct().collect())


def save_table(
    df: DataFrame, name: str, partition_by: str | None = None, finish: Finish | None = None
) -> int:
    """Replace catalog table `name`; returns the rows written. `finish` as in `write`."""
    spark = df.sparkSession
    with shuffles_removed(spark):
        if partition_by is None:
            rows, seen = counted(finish(df) if finish else df)
            rows.write.mode("overwrite").saveAsTable(name)
        else:
            dealt = by_partition(df, partition_by)
            rows, seen = counted(finish(dealt) if finish else dealt)
            with whole_width(spark):
                rows.write.mode("overwrite").partitionBy(partition_by).saveAsTable(name)
    return seen.get["rows"]


def save_bucketed(df: DataFrame, name: str, column: str, buckets: int) -> int:
    """Replace catalog table `name` with one bucketed and sorted by `column`.

    Tables bucketed alike join and group on that column without a shuffle.
    Choose `buckets` for the data: a bucket is read by one task. Meant for
    columns that are close to unique, as order ids are.
    """
    rows, seen = counted(df.repartition(buckets, column))
    with shuffles_removed(df.sparkSession):
        rows.write.mode("overwrite").bucketBy(buckets, column).sortBy(column).saveAsTable(name)
    return seen.get["rows"]


def list_tables(spark: SparkSession, database: str = "default") -> list[str]:
    return sorted(
        table.name for table in spark.catalog.listTables(database) if not table.isTemporary
    )


def publish(
    df: DataFrame,
    name: str,
    as_: str = "table",
    partition_by: str | None = None,
    finish: Finish | None = None,
) -> DataFrame:
    """Publish a model as a stored `table`, a session `view`, or not at all (`inline`)."""
    spark = df.sparkSession
    if as_ == "table":
        save_table(df, name, partition_by, finish)
        return spark.table(name)
    df = finish(df) if finish else df
    if as_ == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if as_ == "inline":
        return df
    raise ValueError(f"unknown materialisation {as_!r}")


def time_slots(spark: SparkSession) -> DataFrame:
    """The five-row lookup of day parts."""
    return spark.createDataFrame(TIME_SLOTS, TIME_SLOTS_SCHEMA)


def label_time_slots(orders: DataFrame) -> DataFrame:
    """Orders with the slot and slot label of their hour; broadcast of five fixed rows.

    Joined by the slot's name, so an hour of NULL is late_night here as well.
    """
    slots = time_slots(orders.sparkSession).withColumnRenamed("time_slot", "slot")
    named = orders.withColumn("slot", time_slot("order_hour"))
    return named.join(F.broadcast(slots), "slot", "left").drop("start_hour", "end_hour")


def label_hours(orders: DataFrame, slots: DataFrame, otherwise: str = "late_night") -> DataFrame:
    """Orders with the slot and label whose hours hold their hour, both ends included.

    The seed's bounds decide. An hour that no slot covers, and an order without
    an hour, belong to the slot `otherwise`.
    """
    bands = slots.withColumnRenamed("time_slot", "slot")
    labelled = join_bands(orders, "order_hour", bands, "start_hour", "end_hour", width=4)
    rest = bands.where(F.col("slot") == otherwise).select(F.col("label").alias("_rest")).limit(1)
    # One row, or none if the seed lacks that slot.
    labelled = labelled.join(F.broadcast(rest), F.col("slot").isNull(), "left")
    return labelled.withColumns(
        {"slot": F.coalesce("slot", F.lit(otherwise)), "label": F.coalesce("label", "_rest")}
    ).drop("_rest")
