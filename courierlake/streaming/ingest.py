"""Bronze from raw files that keep arriving: each file is read once.

The file source's log remembers which files were read. A batch of new files
becomes one folder, named by the batch's number; a batch that failed before its
commit runs again with the same files and replaces that folder, so nothing is
doubled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.functions.temporal import now_in
from courierlake.sources import lake, raw
from courierlake.sources.schemas import RAW_TABLES, RawTable

BATCH = "batch"


def batch_name(number: int) -> str:
    """The batch id of bronze rows; ids sort as their numbers do."""
    return f"stream_{number:012d}"


def land(rows: DataFrame, number: int, path: str) -> int:
    """Write one batch with its ingest columns to its folder; rows written.

    `rows` carry their file in `_source_file`. Ingest time and id are the same
    for all rows of the batch; a repeated batch keeps its id.
    """
    stamped = rows.withColumns({"_ingested_at": now_in("UTC"), "_batch_id": F.lit(batch_name(number))})
    return lake.write(stamped, f"{path}/{BATCH}={number}")


def ingest_new_files(
    spark: SparkSession,
    table: RawTable,
    raw_path: str,
    bronze_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> int:
    """Append the raw files of `table` that no earlier call has read; rows written.

    Raw files lie in the folder `table.file`, JSON as one object per line.
    Files must be complete when they appear and aren't changed afterwards.
    Unreadable records are captured as in :mod:`courierlake.sources.raw`.
    """
    source = f"{raw_path}/{table.file}"
    read = raw.read_csv if table.format == "csv" else raw.read_json
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch or 1_000_000)
    arriving = read(spark, source, table, reader=reader)
    arriving = arriving.select(*arriving.columns, F.col("_metadata.file_path").alias("_source_file"))
    written: list[int] = []
    query = (
        arriving.writeStream.foreachBatch(
            lambda rows, number: written.append(land(rows, number, f"{bronze_path}/{table.name}"))
        )
        .option("checkpointLocation", f"{checkpoint}/{table.name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(written)


def ingest_all_new(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    checkpoint: str,
    tables: Iterable[str] = tuple(RAW_TABLES),
) -> dict[str, int]:
    """New files of every raw table; rows written per table."""
    return {name: ingest_new_files(spark, RAW_TABLES[name], raw_path, bronze_path, checkpoint) for name in tables}


def read_bronze(spark: SparkSession, path: str, table: RawTable, after_batch: int = -1) -> DataFrame:
    """Bronze rows of the batches after `after_batch`, with their batch number."""
    stored = spark.read.schema(bronze_schema(table)).parquet(path)
    return stored.where(F.col(BATCH) > after_batch)


def bronze_schema(table: RawTable):
    schema = table.capturing_schema
    for name, type_name in (
        ("_source_file", "string"),
        ("_ingested_at", "timestamp_ntz"),
        ("_batch_id", "string"),
        (BATCH, "integer"),
    ):
        schema = schema.add(name, type_name)
    return schema

