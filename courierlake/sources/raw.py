"""Raw files to bronze tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from courierlake.functions.temporal import now_in
from courierlake.sources import lake
from courierlake.sources.arrays import array_objects
from courierlake.sources.schemas import CORRUPT, RAW_TABLES, RawTable

# A line end that no file holds: JSON has no raw control characters but white space.
NOWHERE = "\x01\x02\x03\x04" * 4


def new_batch_id(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def read_csv(
    spark: SparkSession, path: str, table: RawTable, reader: DataStreamReader | None = None
) -> DataFrame:
    """CSV with a header; a malformed row keeps its text in `_corrupt_record`.

    With a stream `reader`, the files below `path` as a stream.
    """
    return (
        (reader or spark.read)
        .schema(table.capturing_schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_json(
    spark: SparkSession,
    path: str,
    table: RawTable,
    lines: bool = True,
    reader: DataStreamReader | None = None,
) -> DataFrame:
    """JSON records, unreadable ones captured in `_corrupt_record`.

    By default a file has one object per line and splits anywhere. With
    `lines=False` each file is one array of objects, which one task reads
    whole: such feeds should arrive as many files, in UTF-8 and none above 2 GB. A stream
    `reader` is for lines.
    """
    reader = (reader or spark.read).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if lines:
        return reader.schema(table.capturing_schema).json(path)

    # Read as typed columns, one bad object would mark every object of its file
    # as corrupt. Read as text, objects fail one by one. With `multiLine`, the
    # parser would go back to the file for the exact text of every number, one
    # read each; a file that is a single line is parsed in memory.
    rows = reader.schema(_texts(table)).option("lineSep", NOWHERE).json(path)
    return _typed(rows, table)


def read_json_arrays(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    """Files that are one array of objects each, read by as many tasks as they have splits.

    As :func:`read_json` without `lines`, plus the file in `_source_file`.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    objects = array_objects(spark, path)
    parsed = objects.select("file", F.from_json("text", _texts(table), options).alias("_object"))
    return _typed(parsed.select("_object.*", F.col("file").alias("_source_file")), table, "_source_file")


def _texts(table: RawTable) -> StructType:
    """All columns as text, and room for unreadable objects."""
    return StructType([StructField(name, StringType()) for name in (*table.schema.names, CORRUPT)])


def _typed(rows: DataFrame, table: RawTable, *others: str) -> DataFrame:
    """Columns of text as the table's types; an object with a value that is none is captured."""
    typed = {
        field.name: F.col(field.name).try_cast(field.dataType) for field in table.schema.fields
    }
    unreadable = F.lit(False)
    for name, value in typed.items():
        unreadable = unreadable | (F.col(name).isNotNull() & value.isNull())
    record = F.when(unreadable, F.to_json(F.struct(*typed)))
    return rows.select(
        *(value.alias(name) for name, value in typed.items()),
        F.coalesce(CORRUPT, record).alias(CORRUPT),
        *others,
    )


def with_ingest_columns(df: DataFrame, batch_id: str) -> DataFrame:
    """Source file, unless it is there, ingest time (UTC, one instant per batch) and batch id."""
    known = "_source_file" in df.columns
    return df.select(
        *df.columns,
        *([] if known else [F.col("_metadata.file_path").alias("_source_file")]),
        now_in("UTC").alias("_ingested_at"),
        F.lit(batch_id).alias("_batch_id"),
    )


def ingest(
    spark: SparkSession,
    table: RawTable,
    raw_path: str,
    bronze_path: str,
    batch_id: str,
    json_lines: bool = True,
    split_arrays: bool = False,
) -> int:
    """Write one raw table to bronze and return the number of rows written.

    With `split_arrays`, JSON files are arrays that several tasks share.
    """
    source = f"{raw_path}/{table.file}"
    if table.format == "csv":
        rows = read_csv(spark, source, table)
    elif split_arrays:
        rows = read_json_arrays(spark, source, table)
    else:
        rows = read_json(spark, source, table, lines=json_lines)
    return lake.write(with_ingest_columns(rows, batch_id), f"{bronze_path}/{table.name}")


def ingest_all(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    tables: Iterable[str] = tuple(RAW_TABLES),
    batch_id: str | None = None,
    json_lines: bool = True,
) -> dict[str, int]:
    """Every raw table under one batch id; rows written per table."""
    batch_id = batch_id or new_batch_id()
    return {
        name: ingest(spark, RAW_TABLES[name], raw_path, bronze_path, batch_id, json_lines)
        for name in tables
    }
