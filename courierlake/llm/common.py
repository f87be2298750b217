"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import courierlake
from courierlake.session import scratch_path

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once below the shared folder and read back.

    A written table cuts the lineage: an executor lost later costs a reread,
    not a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def label_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo `folds`; NULL for a NULL id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)).cast("int")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id as text, and text: pandas would turn whole numbers with NULLs into doubles."""
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def with_number_id(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def fold_bytes(text: str | None) -> bytes:
    """UTF-8 of `text` with A-Z lower-cased; empty for NULL."""
    return b"" if text is None else text.encode("utf-8", "replace").lower()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once, wherever they run.

    Spark's own file server hands out the archive; the folder it is packed in
    is the driver's alone.
    """
    name = "courierlake-package.zip"
    context = spark.sparkContext
    if any(file.endswith(name) for file in context.listFiles):
        return
    archive = Path(tempfile.mkdtemp(prefix="courierlake-")) / name
    root = Path(courierlake.__file__).parent
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
