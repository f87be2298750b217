"""Reproducible shuffle into shards: a Feistel permutation of row numbers.

Rows get global numbers 0..n-1, a keyed permutation shuffles the numbers, and
number p lands in shard `p mod shards` at slot `p div shards`. Shard and slot
of any row are thereby computable from its number alone, shard sizes differ
by at most one, and slots have no gaps.

Only column expressions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 4
# Steps of cycle walking written into the plan. Fewer than sqrt(n) numbers lie
# outside the range, so a walk of this length is out of reach for any n.
WALK = 32
NUMBER_BUCKETS = 4096


def number_rows(rows: DataFrame, name: str, total: str, buckets: int = NUMBER_BUCKETS) -> DataFrame:
    """Add the global row number `name` (from 0) and the row count `total`.

    Rows are numbered by a hash of their content, so the numbers depend on
    nothing but the rows. Identical rows are counted before the shuffle and
    written out again afterwards, so that no bucket holds more than its share
    of distinct rows. The bucket table has at most `buckets` rows.
    """
    columns = rows.columns
    counted = (
        rows.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_hash", F.xxhash64(*columns))
        .withColumn("_bucket", F.pmod(F.col("_hash"), F.lit(buckets)))
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket, whatever the number of documents.
    starts = counted.groupBy("_bucket").agg(F.sum("_copies").alias("_in_bucket"))
    starts = starts.select(
        F.col("_bucket").alias("_start_bucket"),
        F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_start"),
        F.sum("_in_bucket").over(Window.partitionBy()).alias(total),
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", *columns)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.col("_start") + F.sum("_copies").over(running) - F.col("_copies")
    return (
        counted.join(F.broadcast(starts), F.col("_bucket") == F.col("_start_bucket"))
        .withColumn("_first", first)
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
        .select(*columns, (F.col("_first") + F.col("_copy")).alias(name), total)
    )


def feistel(number: Column, size: Column, seed: int) -> Column:
    """One pass of the permutation over a x b >= size, a = ceil(sqrt(size)).

    The halves are numbers below a and below b; each round adds a keyed hash
    of one half to the other. The product exceeds `size` by less than a.
    """
    a = F.ceil(F.sqrt(size.cast("double"))).cast("bigint")
    b = F.floor((size + a - 1) / a).cast("bigint")
    left, right = F.floor(number / b).cast("bigint"), F.pmod(number, b)
    pair = F.struct(left.alias("l"), right.alias("r"))
    return F.aggregate(
        F.array(*(F.lit(seed * ROUNDS + r).cast("bigint") for r in range(ROUNDS))),
        pair,
        lambda acc, key: _round(acc, key, a, b),
        lambda acc: acc["l"] * b + acc["r"],
    )


def _round(acc: Column, key: Column, a: Column, b: Column) -> Column:
    left = F.pmod(acc["l"] + F.pmod(F.xxhash64(key, acc["r"]), a), a)
    # The second half sees the new first half.
    right = F.pmod(acc["r"] + F.pmod(F.xxhash64(key, F.lit(1), left), b), b)
    return F.struct(left.alias("l"), right.alias("r"))


def permuted(number: Column, size: Column, seed: int) -> Column:
    """The permutation of 0..size-1: walk the cycle until back in range."""
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        feistel(number, size, seed),
        lambda at, _: F.when(at < size, at).otherwise(feistel(at, size, seed)),
        lambda at: F.when(at < size, at).otherwise(
            F.raise_error(F.lit("cycle walk too long; take another seed")).cast("bigint")
        ),
    )
    return walked


def shard_rows(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """Add `row_number`, `shard` (0..shards-1) and `slot` (from 0) to `rows`.

    Works on any columns that can be grouped by; the three names must be free.
    NULLs count as values, identical rows each get a number of their own, an
    empty table gives an empty table. Slot s of shard k is number
    `s * shards + k` of the shuffled order.
    """
    columns = rows.columns
    safe = rows.toDF(*(f"_given_{i}" for i in range(len(columns))))
    place = permuted(F.col("_number"), F.col("_total"), seed)
    placed = number_rows(safe, "_number", "_total").withColumn("_place", place)
    return placed.select(
        *(F.col(f"_given_{i}").alias(name) for i, name in enumerate(columns)),
        F.col("_number").alias("row_number"),
        F.pmod(F.col("_place"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_place") / F.lit(shards)).cast("bigint").alias("slot"),
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Write the rows of :func:`shard_rows` to one folder per shard, in slot order."""
    (
        placed.repartition("shard")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
