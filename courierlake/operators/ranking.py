"""Row numbers over a whole table or over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.session import shared_dir

# monotonically_increasing_id keeps the row's position within its partition in
# the low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def add_row_numbers(
    df: DataFrame,
    ranks: dict[str, tuple[Sequence[str], Sequence[Column]]],
) -> DataFrame:
    """Add one row-number column per entry of `ranks`.

    `ranks` maps a column name to (group columns, ordering). An ordering must
    leave no ties. One range sort per ordering numbers the rows, over the whole
    table and within groups alike; it never brings a group into one task.
    """
    by_order: dict[str, tuple[Sequence[Column], dict[str, Sequence[str]]]] = {}
    for name, (groups, order) in ranks.items():
        by_order.setdefault(str(list(order)), (order, {}))[1][name] = groups
    columns = df.columns
    for order, names in by_order.values():
        df = _numbered(df, order, names)
    return df.select(*columns, *ranks)


def _numbered(df: DataFrame, order: Sequence[Column], names: dict[str, Sequence[str]]) -> DataFrame:
    """Row numbers from one range sort: rows of the group in earlier partitions
    plus the place among those of this partition.

    The sorted table is checkpointed, so its partitions, and with them the
    partition ids and positions, stay fixed from here on.
    """
    shared_dir(df.sparkSession)
    placed = (
        df.orderBy(*order)
        .checkpoint()
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    numbered = placed
    for name, groups in names.items():
        # One row per partition of the sort and group in it.
        before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = placed.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_rows"))
        starts = starts.select(
            F.col("_part").alias("_in"),
            *(F.col(group).alias(f"_group_{group}") for group in groups),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
        place, same = F.col("_place") + 1, F.col("_part") == F.col("_in")
        if groups:
            here = Window.partitionBy("_part", *groups).orderBy("_place")
            numbered = numbered.withColumn("_here", F.row_number().over(here))
            place = F.col("_here")
            for group in groups:
                same = same & F.col(group).eqNullSafe(F.col(f"_group_{group}"))
        else:
            # Bounded by the shuffle width.
            starts = F.broadcast(starts)
        numbered = numbered.join(starts, same).withColumn(name, F.col("_start") + place)
        numbered = numbered.drop("_in", "_start", "_here", *(f"_group_{group}" for group in groups))
    return numbered.select(*df.columns, *names)
