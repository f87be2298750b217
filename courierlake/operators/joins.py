"""Joins that stay balanced when one key holds a large share of either side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """`left` LEFT JOIN `right` on `key` where `right` repeats keys.

    A left outer join can split a hot key only on its left side, as the right
    side must be seen whole to know what stays unmatched. Written as the
    matches plus the rows without a match, the inner join can split both sides
    and the anti join sees each right key once.
    """
    matched = left.join(right, key, "inner")
    keys = right.select(key).where(F.col(key).isNotNull()).distinct()
    unmatched = left.join(keys, key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def flag_orphans(events: DataFrame, orders: DataFrame | None) -> DataFrame:
    """Add `_dq_orphan_order`: the event's order is not among `orders`.

    NULL order ids get a NULL flag. Without an order table nothing is flagged.
    The distinct ids are joined, never collected, whatever their number.
    """
    if orders is None:
        return events.withColumn("_dq_orphan_order", F.lit(False))
    known = (
        orders.select("order_id")
        .where(F.col("order_id").isNotNull())
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    orphan = F.when(F.col("order_id").isNotNull(), F.col("_known").isNull())
    return (
        events.join(known, "order_id", "left")
        .withColumn("_dq_orphan_order", orphan)
        .drop("_known")
    )


def unknown_ids(events: DataFrame, orders: DataFrame) -> DataFrame:
    """The order ids of events that `orders` lacks, each once and never NULL."""
    ids = events.select("order_id").where(F.col("order_id").isNotNull()).distinct()
    return ids.join(orders.select("order_id").distinct(), "order_id", "left_anti")


def flag_unknown(events: DataFrame, unknown: DataFrame) -> DataFrame:
    """As :func:`flag_orphans`, from the stored `unknown_ids`.

    Ids are shuffled instead of events: what is stored has a size, so a few
    unknown ids are broadcast, and many are joined.
    """
    found = unknown.withColumn("_unknown", F.lit(True))
    orphan = F.when(F.col("order_id").isNotNull(), F.col("_unknown").isNotNull())
    return (
        events.join(found, "order_id", "left")
        .withColumn("_dq_orphan_order", orphan)
        .drop("_unknown")
    )


def orphan_events(events: DataFrame, orders: DataFrame) -> DataFrame:
    """The events whose order id is set but unknown."""
    return events.where(F.col("order_id").isNotNull()).join(
        orders.select("order_id"), "order_id", "left_anti"
    )
