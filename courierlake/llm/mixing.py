"""Mixing sources to target weights by capped water-filling.

Each source has a weight. The total is shared in proportion to the weights;
a source whose share exceeds `max_epochs` times its size is clamped there and
what it can't take is shared among the others, until no source exceeds its
clamp. Documents are then repeated whole, and once more for a seeded part of
the source.

Only column expressions run here. The texts themselves are never shuffled: what
decides about a row is its own key and one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import stored
from courierlake.operators.ranking import add_row_numbers

# A source's seeded order is cut into this many ranges, so that the running sums
# of a source that holds most rows are spread over tasks.
ORDER_RANGES = 1024
_RANGE_SHIFT = 63 - 10
_POSITIVE = (1 << 63) - 1


def water_fill(sources: DataFrame, total: float | None = None, max_epochs: float = 3.0) -> DataFrame:
    """Add `target` to one row per source with `source_size` and `weight`.

    `total` defaults to the sum of all sizes. If even all clamps together stay
    below `total`, each source gets its clamp. Each round is one aggregate of
    three numbers; a round clamps at least one source, in practice about half
    of those still to be clamped.
    """
    # The level is the target per unit of weight; sources with cap / weight
    # below it are clamped. Raising it never frees a clamped source.
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        free = F.when(~full, F.col("weight")).otherwise(F.lit(0.0))
        now = sources.agg(
            F.sum(F.when(full, cap).otherwise(F.lit(0.0))).alias("taken"),
            F.sum(free).alias("weight"),
            F.sum(F.when(full, 1).otherwise(0)).alias("clamped"),
            F.sum("source_size").alias("size"),
        ).first()
        if not now["weight"] or now["clamped"] == clamped:
            break
        clamped = now["clamped"]
        budget = float(now["size"] or 0) if total is None else float(total)
        level = (budget - now["taken"]) / now["weight"]
    share = F.col("weight") * F.lit(level if level is not None else 0.0)
    return sources.withColumn("target", F.least(share, cap))


def cycle_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Add `weight`: `weights`, repeated, over the sources by code point, NULL last.

    Sources are numbered by a range sort, so no task needs to see them all.
    """
    order = [F.col("source").asc_nulls_last()]
    numbered = add_row_numbers(sources, {"_place": ([], order)})
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    at = F.pmod(F.col("_place") - 1, F.lit(len(weights))).cast("int")
    return numbered.withColumn("weight", F.get(cycle, at)).drop("_place")


def source_targets(
    sized: DataFrame, weights: Sequence[float], total: float | None = None, max_epochs: float = 3.0
) -> DataFrame:
    """One row per `source` of `sized` (`source`, `size`): size, weight, target."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stored(cycle_weights(sources, weights), "mix-sources")
    return stored(water_fill(sources, total, max_epochs), "mix-targets")


def order_key(columns: Sequence[str], seed: int) -> Column:
    """Place of a row in its source's seeded order, from 0 to 2^63 - 1."""
    return F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit(_POSITIVE))


def source_cuts(sized: DataFrame, targets: DataFrame, order: Sequence[str], seed: int = 0) -> DataFrame:
    """Per source: how often all its rows are taken, and up to which key once more.

    A source with target t and size s is taken whole floor(t / s) times. For
    the rest, its rows stand in a seeded order, and those whose middle lies
    within the remaining part are taken once more: the source misses its
    target by less than half of one row, or of the rows that share a key.
    Running sums go over ranges of the order, so no task sees a whole source.
    Returns `cut_source`, `source_size`, `target`, `whole`, `cut`.
    """
    keyed = sized.select("source", "size", order_key(order, seed).alias("key"))
    # Equal keys stand for equal rows, which are taken together.
    keyed = keyed.groupBy("source", "key").agg(F.sum("size").alias("size"))
    keyed = keyed.withColumn("range", F.shiftright("key", _RANGE_SHIFT).cast("int"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # At most ORDER_RANGES rows per source.
    starts = keyed.groupBy("source", "range").agg(F.sum("size").alias("_in"))
    starts = starts.withColumn("start", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    starts = starts.select(F.col("source").alias("_source"), F.col("range").alias("_range"), "start")
    goals = targets.select(F.col("source").alias("cut_source"), "source_size", "target")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.withColumn("whole", F.floor(epochs).cast("bigint"))
    inside = Window.partitionBy("source", "range").orderBy("key")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = keyed.withColumn("_upto", F.sum("size").over(running)).join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range"))
    )
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    middle = F.col("start") + F.col("_upto") - F.col("size") / 2
    within = placed.join(goals, F.col("source").eqNullSafe(F.col("cut_source"))).where((middle <= rest) & (rest > 0))
    cuts = within.groupBy("source").agg(F.max("key").alias("cut"))
    joined = goals.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    return stored(joined.drop("source").withColumn("cut", F.coalesce("cut", F.lit(-1))), "mix-cuts")


def with_repetitions(
    rows: DataFrame, sized: DataFrame, weights: Sequence[float], order: Sequence[str], seed: int = 0,
    total: float | None = None, max_epochs: float = 3.0,
) -> DataFrame:
    """`rows` with `source_size`, `target` and `repeats`.

    `sized` has `source`, `size` and the columns of `order`, as has `rows`; rows
    equal in all of `order` are taken alike. Rows of NULL source are a source of
    their own. Empty rows (size 0) are repeated with their source but count for
    nothing.
    """
    targets = source_targets(sized, weights, total, max_epochs)
    cuts = source_cuts(sized, targets, order, seed)
    joined = rows.join(cuts, rows["source"].eqNullSafe(F.col("cut_source")))
    repeats = F.col("whole") + F.when(order_key(order, seed) <= F.col("cut"), 1).otherwise(0)
    return joined.withColumn("repeats", repeats.cast("bigint")).drop("cut_source", "whole", "cut")


def repeat_rows(df: DataFrame, repeats: Column) -> DataFrame:
    """Every row of `df` as often as `repeats` says; rows with 0 go."""
    times = F.sequence(F.lit(1).cast("bigint"), F.greatest(repeats, F.lit(1).cast("bigint")))
    return df.where(repeats > 0).withColumn("_copy", F.explode(times)).drop("_copy")
