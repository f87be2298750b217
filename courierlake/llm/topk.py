"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A code of 64 bits is cut into m segments. If all segments are searched with
radius s, every code within m * (s + 1) - 1 differing bits has been met, as it
differs in at most s bits in some segment. The radius grows until that bound
covers the kth verified distance of a query; only queries not covered yet take
part in the next round.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import stored

BITS = 64


def sign_code(vector: Column) -> Column:
    """The signs of up to 64 numbers as a long; NULL and NaN count as negative."""
    bits = F.transform(
        vector,
        lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")),
    )
    code = F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    fits = F.size(vector) <= BITS
    return F.when(vector.isNull(), F.lit(None)).when(fits, code).otherwise(
        F.raise_error(F.lit(f"vectors of more than {BITS} numbers need several codes")).cast("bigint")
    )


def segment_count(codes: int) -> int:
    """Segments whose number of values is about the number of codes."""
    return max(2, min(8, round(BITS / max(math.log2(max(codes, 2)), 8))))


def segments_of(m: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    cuts = [round(i * BITS / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _masks(bits: int, radius: int) -> list[int]:
    return [sum(1 << i for i in at) for r in range(radius + 1) for at in combinations(range(bits), r)]


def _segment(code: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << bits) - 1))


def _ball(number: int, first: int, bits: int, radius: int) -> Column:
    """All (segment, value) within the radius of the query's own segment value."""
    value = _segment(F.col("query_code"), first, bits)
    # One literal, however many masks there are.
    text = ",".join(map(str, _masks(bits, min(radius, bits))))
    masks = F.split(F.lit(text), ",").cast("array<bigint>")
    return F.transform(
        masks, lambda x: F.struct(F.lit(number).alias("segment"), value.bitwiseXOR(x).alias("value"))
    )


def nearest(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, neighbor_id, distance, rank: the k nearest points of every query.

    Both tables have `id` and `code`. Ties go to the smaller id, a query is not
    its own neighbour, rows with a NULL id or code are left out, repeated ids
    count once. Fewer than k points give fewer rows.

    Equal codes are one entry of the index. An entry keeps its k + 1 smallest
    ids, as no others can be among the k nearest.
    """
    clean = points.where(F.col("id").isNotNull() & F.col("code").isNotNull()).select("id", "code").distinct()
    by_code = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    members = stored(clean.withColumn("_n", by_code).where(F.col("_n") <= k + 1).drop("_n"), "members")
    entries = stored(members.groupBy("code").agg(F.count(F.lit(1)).alias("ids")), "codes")
    segments = segments_of(segment_count(entries.count()))
    index = entries.select(
        "code", "ids", F.posexplode(F.array(*(_segment(F.col("code"), a, n) for a, n in segments))).alias("segment", "value")
    )
    index = stored(index, "segments")
    open_ = stored(
        queries.where(F.col("id").isNotNull() & F.col("code").isNotNull())
        .select(F.col("id").alias("query_id"), F.col("code").alias("query_code"))
        .distinct(),
        "queries",
    )
    done = []
    for radius in range(max(n for _, n in segments) + 1):
        bound = len(segments) * (radius + 1) - 1
        last = bound >= BITS
        probes = F.concat(*(_ball(i, a, n, radius) for i, (a, n) in enumerate(segments)))
        probed = open_.withColumn("p", F.explode(probes)).select("query_id", "query_code", "p.segment", "p.value")
        distance = F.bit_count(F.col("query_code").bitwiseXOR(F.col("code")))
        # Probes are many for few queries: a size guessed before they are written
        # out would have Spark broadcast them.
        met = probed.hint("merge").join(
            index.alias("i"),
            (probed["segment"] == F.col("i.segment")) & (probed["value"] == F.col("i.value")) & (distance <= bound),
        )
        met = met.select("query_id", "query_code", "code", "ids", distance.alias("distance")).distinct()
        met = stored(met, "met")
        enough = met.groupBy("query_id", "query_code").agg(F.sum("ids").alias("ids")).where(F.col("ids") > k)
        if last:
            done.append(met)
            break
        done.append(met.join(enough.select("query_id", "query_code"), ["query_id", "query_code"], "left_semi"))
        open_ = stored(open_.join(enough, ["query_id", "query_code"], "left_anti"), "queries")
        if open_.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("query_id", "query_code").orderBy("distance", "neighbor_id")
    ranked = (
        found.join(members.withColumnRenamed("id", "neighbor_id"), "code")
        .where(F.col("neighbor_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )
    return ranked.select("query_id", "neighbor_id", F.col("distance").cast("int").alias("distance"), "rank")
