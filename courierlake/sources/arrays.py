"""JSON array files read by many tasks.

Spark cuts a file into byte ranges if it knows where records may end. Here a
record ends at every closing brace; pieces of an object are put together again.
Whether a brace closes an object depends on what stands before it: is it inside
a string, and how deep. Each range is summed up for either case first; chaining
the few sums of a file gives the state in which each of its ranges starts. Then
every range is read with that state, and only what spans two ranges is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.session import scratch_path, stored_bytes

BRACE = "}"
# Byte ranges may be small and many. A task takes as many as hold this much, as
# long as there are tasks enough for all cores.
BYTES_PER_TASK = 32 * 1024**2
TASKS_PER_CORE = 4
# A whole string, the rest of an open one, and a backslash that escapes the brace after the piece.
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.DOTALL)
_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
# What may stand between the objects of an array.
BETWEEN = r"^[\[\],\s\uFEFF]+"

State = tuple[bool, int]


def after(piece: str, state: State) -> State:
    """Inside a string, and the depth, before the brace that follows `piece`."""
    inside, depth = state
    at = 0
    if inside:
        rest = _REST.match(piece)
        if not rest:
            return True, depth
        at = rest.end()
    plain = _STRING.sub("", piece[at:])
    opened = plain.find('"')
    if opened >= 0:
        return True, depth + plain.count("{", 0, opened)
    return False, depth + plain.count("{")


def closed(state: State) -> State:
    """The state behind the brace."""
    inside, depth = state
    return (inside, depth) if inside else (False, depth - 1)


def _tasks(spark: SparkSession, path: str) -> int:
    """Tasks that read what is below `path`, unless it has fewer ranges."""
    wanted = -(-stored_bytes(spark, path) // BYTES_PER_TASK)
    return max(wanted, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, its size, start (of the byte range), text up to the next brace; in order within a range."""
    read = spark.read.option("lineSep", BRACE).text(path).coalesce(_tasks(spark, path))
    return read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def range_effects(pieces: DataFrame) -> DataFrame:
    """What each range does to a state outside (0) and inside (1) a string.

    file, size, start, bytes with a brace per piece, and per case: inside a
    string at the end, the change of depth, and the lowest change on the way,
    which tells whether an object that was open at the start was closed.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges: dict[tuple[str, int, int], list[list]] = {}
        for batch in batches:
            for file, size, start, piece in zip(*(batch[c] for c in ("file", "size", "start", "value"))):
                sums = ranges.setdefault((file, size, start), [[0], [(False, 0), 0], [(True, 0), 0]])
                sums[0][0] += len(piece.encode("utf-8", "replace")) + 1
                for case in sums[1:]:
                    case[0] = closed(after(piece, case[0]))
                    if not case[0][0]:
                        case[1] = min(case[1], case[0][1])
        rows = [(*place, n, *a, low_a, *b, low_b) for place, ((n,), (a, low_a), (b, low_b)) in ranges.items()]
        names = ("file", "size", "start", "bytes", "inside_0", "depth_0", "low_0", "inside_1", "depth_1", "low_1")
        yield pd.DataFrame(rows, columns=list(names))

    schema = (
        "file string, size bigint, start bigint, bytes bigint, inside_0 boolean, depth_0 bigint, low_0 bigint, "
        "inside_1 boolean, depth_1 bigint, low_1 bigint"
    )
    return pieces.mapInPandas(sums, schema)


def range_states(effects: DataFrame) -> dict[tuple[str, int], tuple[State, int]]:
    """The state at the start of every range but a file's first, and the range
    in which the object that is open there began.

    One entry per range of the files that need more than one task.
    """
    several = effects.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("file")
    found: dict[tuple[str, int], tuple[State, int]] = {}
    file, state, origin = None, (False, 0), 0
    for row in effects.join(several, "file", "left_semi").orderBy("file", "start").collect():
        if row.file == file:
            if state == (False, 0):
                origin = row.start
            found[row.file, row.start] = (state, origin)
        else:
            file, state, origin = row.file, (False, 0), row.start
        inside, depth, low = (
            (row.inside_1, row.depth_1, row.low_1) if state[0] else (row.inside_0, row.depth_0, row.low_0)
        )
        if state[1] + low <= 0:
            origin = row.start
        state = (inside, state[1] + depth)
    return found


def _cut(pieces: DataFrame, states: dict[tuple[str, int], tuple[State, int]]) -> DataFrame:
    """file, origin, start, part, last, text: a `whole` object, the `end` of one that
    began in an earlier range, or what is `open` at the end of a range."""
    shared = pieces.sparkSession.sparkContext.broadcast(states)
    columns = ["file", "origin", "start", "part", "last", "text"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here: tuple[str, int] | None = None
        state: State = (False, 0)
        origin, held, continued = 0, [], False
        # Held back until it is known whether the range goes on.
        ready: list | None = None
        for batch in batches:
            rows: list[list] = []
            for file, start, piece in zip(batch["file"], batch["start"], batch["value"]):
                if (file, start) != here:
                    if held:
                        rows += [[here[0], origin, here[1], "open", True, "".join(held)]]
                    elif ready:
                        ready[4] = True
                    here, held = (file, start), []
                    state, origin = shared.value.get(here, ((False, 0), start))
                    continued = state != (False, 0)
                if ready:
                    rows.append(ready)
                    ready = None
                state = closed(after(piece, state))
                held.append(piece + BRACE)
                if state == (False, 0):
                    ready = [file, origin, start, "end" if continued else "whole", False, "".join(held)]
                    origin, held, continued = start, [], False
            yield pd.DataFrame(rows, columns=columns)
        if held:
            ready = [here[0], origin, here[1], "open", True, "".join(held)]
        elif ready:
            ready[4] = True
        yield pd.DataFrame([ready] if ready else [], columns=columns)

    return pieces.mapInPandas(read, "file string, origin bigint, start bigint, part string, last boolean, text string")


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """file, text: the top-level objects of the JSON files below `path`, as text.

    Commas and brackets between objects are dropped. Anything else there stays
    in front of the next object, and what a file holds after its last object, or
    an object that isn't closed, makes a record of its own: the parser will call
    these corrupt. Ranges are cut by `spark.sql.files.maxPartitionBytes`, and
    small ones share a task; files must not be compressed. Only objects that span ranges are shuffled; one
    object fits a task.
    """
    pieces = _pieces(spark, path)
    effects = stored(range_effects(pieces), "ranges")
    parts = stored(_cut(pieces, range_states(effects)), "objects")
    # A file that doesn't end with a brace was given one too many.
    ends = (
        effects.groupBy("file")
        .agg(F.max("start").alias("start"), F.sum("bytes").alias("bytes"), F.max("size").alias("size"))
        .where("bytes <> size")
        .select("file", "start", F.lit(True).alias("_added"))
    )
    final = parts.where("last").join(ends, ["file", "start"], "left")
    final = final.withColumn("text", F.when(F.col("_added"), F.expr("left(text, char_length(text) - 1)")).otherwise(F.col("text")))
    parts = parts.where("NOT last").unionByName(final.select(*parts.columns))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda part: part["text"])
    spanning = parts.where("part <> 'whole'").groupBy("file", "origin").agg(F.array_join(ordered, "").alias("text"))
    found = parts.where("part = 'whole'").select("file", "text").unionByName(spanning.select("file", "text"))
    return found.withColumn("text", F.regexp_replace("text", BETWEEN, "")).where("text <> ''")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once below the shared folder: it is read several times."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).coalesce(_tasks(spark, path))
