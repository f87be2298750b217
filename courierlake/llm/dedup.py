"""Near duplicates by MinHash, confirmed on full shingle sets, as connected components.

1. Every text gets the minima of `MINIMA` universal hashes over its shingles.
   Texts of equal words share one node, whatever their number.
2. Bands of minima put nodes into buckets. In a bucket of two, the pair is
   compared; in a larger one, each node is compared with one other, the bucket's
   smallest node whose signature (one bit per minimum) is nearest to its own.
3. Links become components by alternating large-star and small-star.
4. Larger buckets that still hold several components compare all pairs between
   them, in blocks of nodes and inside tasks, which write out no more than the
   links that join components. Pairs inside a component need no comparison, as
   only components count.

No bucket is written out as all its pairs, and no pair between different
components of a bucket is left out. Steps 2 and 4 compare 32-bit shingles,
which can only overstate an intersection; every link is then confirmed on sets
of 64-bit shingles. Should one fail, the steps are repeated with those sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import fold_bytes, id_and_text, stored, with_number_id
from courierlake.session import setting

# 20 bands of 4 minima: a pair at similarity 0.8 is missed with probability
# (1 - 0.8^4)^20 = 3e-5, one at 0.85 with 4e-7. 96 minima verify.
MINIMA, BANDS, ROWS = 96, 20, 4
# Bits of the signatures of a pair that may differ. At similarity 0.8 a bit differs with
# probability 0.1; 29 of 96 lie 6.6 standard deviations above the mean.
MOST_BITS = 29
SKETCH_HALF = MINIMA // 2
# Nodes of a bucket in one block; a task compares two blocks.
BLOCK = 256
# Columns of a block comparison at once.
COLUMNS_AT_ONCE = 1 << 12
# Bits of the map of nodes with candidates: 2 MB, whatever the input.
NODE_BITS = 1 << 24
SHINGLES_AT_ONCE = 1 << 13

_RANDOM = np.random.default_rng(20240229)
MULTIPLIERS = _RANDOM.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RANDOM.integers(0, 2**63, MINIMA, dtype=np.uint64)
WORD_MIX = tuple(np.uint64(int(x) * 2 + 1) for x in _RANDOM.integers(1, 2**62, 64))

SIGNATURES = "doc_id string, n_shingles bigint, node bigint, s1 bigint, s2 bigint, bands array<bigint>"


class _WordHashes(dict):
    """Hashes of words, remembered for the frequent ones (those seen first)."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 500_000:
            self[word] = value
        return value


_WORDS = _WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; bytes.split parts at exactly the ASCII white space."""
    return fold_bytes(text).split()


def node_of(words: list[bytes]) -> int:
    """64-bit name of a word sequence; sequences without words have none (0)."""
    value = xxhash.xxh3_64_intdigest(b" ".join(words)) or 1 if words else 0
    return value - (1 << 64) if value >> 63 else value


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the `width`-word shingles.

    Fewer words than `width` make one shingle, none an empty set.
    """
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    count = len(words) - width + 1
    mixed = np.zeros(count, np.uint64)
    for i in range(width):
        mixed = (mixed ^ hashes[i : i + count]) * WORD_MIX[i]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minima of the hashes a * x + b (upper 32 bits), a bounded block of shingles at a time."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), SHINGLES_AT_ONCE):
        block = shingles[at : at + SHINGLES_AT_ONCE]
        for i in range(MINIMA):
            low = (block * MULTIPLIERS[i] + OFFSETS[i]).min()
            if low < least[i]:
                least[i] = low
    return (least >> np.uint64(32)).astype(np.uint32)


def _as_signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def band_keys(least: np.ndarray) -> list[int]:
    """One 64-bit key per band, which also tells the bands apart."""
    return [
        _as_signed(xxhash.xxh3_64_intdigest(least[i * ROWS : (i + 1) * ROWS].tobytes(), seed=i))
        for i in range(BANDS)
    ]


def sketch(least: np.ndarray) -> tuple[int, int]:
    """One bit of each minimum, in two longs."""
    bits = (least.view(np.uint32) * np.uint32(2654435761) >> np.uint32(31)).astype(np.int64)
    powers = np.int64(1) << np.arange(SKETCH_HALF, dtype=np.int64)
    return int((bits[:SKETCH_HALF] * powers).sum()), int((bits[SKETCH_HALF:] * powers).sum())


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Per document: size of its set, node, signature and band keys."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, seen = [], {}
            for doc, text in zip(batch["doc_id"], batch["text"]):
                words = words_of(text)
                node = node_of(words)
                if node not in seen:
                    shingles = shingle_set(words, width)
                    if len(shingles):
                        least = minima(shingles)
                        seen[node] = (len(shingles), node, *sketch(least), band_keys(least))
                    else:
                        seen[node] = (0, None, 0, 0, [])
                rows.append((doc, *seen[node]))
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "node", "s1", "s2", "bands"])
            # Exact, where inference would make doubles of names beside NULLs.
            out["node"] = pd.array([row[2] for row in rows], "Int64")
            yield out

    return with_number_id(id_and_text(docs).mapInPandas(sign, SIGNATURES))


def node_map(nodes: DataFrame) -> np.ndarray:
    """A bit per node modulo `NODE_BITS`; what reaches the driver is bounded by that."""
    bit = F.pmod("node", F.lit(NODE_BITS))
    words = (
        nodes.select(F.shiftright(bit, 5).alias("at"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(32)).cast("int")).alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
    )
    table = np.zeros(NODE_BITS // 32, np.uint32)
    found = words.toPandas()
    table[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return table


def full_sets(docs: DataFrame, nodes: DataFrame, width: int, exact: bool) -> DataFrame:
    """node, n_shingles, shingles (sorted distinct hashes as bytes), for at least the given nodes.

    64-bit hashes if `exact`, else their upper 32 bits. The map of nodes only
    spares work: it lets through every node asked for.
    """
    shared = docs.sparkSession.sparkContext.broadcast(node_map(nodes))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for batch in batches:
            found = {}
            for text in batch["text"]:
                words = words_of(text)
                node = node_of(words)
                bit = node % NODE_BITS
                if words and node not in found and table[bit >> 5] >> np.uint32(bit & 31) & 1:
                    full = shingle_set(words, width)
                    short = full if exact else np.unique((full >> np.uint64(32)).astype(np.uint32))
                    found[node] = (node, len(full), short.tobytes())
            out = pd.DataFrame(list(found.values()), columns=["node", "n_shingles", "shingles"])
            yield out.astype({"node": "int64", "n_shingles": "int64"})

    built = docs.select("text").mapInPandas(build, "node bigint, n_shingles bigint, shingles binary")
    return stored(built.dropDuplicates(["node"]), "shingle-sets")


def _most_shared(x: np.ndarray, n: int, y: np.ndarray, m: int, shared: int) -> int:
    """The largest intersection that sets of n and m shingles can have, given the hashes they share."""
    return min(shared + max(n - len(x), m - len(y)), n, m)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, exact: bool) -> DataFrame:
    """The pairs (a, b) whose sets (may) have 100 * intersection >= percent * union."""
    kind = np.uint64 if exact else np.uint32

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for left, n, right, m in zip(batch["left"], batch["n"], batch["right"], batch["m"]):
                x, y = np.frombuffer(left, kind), np.frombuffer(right, kind)
                shared = _most_shared(x, n, y, m, len(np.intersect1d(x, y, assume_unique=True)))
                keep.append(100 * shared >= percent * (n + m - shared))
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("n_shingles").alias("n"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("n_shingles").alias("m"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", "n", "m", "left", "right").mapInPandas(compare, "a bigint, b bigint")


def block_links(members: pd.DataFrame, percent: int, kind: type) -> list[tuple[int, int]]:
    """Links between different roots of two blocks, enough to join what is joined.

    `members`: node, root, block, n_shingles, shingles. Intersections come from
    the product of 0/1 matrices over the shingles that more than one member has.
    """
    members = members.sort_values(["block", "node"])
    sets = [np.frombuffer(x, kind) for x in members["shingles"]]
    n = members["n_shingles"].to_numpy()
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = times[column] > 1
    column, owner = column[common], owner[common]
    at = 0
    while at < len(column):
        upto = np.searchsorted(column, column[at] + COLUMNS_AT_ONCE)
        dense = np.zeros((len(sets), COLUMNS_AT_ONCE), np.float32)
        dense[owner[at:upto], column[at:upto] - column[at]] = 1
        shared += dense @ dense.T
        at = upto
    slack = n - np.array([len(x) for x in sets])
    most = np.minimum(shared + np.maximum(slack[:, None], slack[None, :]), np.minimum(n[:, None], n[None, :]))
    linked = 100 * most >= percent * (n[:, None] + n[None, :] - most)
    roots, block = members["root"].to_numpy(), members["block"].to_numpy()
    linked &= roots[:, None] != roots[None, :]
    if block[0] != block[-1]:
        linked &= block[:, None] != block[None, :]
    names: dict[int, int] = {}

    def top(x: int) -> int:
        while names.get(x, x) != x:
            x = names[x]
        return x

    nodes, found = members["node"].to_numpy(), []
    for i, j in zip(*np.nonzero(np.triu(linked))):
        x, y = top(int(roots[i])), top(int(roots[j]))
        if x != y:
            names[max(x, y)] = min(x, y)
            found.append((int(nodes[i]), int(nodes[j])))
    return found


def blocked(entries: DataFrame, sets: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Links (a, b) between the roots of each band's members, in blocks.

    `entries`: band, node, root, members. A bucket of m members has
    ceil(m / BLOCK) blocks, and each pair of blocks is a group of its own.
    """
    kind = np.uint64 if exact else np.uint32

    def compare(_: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(block_links(group, percent, kind), columns=["a", "b"]).astype("int64")

    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = entries.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    ready = placed.select(
        "band",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "node",
        "root",
    ).join(sets, "node")
    return ready.groupBy("band", "low", "high").applyInPandas(compare, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of `edges` (a, b).

    Large-star ties the larger neighbours of each node to the smallest one,
    small-star the smaller ones; both keep components and end in stars. The
    minima are written tables, so that Spark can split the join of a node with
    very many neighbours.
    """

    def turned(x: Column, y: Column) -> list[Column]:
        return [F.greatest(x, y).alias("u"), F.least(x, y).alias("v")]

    def measure(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 24))).first()
        return tuple(row)

    a, b = F.col("a"), F.col("b")
    current = stored(edges.where(a != b).select(*turned(a, b)).distinct(), "edges")
    before = measure(current)
    while before[0]:
        u, v = F.col("u"), F.col("v")
        ways = current.select("u", "v").union(current.select(v.alias("u"), u.alias("v")))
        least = stored(ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star")
        large = ways.join(least, "u").where((v > u) & (v != F.col("m"))).select(*turned(v, F.col("m")))
        current = stored(large.distinct(), "edges")
        least = stored(current.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        moved = current.join(least, "u").where(v != F.col("m")).select(*turned(v, F.col("m")))
        current = stored(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = measure(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stored(current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots), "roots")


def _differing(left: str, right: str) -> Column:
    """Bits of the signatures that differ."""
    return sum(
        (F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))) for s in ("s1", "s2")), F.lit(0)
    )


def _alike(left: str, right: str, percent: int) -> Column:
    """Sizes and signatures that a pair at the threshold has."""
    n, m = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (_differing(left, right) <= MOST_BITS)


def _links(docs: DataFrame, signed: DataFrame, width: int, percent: int, exact: bool = False) -> DataFrame:
    """node, root of all nodes with a confirmed link."""
    narrow = ["node", "n_shingles", "s1", "s2"]
    nodes = stored(signed.where("n_shingles > 0").dropDuplicates(["node"]).select(*narrow, "bands"), "nodes")
    banded = nodes.select("node", F.explode("bands").alias("band"))
    buckets = stored(
        banded.groupBy("band")
        .agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("pivot"))
        .where("members > 1"),
        "buckets",
    )
    entries = stored(banded.join(buckets, "band"), "bucket-entries")
    sets = full_sets(docs, entries.select("node"), width, exact)

    # Pairs of a bucket's smallest node and another; of large buckets, the nearest one per node.
    small = F.col("members") == 2
    stars = entries.where("node != pivot").groupBy(F.col("pivot").alias("a"), F.col("node").alias("b"))
    stars = stars.agg(F.max(small).alias("small")).alias("p")
    stars = stars.join(nodes.alias("l"), F.col("p.a") == F.col("l.node"))
    stars = stars.join(nodes.alias("r"), F.col("p.b") == F.col("r.node"))
    alike = stars.where(_alike("l", "r", percent)).select("p.a", "p.b", "p.small", _differing("l", "r").alias("bits"))
    alike = stored(alike, "stars")
    nearest = alike.where("NOT small").groupBy("b").agg(F.min(F.struct("bits", "a")).alias("best"))
    pairs = alike.where("small").select("a", "b").union(nearest.select("best.a", "b"))
    links = stored(confirmed(pairs, sets, percent, exact), "links")
    roots = components(links)

    # What is open: pairs of different components in buckets of more than two.
    placed = entries.where("members > 2").join(roots, "node", "left")
    placed = stored(placed.select("band", "node", "members", F.coalesce("root", "node").alias("root")), "placed")
    mixed = placed.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    mixed = stored(mixed.where("least < most").select("band"), "open-buckets")
    found = stored(blocked(placed.join(mixed, "band"), sets, percent, exact).distinct(), "links")
    links = links.union(found)
    if not exact:
        links = stored(links.distinct(), "links")
        ends = links.select(F.col("a").alias("node")).union(links.select("b"))
        sure = stored(confirmed(links, full_sets(docs, ends, width, True), percent, True), "links")
        if sure.count() != links.count():
            return _links(docs, signed, width, percent, exact=True)
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component) of every row.

    Documents are linked if their sets of `width`-word shingles overlap by
    `percent` of their union or more. NULL and empty texts and texts without
    words have no shingles and stay alone. Repeated rows and texts share a
    component; a NULL id never becomes a component's id unless there is no
    other. Extra columns of `docs` are ignored.
    """
    # Rows carry whole shingle sets: a few hundred at a time fit a Python worker.
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "400"):
        signed = stored(signatures(docs, width), "signatures")
        roots = _links(docs, signed, width, percent)
    named = signed.where("node IS NOT NULL").select("doc_id", "node")
    least = stored(
        named.groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "node-ids"
    )
    grouped = least.join(roots, "node")
    of_root = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = stored(roots.join(of_root, "root").select("node", "component_id"), "component-ids")
    alone = least.join(linked, "node", "left_anti").where("copies > 1")
    ids = stored(linked.union(alone.select("node", "least")), "component-ids")
    rows = signed.select("doc_id", "n_shingles", "node")
    with_words = rows.where("node IS NOT NULL").join(ids, "node", "left")
    without = rows.where("node IS NULL").withColumn("component_id", F.lit(None).cast("bigint"))
    return with_words.unionByName(without).select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def first_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each near-duplicate component of `docs`, all its columns.

    The row with the component's id stays; of rows that repeat id and text, one.
    Rows without an id can't be told apart and stay as they are.
    """
    found = near_duplicates(docs, width, percent)
    ids = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_kept")).distinct()
    named = docs.where(F.col("doc_id").isNotNull())
    kept = named.join(stored(ids, "kept-ids"), F.col("doc_id") == F.col("_kept"), "left_semi")
    again = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    once = kept.withColumn("_again", F.row_number().over(again)).where(F.col("_again") == 1).drop("_again")
    return once.unionByName(docs.where(F.col("doc_id").isNull()))
