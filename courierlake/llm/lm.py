"""Language model scores from a probabilistic suffix tree.

The symbols are words. The tree holds contexts of one and two words (the start
of a text counts as one) that are frequent and whose next words differ from
those after their suffix by more than chance. A word is scored by the longest
suffix of what precedes it that the tree holds: the state's own counts, and what
these leave over by the word's probability under the state's suffix, so that the
words after a state share one. The empty context has all words of the training
texts; unseen words share what Good and Turing leave them, by their spelling,
which a second suffix tree over bytes scores.

Successions of words are listed from a fixed count on, so the tree grows with
the input. They are counted in stages: a pair can only be listed if both its
words are as frequent, two words before a third only if both pairs are listed.
Tables of bits tell a task what may be listed; what they let through in vain is
dropped once it is summed. The tree is written as terms that add up (see
`tree_terms`); the frequent ones are broadcast, and each text sends what else may
be in the table there to be looked up, as it does with its rarer words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from courierlake.llm.common import fold_bytes, id_and_text, label_fold, stored, with_number_id
from courierlake.llm.phrases import MOST_PARTITIONS, Bits, bits_of, bucket_of
from courierlake.session import setting

# Bytes of context, counting the mark of a word's start.
DEPTH = 7
LEAST_SHARE, LEAST_COUNT = 1e-5, 20
# Symbols: bytes of words, the space that ends a word, the newline that ends a text.
SYMBOLS = 256
# Successions of words are listed from this count on.
LEAST_PAIRS = 4
# Terms of the tree that are broadcast, at most; a table of bits, of bounded
# size, tells which keys may be among them or the others.
HOT_TERMS = 1_000_000
START_NAME, END_NAME = 1, 0
# Words that are broadcast, the most frequent ones, and the bits of their
# numbers in a code; the others are joined.
HOT_WORDS, ID_BITS = 200_000, 20
# Successions after which a task counts what it has, rows it sends at once, texts it cuts
# at once, and texts on either side of its pipe.
GATHERED, SENT, AT_ONCE, BATCH_ROWS = 1_000_000, 100_000, 200, 1_000
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Occurrences of successions per bucket, buckets per task, one after the other, and packed rows
# on either side of its pipe.
BUCKET, TASK_BUCKETS, PACKED_ROWS = 300_000, 8, 200
CACHED_RUNS = 300_000
# Different words a counting task holds before it writes them out.
HELD_WORDS = 150_000
# Texts that a task remembers to have sent to be looked up.
SEEN_TEXTS = 200_000


def name_of(word: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: how often the words of `docs` occur."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out() -> pd.DataFrame:
            return pd.DataFrame({"word": list(held), "n": list(held.values())}).astype({"n": "int64"})

        held: Counter = Counter()
        for batch in batches:
            for at in range(0, len(batch), 500):
                for text in batch["text"].iloc[at : at + 500]:
                    held.update(fold_bytes(text).split())
                if len(held) > HELD_WORDS:
                    yield out()
                    held = Counter()
        yield out()

    counted = docs.select("text").mapInPandas(count, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def context_counts(words: DataFrame, depths: list[int], parents: np.ndarray | None) -> DataFrame:
    """depth, context, symbol, n over weighted words (word, n).

    A context is the number that its bytes spell. With `parents`, sorted
    numbers, only contexts whose suffix (one byte less) is among them count.
    """
    shared = words.sparkSession.sparkContext.broadcast(parents)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            spelled = [b" " + w + b" " for w in batch["word"]]
            sizes = np.array([len(s) for s in spelled], dtype=np.int64)
            data = np.frombuffer(b"".join(spelled), np.uint8).astype(np.uint64)
            place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            weight = np.repeat(batch["n"].to_numpy(np.float64), sizes)
            for depth in depths:
                at = np.flatnonzero(place >= max(depth, 1))
                context = np.zeros(len(at), np.uint64)
                for back in range(depth, 0, -1):
                    context = (context << np.uint64(8)) | data[at - back]
                if known is not None and depth:
                    suffix = context & np.uint64((1 << (8 * (depth - 1))) - 1)
                    found = known[np.minimum(np.searchsorted(known, suffix), len(known) - 1)] == suffix if len(known) else np.zeros(len(at), bool)
                    at, context = at[found], context[found]
                code, which = np.unique((context << np.uint64(8)) | data[at], return_inverse=True)
                n = np.bincount(which, weights=weight[at], minlength=len(code))
                yield pd.DataFrame(
                    {
                        "depth": np.full(len(code), depth, np.int32),
                        "context": (code >> np.uint64(8)).astype(np.int64),
                        "symbol": (code & np.uint64(255)).astype(np.int32),
                        "n": n.astype(np.int64),
                    }
                )

    schema = "depth int, context bigint, symbol int, n bigint"
    counted = words.select("word", "n").mapInPandas(count, schema)
    return counted.groupBy("depth", "context", "symbol").agg(F.sum("n").alias("n"))


@dataclass
class SuffixTree:
    """States by context: total, next-symbol counts, and their smoothing."""

    states: dict[bytes, tuple[float, dict[int, int]]]
    runs: dict[bytes, float] = field(default_factory=dict, repr=False)
    logs: dict[bytes, tuple[float, dict[int, float]]] = field(default_factory=dict, repr=False)

    def probability(self, context: bytes, symbol: int) -> float:
        """Smoothed by the suffix, with as much weight as different symbols were seen."""
        if not context:
            total, counts = self.states.get(b"", (0.0, {}))
            return (counts.get(symbol, 0) + 1.0) / (total + SYMBOLS)
        shorter = self.suffix(context[1:])
        total, counts = self.states[context]
        return (counts.get(symbol, 0) + len(counts) * self.probability(shorter, symbol)) / (total + len(counts))

    def suffix(self, context: bytes) -> bytes:
        """The longest suffix that is a state; the empty context always is."""
        while context and context not in self.states:
            context = context[1:]
        return context

    def prepare(self) -> None:
        """Logarithms of what each state saw, and of the weight it leaves to its suffix."""
        for context, (total, counts) in self.states.items():
            left = math.log10(len(counts) / (total + len(counts))) if context else 0.0
            self.logs[context] = (left, {s: math.log10(self.probability(context, s)) for s in counts})

    def symbol_log(self, context: bytes, symbol: int) -> float:
        left = 0.0
        while context:
            weight, seen = self.logs[context]
            if symbol in seen:
                return left + seen[symbol]
            left += weight
            context = self.suffix(context[1:])
        return left + math.log10(self.probability(b"", symbol))

    def word_log(self, word: bytes) -> float:
        """log10 probability of a word and the space after it, given that a word starts."""
        spelled, total = b" " + word + b" ", 0.0
        for i in range(1, len(spelled)):
            run = spelled[max(0, i - DEPTH) : i + 1]
            known = self.runs.get(run)
            if known is None:
                known = self.symbol_log(self.suffix(run[:-1]), run[-1])
                if len(self.runs) < CACHED_RUNS:
                    self.runs[run] = known
            total += known
        return total


def differs(counts: dict[int, int], total: float, below: dict[int, float]) -> bool:
    """Likelihood-ratio test of a distribution against its suffix's.

    The statistic is chi-squared with about one degree of freedom per symbol
    seen; the limit lies four standard deviations above its mean.
    """
    statistic = 2.0 * sum(n * math.log(n / total / below[s]) for s, n in counts.items())
    free = len(counts)
    return statistic > free + 4.0 * math.sqrt(2.0 * free)


def spelling_tree(words: DataFrame, positions: int) -> SuffixTree:
    """The suffix tree over the bytes of weighted words (word, n).

    `positions` is the number of symbols in them; contexts below `LEAST_SHARE`
    of it are not looked at, which bounds what each round brings here.
    """
    least = max(LEAST_COUNT, LEAST_SHARE * positions)
    seen: dict[int, dict[int, tuple[float, dict[int, int]]]] = {}
    parents = None
    for depths in ([0, 1, 2], *([d] for d in range(3, DEPTH + 1))):
        counted = context_counts(words, depths, parents)
        frequent = (
            counted.groupBy("depth", "context")
            .agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("symbol", "n"))).alias("next"))
            .where((F.col("total") >= least) | (F.col("depth") == 0))
            .select("depth", "context", "total", F.col("next.symbol").alias("symbols"), F.col("next.n").alias("counts"))
        )
        for row in frequent.toArrow().to_pandas().itertuples():
            seen.setdefault(row.depth, {})[row.context] = (
                float(row.total),
                dict(zip(row.symbols.tolist(), row.counts.tolist())),
            )
        last = seen.get(depths[-1], {})
        if not last:
            break
        parents = np.sort(np.array(list(last), np.int64).astype(np.uint64))
    tree = SuffixTree({b"": (0.0, {})})
    total, counts = seen.get(0, {}).get(0, (0.0, {}))
    tree.states[b""] = (total, counts)
    for depth in range(1, DEPTH + 1):
        for number, (total, counts) in sorted(seen.get(depth, {}).items()):
            context = int(number).to_bytes(8, "big")[8 - depth :]
            shorter = tree.suffix(context[1:])
            below = {s: tree.probability(shorter, s) for s in counts}
            if differs(counts, total, below):
                tree.states[context] = (total, counts)
    tree.prepare()
    return tree


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Name of two words in a row."""
    mixed = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + right
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


@dataclass
class Sequences:
    """START, the words and END of several texts in a row: numbers (-1: none), names, places of the STARTs."""

    ids: np.ndarray
    names: np.ndarray
    starts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        first = np.zeros(len(self.ids), bool)
        first[self.starts] = True
        return first


@dataclass
class Vocabulary:
    """Numbers of the frequent words and their names by number (END and START
    come first); bits of the names of the others that may be listed."""

    ids: dict[bytes, int]
    names: np.ndarray
    others: Bits

    def sequences(self, texts: list[list[bytes]]) -> Sequences:
        sizes = np.array([len(t) + 2 for t in texts], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        ids = np.full(int(sizes.sum()), START_NAME, np.int64)
        inner = np.ones(len(ids), bool)
        inner[starts] = inner[starts + sizes - 1] = False
        known = self.ids
        words = [w for t in texts for w in t]
        ids[inner] = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        ids[starts + sizes - 1] = END_NAME
        names = self.names[ids]
        rare = np.flatnonzero(ids[inner] < 0).tolist()
        at = np.flatnonzero(inner)[rare]
        names[at] = np.fromiter((xxhash.xxh3_64_intdigest(words[i]) for i in rare), np.uint64, len(rare))
        return Sequences(ids, names, starts)

    def maybe(self, found: Sequences) -> np.ndarray:
        """May the word be frequent enough to be listed?"""
        maybe = found.ids >= 0
        if self.others.size:
            rare = np.flatnonzero(~maybe)
            maybe[rare] = self.others.marked(found.names[rare].view(np.int64))
        return maybe


def vocabulary(words: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """Of words (word, name, n), and the counts of the numbered ones."""
    rows = words.orderBy(F.desc("n"), "name").select("word", "name", "n").limit(HOT_WORDS).toArrow()
    hot, names, n = rows["word"].to_pylist(), rows["name"].to_numpy(), rows["n"].to_numpy()
    ids = {word: number for number, word in enumerate(hot, 2)}
    # Words as frequent as the last numbered one are marked, too: that costs nothing.
    rest = words.where((F.col("n") >= LEAST_PAIRS) & (F.col("n") <= int(n[-1]) if len(n) else F.lit(True)))
    rest = rest if len(n) >= HOT_WORDS else rest.limit(0)
    others = bits_of(rest.select("name"), rest.count())
    numbered = np.concatenate([np.array([END_NAME, START_NAME], np.uint64), names.astype(np.int64).view(np.uint64)])
    return Vocabulary(ids, numbered, others), n


SUCCESSIONS = "code bigint, context bigint, symbol bigint, n bigint"
# What tasks send: the successions of a bucket, packed. Of numbered words ascending codes,
# of others contexts and symbols; and their counts.
SENT_SCHEMA = "bucket int, codes binary, symbols binary, counts binary"


def pack(numbers: np.ndarray) -> bytes:
    """As many bytes of each number as the largest needs, the lowest first; the zeros of small
    numbers stand together, which Spark's shuffle compresses away."""
    width = max((int(numbers.max(initial=0)).bit_length() + 7) // 8, 1)
    data = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return bytes([width]) + data[:, :width].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    packed = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    numbers = np.zeros((packed.shape[1], 8), np.uint8)
    numbers[:, :width] = packed.T
    return numbers.view("<u8").ravel()


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Rows of (key, others, n) with every key once, ascending."""
    *columns, n = (np.concatenate(column) for column in zip(*parts))
    order = np.argsort(columns[0], kind="stable")
    key = columns[0][order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return (*(c[order[at]] for c in columns), np.add.reduceat(n[order], at) if len(at) else n)


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the keys of each bucket, in the keys' order."""
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    for i, j in zip(at, np.append(at, len(bucket))[1:]):
        yield int(bucket[i]), order[i:j]


def _counted(codes: list[np.ndarray], pairs: list[np.ndarray], buckets: int) -> Iterator[pd.DataFrame]:
    """Successions of numbered words by code, of others by context and symbol; the lists are emptied."""
    rows = []
    if codes:
        code = np.concatenate(codes)
        codes.clear()
        code.sort()
        at = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
        n = np.diff(np.append(at, len(code)))
        code = code[at]
        for bucket, mine in _by_bucket(code, buckets):
            rows.append((bucket, pack(np.diff(code[mine], prepend=0)), None, pack(n[mine])))
    if pairs:
        keys = np.concatenate(pairs)
        pairs.clear()
        # One occurrence of each tells context and symbol.
        key, context, symbol, n = _summed([(_mix(keys[:, 0], keys[:, 1]), keys[:, 0], keys[:, 1], np.ones(len(keys), np.int64))])
        for bucket, mine in _by_bucket(key, buckets):
            rows.append((bucket, pack(context[mine]), pack(symbol[mine]), pack(n[mine])))
    yield pd.DataFrame(rows, columns=["bucket", "codes", "symbols", "counts"])


def _gathering(gather: Callable[[Sequences, list, list], int], vocabulary: Callable[[], Vocabulary], buckets: int):
    """A task that gathers successions and counts them whenever there are GATHERED of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, pairs, gathered = [], [], 0
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                texts = [fold_bytes(t).split() for t in batch["text"].iloc[at : at + AT_ONCE]]
                gathered += gather(vocabulary().sequences(texts), codes, pairs)
                if gathered > GATHERED:
                    yield from _counted(codes, pairs, buckets)
                    gathered = 0
        yield from _counted(codes, pairs, buckets)

    return run


def _listed(sent: DataFrame, buckets: int) -> DataFrame:
    """code, context, symbol, n of what occurs LEAST_PAIRS times in all.

    A task holds one bucket at a time; buckets are as many as keep their
    different successions below BUCKET.
    """

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out() -> Iterator[pd.DataFrame]:
            for parts, numbered in ((codes, True), (pairs, False)):
                if not parts:
                    continue
                *columns, n = _summed(parts)
                often = np.flatnonzero(n >= LEAST_PAIRS)
                for at in range(0, len(often), SENT):
                    some = often[at : at + SENT]
                    code, context, symbol = (columns[0][some], 0, 0) if numbered else (-1, *(c[some].view(np.int64) for c in columns[1:]))
                    yield pd.DataFrame({"code": code, "context": context, "symbol": symbol, "n": n[some]})

        current, codes, pairs, size, limit = None, [], [], 0, 2 * BUCKET
        for batch in batches:
            for bucket, packed, symbols, counts in zip(*(batch[c] for c in ("bucket", "codes", "symbols", "counts"))):
                if bucket != current:
                    yield from out()
                    current, codes, pairs, size, limit = bucket, [], [], 0, 2 * BUCKET
                n = unpack(counts).view(np.int64)
                if symbols is None:
                    codes.append((np.cumsum(unpack(packed).view(np.int64)), n))
                else:
                    context, symbol = unpack(packed), unpack(symbols)
                    pairs.append((_mix(context, symbol), context, symbol, n))
                size += len(n)
                if size > limit:
                    codes, pairs = ([_summed(parts)] if parts else [] for parts in (codes, pairs))
                    size = sum(len(parts[0][0]) for parts in (codes, pairs) if parts)
                    limit = 2 * max(size, BUCKET)
        yield from out()

    dealt = sent.repartition(min(-(-buckets // TASK_BUCKETS), MOST_PARTITIONS), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(add_up, SUCCESSIONS)


def pair_counts(docs: DataFrame, shared: Broadcast[Vocabulary], buckets: int) -> DataFrame:
    """Words after one word, from LEAST_PAIRS occurrences on."""

    def gather(found: Sequences, codes: list, pairs: list) -> int:
        ids, maybe = found.ids, shared.value.maybe(found)
        i = np.flatnonzero(~found.first)
        i = i[maybe[i - 1] & maybe[i]]
        both = (ids[i - 1] >= 0) & (ids[i] >= 0)
        codes.append((ids[i[both] - 1] << ID_BITS) | ids[i[both]])
        i = i[~both]
        pairs.append(np.stack([found.names[i - 1], found.names[i]], axis=1))
        return len(both)

    sent = docs.select("text").mapInPandas(_gathering(gather, lambda: shared.value, buckets), SENT_SCHEMA)
    return _listed(sent, buckets)


def triple_counts(docs: DataFrame, shared: Broadcast[Vocabulary], coded: Bits, named: Bits, buckets: int) -> DataFrame:
    """Words after two words, from LEAST_PAIRS occurrences on; the bits tell which pairs may be listed."""
    bits = docs.sparkSession.sparkContext.broadcast((coded, named))

    def gather(found: Sequences, codes: list, pairs: list) -> int:
        by_code, by_name = bits.value
        ids, names, maybe = found.ids, found.names, shared.value.maybe(found)
        worth = np.zeros(len(ids), bool)
        i = np.flatnonzero(~found.first)
        i = i[maybe[i - 1] & maybe[i]]
        both = (ids[i - 1] >= 0) & (ids[i] >= 0)
        at, other = i[both], i[~both]
        if by_code.size:
            worth[at] = by_code.marked((ids[at - 1] << ID_BITS) | ids[at])
        if by_name.size:
            worth[other] = by_name.marked(_mix(names[other - 1], names[other]).view(np.int64))
        i = np.flatnonzero(worth[1:] & worth[:-1]) + 1
        three = (ids[i - 2] >= 0) & (ids[i - 1] >= 0) & (ids[i] >= 0)
        at, other = i[three], i[~three]
        codes.append((ids[at - 2] << 2 * ID_BITS) | (ids[at - 1] << ID_BITS) | ids[at])
        pairs.append(np.stack([_mix(names[other - 2], names[other - 1]), names[other]], axis=1))
        return len(i)

    sent = docs.select("text").mapInPandas(_gathering(gather, lambda: shared.value, buckets), SENT_SCHEMA)
    return _listed(sent, buckets)


def succession_counts(docs: DataFrame, shared: Broadcast[Vocabulary], tokens: int = 0) -> DataFrame:
    """order (1 or 2), context, symbol, n: words after one and after two words, by
    their names, from LEAST_PAIRS occurrences on, however the texts of `tokens` words and ends are split."""
    spark, buckets = docs.sparkSession, tokens // BUCKET + 1
    names = shared.value.names.view(np.int64)
    numbered = stored(
        spark.createDataFrame(pd.DataFrame({"id": np.arange(len(names)), "name": names}), "id bigint, name bigint"), "names"
    )

    def named(rows: DataFrame, place: int, size: int) -> DataFrame:
        number = F.shiftright("code", ID_BITS * (size - place)).bitwiseAND(F.lit((1 << ID_BITS) - 1))
        # As many rows as words have numbers.
        table = F.broadcast(numbered.select(F.col("id").alias("_id"), F.col("name").alias(f"w{place}")))
        return rows.withColumn("_id", number).join(table, "_id").drop("_id")

    with setting(spark, ARROW_ROWS, str(PACKED_ROWS)):
        ones = stored(pair_counts(docs, shared, buckets), "pairs")
    coded, plain = ones.where("code >= 0"), ones.where("code < 0")
    by_code = bits_of(coded.select(F.col("code").alias("name")), coded.count())
    by_name = bits_of(plain.select(mixed("context", "symbol").alias("name")), plain.count())
    with setting(spark, ARROW_ROWS, str(PACKED_ROWS)):
        twos = stored(triple_counts(docs, shared, by_code, by_name, buckets), "triples")
    one = named(named(coded, 1, 2), 2, 2).select(F.lit(1).alias("order"), F.col("w1").alias("context"), F.col("w2").alias("symbol"), "n")
    two = named(named(named(twos.where("code >= 0"), 1, 3), 2, 3), 3, 3)
    two = two.select(F.lit(2).alias("order"), mixed("w1", "w2").alias("context"), F.col("w3").alias("symbol"), "n")
    for order, rows in ((1, plain), (2, twos.where("code < 0"))):
        one = one.union(rows.select(F.lit(order).alias("order"), "context", "symbol", "n"))
    return one.union(two)


@F.pandas_udf(LongType())
def mixed(left: pd.Series, right: pd.Series) -> pd.Series:
    """`_mix` of columns."""
    return pd.Series(_mix(left.to_numpy().view(np.uint64), right.to_numpy().view(np.uint64)).view(np.int64))


def order_terms(listed: DataFrame, label: str) -> DataFrame:
    """Terms key, value, n of one order from rows context, symbol, n, total, below.

    `total` is how often the context occurs, `below` the log10 probability of
    the symbol under the context's suffix. A state is kept if the likelihood
    ratio of its listed successors lies four standard deviations above chance.
    As much weight as it has listed successors (one at least) is left over.
    """
    n, below = F.col("n"), F.col("below")
    sums = listed.groupBy("context").agg(
        F.sum("n").alias("sums"),
        F.count(F.lit(1)).alias("free"),
        F.max("total").alias("total"),
        F.sum(n * (F.log(n) - below * math.log(10.0))).alias("gain"),
    )
    total = F.greatest("total", "sums")
    weight = total + F.col("free") + 1.0
    states = stored(
        sums.where(2.0 * (F.col("gain") - F.col("sums") * F.log(total)) > F.col("free") + 4.0 * F.sqrt(2.0 * F.col("free")))
        .select("context", total.alias("occurs"), weight.alias("weight"), F.log10(1.0 - F.col("sums") / weight).alias("left")),
        f"states-{label}",
    )
    # What the state counted and the share of what it leaves over, less the term of the latter.
    left_over = F.col("left") + below
    pairs = listed.join(states, "context").select(
        mixed("context", "symbol").alias("key"),
        (F.log10(n / F.col("weight") + F.pow(F.lit(10.0), left_over)) - left_over).alias("value"),
        "n",
    )
    own = states.select(F.bitwise_not("context").alias("key"), F.col("left").alias("value"), F.col("occurs").alias("n"))
    return stored(own.union(pairs), f"terms-{label}")


def tree_terms(found: DataFrame, counts: DataFrame, own: Column) -> DataFrame:
    """key, value, n: the tree as log10 terms that add up.

    The probability of a word is its own, plus what each state among its two
    contexts leaves over, plus for each listed succession what its count adds to
    that. Keys are the context's complement and the name of the succession.
    `found`: successions; `counts`: name, n; `own`: log10 probability from n.
    """
    symbol = counts.select(F.col("name").alias("symbol"), own.alias("own"))
    context = counts.select(F.col("name").alias("context"), F.col("n").alias("total"))
    ones = found.where("order = 1").drop("order")
    first = ones.join(symbol, "symbol").join(context, "context")
    one = order_terms(first.select("context", "symbol", "n", "total", F.col("own").alias("below")), "one")
    # A context of two words is a listed succession; its suffix is the later word.
    longer = ones.select(
        mixed("context", "symbol").alias("context"), F.col("symbol").alias("suffix"), F.col("n").alias("total")
    ).dropDuplicates(["context"])
    second = found.where("order = 2").drop("order").join(symbol, "symbol").join(longer, "context")
    left = one.select(F.bitwise_not("key").alias("suffix"), F.col("value").alias("left"))
    more = one.select(F.col("key").alias("pair"), F.col("value").alias("more"))
    second = second.join(left, "suffix", "left").withColumn("pair", mixed("suffix", "symbol")).join(more, "pair", "left")
    below = F.col("own") + F.coalesce("left", F.lit(0.0)) + F.coalesce("more", F.lit(0.0))
    return one.union(order_terms(second.select("context", "symbol", "n", "total", below.alias("below")), "two"))


@dataclass
class Terms:
    """The most frequent terms by key, ascending, and bits of the keys of all, twice: a key
    that is no term passes both in vain once in 60 times, one of them once in 8."""

    keys: np.ndarray
    values: np.ndarray
    bits: Bits
    again: Bits

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Is the key held here, its value (else 0), and may it be in the table."""
        known, values, may = np.zeros(len(keys), bool), np.zeros(len(keys)), np.zeros(len(keys), bool)
        if self.bits.size:
            hit = np.flatnonzero(self.bits.marked(keys.view(np.int64)))
            hit = hit[self.again.marked(_mix(keys[hit], np.uint64(0)).view(np.int64))]
            may[hit] = True
            if len(self.keys) and len(hit):
                asked = keys[hit]
                at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
                same = self.keys[at] == asked
                known[hit] = same
                values[hit[same]] = self.values[at[same]]
                may[hit] = ~same
        return known, values, may


def split_terms(terms: DataFrame) -> Terms:
    """What is broadcast of the terms: at most `HOT_TERMS`, and the bits."""
    size = F.floor(F.log2("n") * 8).cast("int")
    found = sorted(terms.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    least, held = math.inf, 0
    for row in found:
        held += row["n"]
        if held > HOT_TERMS:
            break
        least = row["size"]
    hot = terms.where(size >= F.lit(float(least))).select("key", "value").toArrow()
    count = sum(row["n"] for row in found)
    bits = bits_of(terms.select(F.col("key").alias("name")), count)
    again = bits_of(terms.select(mixed("key", F.lit(0).cast("bigint")).alias("name")), count)
    keys = hot["key"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Terms(keys[order], hot["value"].to_numpy().astype(float)[order], bits, again)


@dataclass
class WordModel:
    """What is broadcast: words, frequent terms, log10(count + 1) and log10 probability by number."""

    words: Vocabulary
    terms: Terms
    logs: np.ndarray
    unseen: float

    def position_logs(self, found: Sequences) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 added by the terms held here per position; positions and keys that have to be looked up."""
        names, first = found.names, found.first
        logs = np.zeros(len(names))
        i = np.flatnonzero(~first)
        deep = i[~first[i - 1]]
        double = _mix(names[deep - 2], names[deep - 1])
        places, keys = [], []
        for at, context in ((i, names[i - 1]), (deep, double)):
            for key in (~context, _mix(context, names[at])):
                _, values, may = self.terms.find(key)
                logs[at] += values
                places.append(at[may])
                keys.append(key[may])
        places, keys = np.concatenate(places), np.concatenate(keys)
        order = np.argsort(places, kind="stable")
        return logs, places[order], keys[order]


def fit(
    train: DataFrame, words: DataFrame, texts: int, n_train: int, distinct: int, spelled: int
) -> tuple[WordModel, SuffixTree, DataFrame]:
    """The model of the training texts, its spelling, and all terms of its tree; `words`: word, name, n."""
    single = words.where("n = 1").count()
    unseen = min(max(single, 1) / max(n_train, 1), 0.5)
    scale = (1 - unseen) / max(float(n_train + distinct), 1.0)

    numbered, n = vocabulary(words)
    shared = train.sparkSession.sparkContext.broadcast(numbered)
    found = stored(succession_counts(train, shared, n_train), "successions")
    ends = train.sparkSession.createDataFrame([(END_NAME, texts), (START_NAME, texts)], "name bigint, n bigint")
    own = F.log10((F.col("n") + 1) * F.lit(scale))
    terms = tree_terms(found, words.select("name", "n").union(ends), own)
    spelling = spelling_tree(words.select("word", F.lit(1).cast("bigint").alias("n")), spelled)
    counts = np.concatenate([[texts, 0], n]).astype(float)
    logs = np.stack([np.log10(counts + 1), np.log10((counts + 1) * scale)])
    # A START is no token.
    logs[:, START_NAME] = 0.0
    return WordModel(numbered, split_terms(terms), logs, math.log10(unseen)), spelling, terms


def score_texts(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Base and model scores of every row of `docs` (doc_id, text).

    The model learns from rows whose id's crc32 modulo `folds` is not `held`.
    A row with a NULL id is learned from; NULL texts count as empty, that is,
    as their end alone; repeated rows count as often as they occur and score
    alike. Columns other than doc_id and text are not looked at.
    """
    # Each step is written: what it shuffled is of no use to the next and would only fill disks.
    with setting(docs.sparkSession, ARROW_ROWS, str(BATCH_ROWS)), setting(docs.sparkSession, FILE_CLEANUP, "true"):
        return _score_texts(docs, folds, held)


def _score_texts(docs: DataFrame, folds: int, held: int) -> DataFrame:
    held_out = F.coalesce(label_fold(F.col("doc_id"), folds) == held, F.lit(False))
    train = docs.where(~held_out)
    words = stored(word_counts(train).mapInPandas(_with_names, "word binary, name bigint, n bigint"), "words")
    sums = words.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.octet_length("word") + 1).alias("spelled")
    ).first()
    texts = train.count()
    n_train, distinct = (sums["n"] or 0) + texts, sums["v"] + (1 if texts else 0)
    model, spelling, terms = fit(train, words, texts, n_train, distinct, sums["spelled"] or 0)
    context = docs.sparkSession.sparkContext
    shared, shared_spelling = context.broadcast(model), context.broadcast(spelling)
    total = float(n_train + distinct)

    def doc_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        law = shared.value
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                part = batch.iloc[at : at + AT_ONCE]
                data = [fold_bytes(t) for t in part["text"]]
                texts = [d.split() for d in data]
                found = law.words.sequences(texts)
                logs, asked, keys = law.position_logs(found)
                plain, own = np.where(found.ids >= 0, law.logs[:, found.ids], 0.0)
                bounds = np.append(found.starts, len(found.ids))
                asking = np.searchsorted(asked, bounds)
                rows = []
                for i, (d, words) in enumerate(zip(data, texts)):
                    rare = [words[j] for j in np.flatnonzero(found.ids[bounds[i] : bounds[i + 1]] < 0) - 1]
                    mine = keys[asking[i] : asking[i + 1]].view(np.int64)
                    name = name_of(d)
                    # A copy of a text that this task has sent needn't be looked up again.
                    again = name in seen
                    if not again and (rare or len(mine)):
                        if len(seen) >= SEEN_TEXTS:
                            seen.clear()
                        seen.add(name)
                    rows.append((name, len(words) + 1, len(rare), len(mine), [] if again else rare, [] if again else mine))
                names = ["text", "n_tokens", "n_rare", "n_keys", "rare", "keys"]
                out = pd.DataFrame(rows, columns=names)
                out.insert(0, "doc_id", part["doc_id"].to_numpy())
                out["hot_base"] = np.add.reduceat(plain, found.starts)
                out["hot_score"] = np.add.reduceat(logs + own, found.starts)
                yield out

    scored = id_and_text(docs).mapInPandas(
        doc_rows,
        "doc_id string, text bigint, n_tokens bigint, n_rare int, n_keys int, rare array<binary>, "
        "keys array<bigint>, hot_base double, hot_score double",
    )
    scored = stored(with_number_id(scored), "scored")

    @F.pandas_udf("double")
    def spelled(word: pd.Series) -> pd.Series:
        tree = shared_spelling.value
        return pd.Series([0.0 if w is None else tree.word_log(bytes(w)) for w in word], dtype=float)

    n = F.col("n")
    scale = (1 - 10.0**model.unseen) / max(total, 1.0)
    rare = scored.select("text", F.explode("rare").alias("word")).join(words.select("word", "n"), "word", "left")
    own = F.when(n.isNull(), F.lit(model.unseen) + F.col("spelled")).otherwise(F.log10((n + 1) * F.lit(scale)))
    per_text = (
        rare.withColumn("spelled", spelled(F.when(n.isNull(), F.col("word"))))
        .groupBy("text")
        .agg(
            F.sum(F.log10(F.coalesce(n, F.lit(0)) + 1)).alias("rare_base"),
            F.sum(own).alias("rare_score"),
            F.count("n").alias("rare_known"),
            F.count(F.lit(1)).alias("sent"),
        )
    )
    asked = scored.select("text", F.explode("keys").alias("key")).join(terms.select("key", "value"), "key", "left")
    per_tree = asked.groupBy("text").agg(F.sum("value").alias("tree"), F.count(F.lit(1)).alias("asked"))
    rows = scored.drop("rare", "keys").join(stored(per_text, "rare-sums"), "text", "left")
    rows = rows.join(stored(per_tree, "tree-sums"), "text", "left")
    # Each task that met a text sent its words: the sums are as many times too large.
    copies = F.when(F.col("n_rare") > 0, F.col("sent") / F.col("n_rare")).otherwise(F.lit(1.0))
    rare_base, rare_score = (F.coalesce(F.col(c) / copies, F.lit(0.0)) for c in ("rare_base", "rare_score"))
    tree = F.coalesce(F.col("tree") * F.col("n_keys") / F.col("asked"), F.lit(0.0))
    rare_known = F.coalesce(F.round(F.col("rare_known") / copies), F.lit(0)).cast("bigint")
    return rows.select(
        "doc_id",
        F.coalesce(label_fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_tokens") - 1 - F.col("n_rare") + rare_known + F.lit(1 if texts else 0)).alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        (F.col("hot_base") + rare_base - F.col("n_tokens") * F.lit(math.log10(total + 1))).alias("base_score"),
        (F.col("hot_score") + rare_score + tree).alias("score"),
    )


def _with_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch["name"] = [name_of(bytes(w)) for w in batch["word"]]
        yield batch[["word", "name", "n"]]
