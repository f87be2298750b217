"""Phrases of two and three words that occur together more than apart, per language.

Words are numbered by their frequency, so a pair of words is a cell of a plane
whose corner holds most occurrences. A task cuts the plane into square tiles:
cells of a full tile are counted by direct addressing (a dense bincount), those
of the others as sorted coordinates. Frequent pairs are numbered by frequency
again and take the place of the first word: the same tiles then count three
words in a row.

Nothing is dropped that could count. A phrase can't be more frequent than its
parts, so only pairs of frequent words and triples of two frequent pairs are
counted. The most frequent words and pairs are broadcast, in fixed numbers. A
table of bits of bounded size tells which others may be frequent; phrases with
such words travel as text, and their sums decide.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import stored
from courierlake.session import setting

UNKNOWN_LANG = "und"
# Words and pairs that are broadcast, the most frequent ones. A word's number
# takes ID_BITS bits of a code, a code of three words fits a long.
HOT_WORDS, HOT_PAIRS = 250_000, 1_000_000
ID_BITS = 20
# Edge of a tile, and the occurrences from which its cells are addressed directly.
EDGE = 1024
DENSE = EDGE * EDGE // 8
# Bits of the table of other frequent words or pairs: 8 each, within these bounds.
LEAST_BITS, MOST_BITS = 65_537, 200_000_003
# Occurrences a task gathers before it counts them, words or phrases it holds, texts it cuts
# at once, rows it sends at once: they bound the memory of a task.
GATHERED, HELD, AT_ONCE, SENT = 500_000, 50_000, 200, 50_000
# Texts that a task holds at once on either side of its pipe.
BATCH_ROWS = 1_000
# Distinct codes of a bucket, about; buckets at least, and partitions they are dealt to at most.
BUCKET, LEAST_BUCKETS, MOST_PARTITIONS = 1_000_000, 128, 20_000

# Ends a piece; no byte of UTF-8.
MARK = b"\xff"
_FOLD = bytes(
    0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def tokens(texts: list[str | None]) -> list[bytes]:
    """Words of all texts in a row, with a mark after every piece.

    Of what bytes.split() takes for blank, only space and tab are left by then.
    """
    joined = MARK.join(b"" if t is None else t.encode("utf-8", "replace").translate(_FOLD) for t in texts)
    return (joined + MARK).replace(MARK, b" " + MARK + b" ").split()


def _by_lang(batch: pd.DataFrame) -> Iterator[tuple[str, list[bytes]]]:
    for lang, rows in batch.groupby("lang", sort=False):
        for at in range(0, len(rows), AT_ONCE):
            yield str(lang), tokens(rows["text"].iloc[at : at + AT_ONCE].tolist())


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over `docs` (lang, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out() -> pd.DataFrame:
            rows = [(lang, word, n) for lang, counter in held.items() for word, n in counter.items()]
            held.clear()
            lang, word, n = map(list, zip(*rows)) if rows else ([], [], [])
            return pd.DataFrame({"lang": pd.Series(lang, dtype=object), "word": word, "n": n})

        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, found in _by_lang(batch):
                counter = held.setdefault(lang, Counter())
                counter.update(found)
                del counter[MARK]
                if sum(map(len, held.values())) > HELD:
                    yield out()
        yield out()

    counted = docs.mapInPandas(count, "lang string, word binary, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _name(*parts: bytes) -> int:
    """As :func:`name_column`: 64 bits."""
    value = 42
    for part in parts:
        value = xxhash.xxh64_intdigest(part, value)
    return value - (1 << 64) if value >> 63 else value


def name_column(*parts: Column) -> Column:
    """Spark's xxhash64 of the parts, which chains them by their seeds."""
    return F.xxhash64(*(p.cast("binary") for p in parts))


@dataclass
class Bits:
    """Marks of names that may be frequent though they aren't broadcast; a name's bit is its remainder."""

    size: int = 0
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def __contains__(self, name: int) -> bool:
        bit = name % self.size
        return bool((int(self.words[bit >> 6]) >> (bit & 63)) & 1)

    def marked(self, names: np.ndarray) -> np.ndarray:
        bit = (names % self.size).astype(np.uint64)
        return (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def bits_of(names: DataFrame, n: int) -> Bits:
    """Table of the column `name`; its size grows with `n` up to a bound, beyond which more are marked in vain."""
    if not n:
        return Bits()
    size = min(max(8 * n + 1, LEAST_BITS), MOST_BITS)
    bit = F.pmod("name", F.lit(size))
    rows = (
        names.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(name, {size}L) & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    words = np.zeros((size >> 6) + 1, np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Bits(size, words)


def tiled_counts(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells (first, second) that occur, and how often."""
    across = int(second.max(initial=0)) // EDGE + 1
    tile = (first // EDGE * across + second // EDGE).astype(np.int32)
    full = np.flatnonzero(np.bincount(tile) >= DENSE)
    found = []
    rest = np.ones(len(first), bool)
    for t in full:
        here = tile == t
        rest &= ~here
        n = np.bincount(first[here] % EDGE * EDGE + second[here] % EDGE, minlength=EDGE * EDGE)
        cell = np.flatnonzero(n)
        found.append((t // across * EDGE + cell // EDGE, t % across * EDGE + cell % EDGE, n[cell]))
    code = first[rest].astype(np.int64) << 32
    code |= second[rest]
    code.sort()
    at = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
    found.append((code[at] >> 32, code[at] & 0xFFFFFFFF, np.diff(np.append(at, len(code)))))
    return tuple(np.concatenate(part) for part in zip(*found))


@dataclass
class Vocabulary:
    """Numbers of the broadcast words by language; bits of the other frequent words."""

    ids: dict[str, dict[bytes, int]]
    others: Bits

    def numbers(self, lang: str, found: list[bytes]) -> np.ndarray:
        """Each word's number, -2 if it may be frequent all the same, else -1."""
        known = self.ids.get(lang, {})
        ids = np.fromiter((known.get(w, -1) for w in found), np.int64, len(found))
        if self.others.size:
            for i in np.flatnonzero(ids < 0).tolist():
                if found[i] != MARK and _name(lang.encode(), found[i]) in self.others:
                    ids[i] = -2
        return ids


@dataclass
class Pairs:
    """Codes of the broadcast pairs, ascending, with their numbers; bits of the other frequent pairs."""

    codes: np.ndarray
    numbers: np.ndarray
    others: Bits

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Each pair's number, -1 for others."""
        if not len(self.codes):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.numbers[at], -1)


# What tasks send: ascending codes of a bucket with their counts, packed; or phrases with a
# word without a number, as language and phrase with a zero byte between, all in one text,
# with their lengths for codes.
SENT_SCHEMA = "bucket int, codes binary, counts binary, phrases binary"


def bucket_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (codes.astype(np.uint64) ^ (codes.astype(np.uint64) >> np.uint64(23))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def pack(numbers: np.ndarray) -> bytes:
    """Byte by byte, the lowest first: the zeros of small numbers stand together, which Spark's
    shuffle compresses away."""
    return np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64)


def _texts(found: Counter, buckets: int) -> pd.DataFrame:
    """Counted phrases that have a word without a number, by bucket."""
    held: dict[int, list[tuple[bytes, int]]] = {}
    for (lang, phrase), n in found.items():
        name = lang.encode() + b"\0" + phrase
        held.setdefault(xxhash.xxh64_intdigest(name) % buckets, []).append((name, n))
    found.clear()
    rows = []
    for bucket, some in held.items():
        lengths, n = np.array([len(name) for name, _ in some]), np.array([n for _, n in some])
        rows.append((bucket, pack(lengths), pack(n), b"".join(name for name, _ in some)))
    return pd.DataFrame(rows, columns=["bucket", "codes", "counts", "phrases"])


def _codes(codes: np.ndarray, n: np.ndarray, buckets: int) -> Iterator[pd.DataFrame]:
    """Distinct codes with their counts, by bucket."""
    order = np.argsort(codes)
    bucket = bucket_of(codes[order], buckets)
    by_bucket = np.argsort(bucket, kind="stable")
    order, bucket = order[by_bucket], bucket[by_bucket]
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    rows = []
    for i, j in zip(at, np.append(at, len(bucket))[1:]):
        mine = order[i:j]
        rows.append((int(bucket[i]), pack(np.diff(codes[mine], prepend=0)), pack(n[mine]), None))
    yield pd.DataFrame(rows, columns=["bucket", "codes", "counts", "phrases"])


def _joined(cells: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in one piece each; the parts are let go."""
    sides = tuple(np.concatenate([c[i] for c in cells]) for i in (0, 1))
    cells.clear()
    return sides


def _counting(
    gather: Callable[[str, list[bytes], list, list, Counter], int],
    count: Callable[[list, list], Iterator[pd.DataFrame]],
    buckets: int,
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A task that gathers occurrences and counts them whenever there are GATHERED of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, plain, texts, gathered = [], [], Counter(), 0
        for batch in batches:
            for lang, found in _by_lang(batch):
                gathered += gather(lang, found, cells, plain, texts)
                if gathered > GATHERED:
                    yield from count(cells, plain)
                    cells, plain, gathered = [], [], 0
                if len(texts) > HELD:
                    yield _texts(texts, buckets)
        yield from count(cells, plain)
        yield _texts(texts, buckets)

    return run


def _merged(codes: list[np.ndarray], n: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """One pair of arrays with every code once."""
    code, count = np.concatenate(codes), np.concatenate(n)
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    at = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
    return [code[at]], [np.add.reduceat(count, at) if len(at) else count]


def _summed(counted: DataFrame, buckets: int, least: int) -> DataFrame:
    """code or phrase, and n, of what occurs `least` times in all.

    A task holds one bucket at a time; buckets are as many as keep their
    distinct codes near BUCKET.
    """

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out() -> Iterator[pd.DataFrame]:
            nonlocal codes, n
            if codes:
                codes, n = _merged(codes, n)
                often = np.flatnonzero(n[0] >= least)
                for at in range(0, len(often), SENT):
                    some = often[at : at + SENT]
                    yield pd.DataFrame({"code": codes[0][some], "phrase": None, "n": n[0][some]})
            kept = [(-1, phrase, count) for phrase, count in texts.items() if count >= least]
            yield pd.DataFrame(kept, columns=["code", "phrase", "n"])

        current, codes, n, texts, size, limit = None, [], [], Counter(), 0, 2 * BUCKET
        for batch in batches:
            for bucket, packed, counts, phrases in zip(*(batch[c] for c in ("bucket", "codes", "counts", "phrases"))):
                if bucket != current:
                    yield from out()
                    current, codes, n, texts, size, limit = bucket, [], [], Counter(), 0, 2 * BUCKET
                if phrases is not None:
                    ends = np.cumsum(unpack(packed)).tolist()
                    for at, end, count in zip([0, *ends], ends, unpack(counts).tolist()):
                        texts[phrases[at:end]] += count
                    continue
                codes.append(np.cumsum(unpack(packed)))
                n.append(unpack(counts))
                size += len(n[-1])
                if size > limit:
                    codes, n = _merged(codes, n)
                    size = len(n[0])
                    limit = 2 * max(size, BUCKET)
        yield from out()

    dealt = counted.repartition(min(buckets, MOST_PARTITIONS), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(add_up, "code bigint, phrase binary, n bigint")


def pair_counts(docs: DataFrame, shared: Broadcast[Vocabulary], least: int, buckets: int) -> DataFrame:
    """Pairs of frequent words with at least `least` occurrences: code or phrase, and n."""

    def gather(lang: str, found: list[bytes], cells: list, plain: list, texts: Counter) -> int:
        ids = shared.value.numbers(lang, found)
        a, b = ids[:-1], ids[1:]
        both = (a >= 0) & (b >= 0)
        cells.append((a[both].astype(np.int32), b[both].astype(np.int32)))
        for i in np.flatnonzero((np.minimum(a, b) == -2) & (a != -1) & (b != -1)).tolist():
            texts[lang, found[i] + b" " + found[i + 1]] += 1
        return int(both.sum())

    def count(cells: list, plain: list) -> Iterator[pd.DataFrame]:
        if cells:
            a, b, n = tiled_counts(*_joined(cells))
            yield from _codes((a << ID_BITS) | b, n, buckets)

    return _summed(docs.mapInPandas(_counting(gather, count, buckets), SENT_SCHEMA), buckets, least)


def triple_counts(
    docs: DataFrame, shared: Broadcast[Vocabulary], shared_pairs: Broadcast[Pairs], least: int, buckets: int
) -> DataFrame:
    """Triples whose two pairs are frequent, as :func:`pair_counts`."""

    def gather(lang: str, found: list[bytes], cells: list, plain: list, texts: Counter) -> int:
        frequent = shared_pairs.value
        ids = shared.value.numbers(lang, found)
        a, b = ids[:-1], ids[1:]
        number = np.full(len(a), -1)
        both = np.flatnonzero((a >= 0) & (b >= 0))
        code = (a[both] << ID_BITS) | b[both]
        number[both] = frequent.find(code)
        if frequent.others.size:
            left_out = number[both] < 0
            number[both[left_out][frequent.others.marked(code[left_out])]] = -2
            for i in np.flatnonzero((np.minimum(a, b) == -2) & (a != -1) & (b != -1)).tolist():
                if _name(lang.encode() + b"\0" + found[i] + b" " + found[i + 1]) in frequent.others:
                    number[i] = -2
        left, right = number[:-1], number[1:]
        worth = (left != -1) & (right != -1)
        tiled = np.flatnonzero(worth & (left >= 0) & (right >= 0))
        cells.append((left[tiled].astype(np.int32), ids[tiled + 2].astype(np.int32)))
        other = np.flatnonzero(worth & ((left < 0) | (right < 0)))
        numbered = (ids[other] >= 0) & (ids[other + 1] >= 0) & (ids[other + 2] >= 0)
        at = other[numbered]
        plain.append((ids[at] << 2 * ID_BITS) | (ids[at + 1] << ID_BITS) | ids[at + 2])
        for i in other[~numbered].tolist():
            texts[lang, b" ".join(found[i : i + 3])] += 1
        return len(tiled) + len(at)

    def count(cells: list, plain: list) -> Iterator[pd.DataFrame]:
        if cells:
            frequent = shared_pairs.value
            pair, word, n = tiled_counts(*_joined(cells))
            by_number = np.empty(len(frequent.codes), np.int64)
            by_number[frequent.numbers] = frequent.codes
            yield from _codes((by_number[pair] << ID_BITS) | word, n, buckets)
            codes = np.concatenate(plain)
            plain.clear()
            yield from _codes(*np.unique(codes, return_counts=True), buckets)

    return _summed(docs.mapInPandas(_counting(gather, count, buckets), SENT_SCHEMA), buckets, least)


def _plain(found: DataFrame, size: int) -> DataFrame:
    """lang, w1.., n of the phrases that have no code."""
    lang = F.substring_index(F.col("phrase").cast("string"), "\0", 1)
    words = F.split(F.expr("substr(cast(phrase as string), char_length(lang) + 2)"), " ")
    rows = found.where("code < 0").select("phrase", lang.alias("lang"), "n").withColumn("words", words)
    return rows.select("lang", *(F.get("words", F.lit(i)).alias(f"w{i + 1}") for i in range(size)), "n")


def _word(rows: DataFrame, hot: DataFrame, place: int, size: int, *others: str) -> DataFrame:
    """`rows` with the word at a place of their code, its count f1.., and other columns of `hot`."""
    number = F.shiftright("code", ID_BITS * (size - place)).bitwiseAND(F.lit((1 << ID_BITS) - 1))
    named = hot.select(
        F.col("id").alias("_id"), F.col("word").alias(f"w{place}"), F.col("f").alias(f"f{place}"), *others
    )
    return rows.withColumn("_id", number).join(F.broadcast(named), "_id").drop("_id")


def _ranked(rows: DataFrame, most: int, *ties: str) -> DataFrame:
    """The `most` rows with the highest n, numbered from 0; bounded, so it may be collected."""
    return rows.orderBy(F.desc("n"), *ties).limit(most)


def frequent_words(counts: DataFrame, least: int, hot_words: int) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary of words that occur `least` times, and its broadcast part as id, lang, word, f."""
    spark = counts.sparkSession
    rows = counts.where(F.col("n") >= least)
    hot = _ranked(rows, hot_words, "lang", "word").toArrow()
    langs, words, n = (hot[c].to_pylist() for c in ("lang", "word", "n"))
    ids: dict[str, dict[bytes, int]] = {}
    for number, (lang, word) in enumerate(zip(langs, words)):
        ids.setdefault(lang, {})[word] = number
    n_others = rows.count() - len(words)
    others = Bits()
    if n_others > 0:
        # Words as frequent as the last broadcast one are marked, too: that costs nothing.
        last = n[-1] if n else 0x7FFFFFFFFFFFFFFF
        rest = rows.where(F.col("n") <= last)
        others = bits_of(rest.select(name_column(F.col("lang"), F.col("word")).alias("name")), n_others)
    spelled = [w.decode("utf-8", "replace") for w in words]
    numbered = pd.DataFrame({"id": range(len(words)), "lang": langs, "word": spelled, "f": n})
    table = spark.createDataFrame(numbered, "id bigint, lang string, word string, f bigint")
    return Vocabulary(ids, others), stored(table, "hot-words")


def frequent_pairs(counts: DataFrame, hot_pairs: int) -> Pairs:
    """The most frequent pairs by number, and bits of the others, by code or by name."""
    coded = counts.where("code >= 0").select("code", "n")
    rows = _ranked(coded, hot_pairs, "code").toArrow()
    codes, n = rows["code"].to_numpy(), rows["n"].to_numpy()
    n_others = counts.count() - len(codes)
    others = Bits()
    if n_others > 0:
        # Pairs as frequent as the last numbered one are marked, too, as above.
        last = int(n[-1]) if len(n) else 0x7FFFFFFFFFFFFFFF
        plain = counts.where("code < 0").select(name_column(F.col("phrase")).alias("name"))
        rest = coded.where(F.col("n") <= last).select(F.col("code").alias("name"))
        others = bits_of(plain.union(rest), n_others)
    order = np.argsort(codes)
    return Pairs(codes[order], np.arange(len(codes))[order], others)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 a a / (left right)) in whole numbers of up to 38 digits."""
    a, left, right = (c.cast("decimal(18,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), left * right)


def collocations(
    docs: DataFrame,
    top: int = 2000,
    least: int = 10,
    hot_words: int = HOT_WORDS,
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases.

    `docs` has text and lang; other columns are not looked at. NULL texts and
    texts without words add nothing, a NULL lang counts as `und`, together with
    rows of that lang. Repeated rows count as often as they occur. Equal scores
    go by a, then by the phrase's bytes. A language without any phrase of
    `least` occurrences has no row; neither has an empty table.
    """
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"), "text").where(F.col("text").isNotNull())
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)):
        return _collocations(docs, top, least, hot_words, hot_pairs)


def _collocations(docs: DataFrame, top: int, least: int, hot_words: int, hot_pairs: int) -> DataFrame:
    counts = stored(word_counts(docs), "words")
    words, hot = frequent_words(counts, least, min(hot_words, 1 << ID_BITS))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(words)
    n_words = counts.agg(F.sum("n")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, n_words // BUCKET)
    found = stored(pair_counts(docs, shared, least, buckets), "pairs")
    pairs = frequent_pairs(found, hot_pairs)
    threes = stored(triple_counts(docs, shared, context.broadcast(pairs), least, buckets), "triples")

    # What has a code finds its words among the broadcast ones and its pairs by their codes.
    coded = found.where("code >= 0").select("code", F.col("n").alias("a"))
    two = _word(_word(coded, hot, 1, 2, "lang"), hot, 2, 2)
    pair = lambda name: coded.select(F.col("code").alias(f"_{name}"), F.col("a").alias(name))
    three = (
        threes.where("code >= 0")
        .select("code", F.col("n").alias("a"))
        .withColumns(
            {
                "_l2": F.shiftright("code", ID_BITS),
                "_r1": F.col("code").bitwiseAND(F.lit((1 << 2 * ID_BITS) - 1)),
            }
        )
        .join(pair("l2"), "_l2")
        .join(pair("r1"), "_r1")
    )
    three = _word(_word(_word(three, hot, 1, 3, "lang"), hot, 2, 3), hot, 3, 3)
    columns = ("lang", "w1", "w2", "a", "f1", "f2")
    two = two.select(*columns)
    three = three.select("lang", "w1", "w2", "w3", "a", "f1", "f3", "l2", "r1")
    # The others are joined by their words. A frequent word meets many phrases: its key is split where that is large.
    word = counts.where(F.col("n") >= least).select("lang", F.col("word").cast("string").alias("w"), F.col("n").alias("f"))
    one = lambda place: word.select("lang", F.col("w").alias(f"w{place}"), F.col("f").alias(f"f{place}"))
    plain = _plain(found, 2).withColumnRenamed("n", "a").join(one(1), ["lang", "w1"]).join(one(2), ["lang", "w2"])
    two = stored(two.unionByName(plain.select(*columns)), "spelled-pairs")
    inner = lambda x, y, name: two.select("lang", F.col("w1").alias(x), F.col("w2").alias(y), F.col("a").alias(name))
    plain = (
        _plain(threes, 3)
        .withColumnRenamed("n", "a")
        .join(inner("w1", "w2", "l2"), ["lang", "w1", "w2"])
        .join(inner("w2", "w3", "r1"), ["lang", "w2", "w3"])
        .join(one(1), ["lang", "w1"])
        .join(one(3), ["lang", "w3"])
    )
    three = three.unionByName(plain.select(*three.columns))
    three = three.withColumns(
        {
            "s1": _score(F.col("a"), F.col("f1"), F.col("r1")),
            "s2": _score(F.col("a"), F.col("l2"), F.col("f3")),
        }
    )
    three = stored(three, "scored-triples")
    cuts = {"l": ("f1", "l2"), "r": ("r1", "f3"), "score": ("s1", "s2")}
    best = three.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        *(F.when(F.col("s2") < F.col("s1"), F.col(c2)).otherwise(F.col(c1)).alias(name) for name, (c1, c2) in cuts.items()),
    )
    inside = three.where(2 * F.col("a") >= F.col("l2")).select("lang", "w1", "w2").union(
        three.where(2 * F.col("a") >= F.col("r1")).select("lang", "w2", "w3")
    )
    free = two.join(inside.distinct(), ["lang", "w1", "w2"], "left_anti")
    free = free.select(
        "lang",
        F.concat_ws(" ", "w1", "w2").alias("phrase"),
        "a",
        F.col("f1").alias("l"),
        F.col("f2").alias("r"),
        _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = free.unionByName(best).withColumn("rank", F.row_number().over(order).cast("bigint"))
    total = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.where(F.col("rank") <= top).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
