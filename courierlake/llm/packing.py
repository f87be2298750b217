"""Packing token sequences into bins of fixed size, as few as can be.

Texts longer than a bin are cut into full bins; what remains is a bin packing
problem over a histogram of at most `capacity` lengths. Its configuration
linear program (one variable per way to fill a bin) is solved approximately
in full steps: lengths that are covered least weigh most, a knapsack dynamic
program finds the most valuable configuration, and it is used until one of its
lengths is covered. The solution
is rounded down to whole bins without a gap; the rest, however much it is, is
packed by best fit, longest first and equal bins at once. All of that works on
the histogram, whose size doesn't depend on the number of documents. Spark then
numbers the pieces of each length and looks up their places.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from itertools import count
from string import punctuation
from unicodedata import is_normalized

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import id_and_text, stored, with_number_id

CAPACITY = 2048
# How fast a weight falls with coverage, and the most of a demand that one
# iteration of the weights method (one knapsack program) covers.
RATE = 4.0
# Long pieces are the hard ones to place: values grow faster than lengths.
POWER = 1.2
STEP = 1.0
# Pieces of one length are numbered in this many groups at once.
NUMBER_GROUPS = 64
# Distinct words a Python worker keeps the ids of, about 130 MB.
CACHED_WORDS = 600_000
# Further ones it keeps until there are as many.
LATE_WORDS = 100_000

PIECES = "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint"


class WordIds(dict):
    """Token ids of texts, word by word; a dictionary of the words met so far.

    The tokenizer folds case, drops white space and never joins what white
    space parts, so the ids of a text are those of its words. Neither does it
    join letters, digits and other characters: most words are put together from
    such pieces, which the model spells itself. Ids are kept as bytes of
    little-endian 32-bit integers.
    """

    # Special tokens are found in the raw text; texts with anything like them
    # are left whole.
    SPECIAL = b"<|"
    # The model spells bytes as characters: printable ones as themselves, the
    # others as those from 256 on.
    SPELLED = {
        b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])
    }
    # How the tokenizer cuts a printable lower-case ASCII word.
    PRINTABLE = re.compile(rb"[!-@\[-~]+")
    CUT = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    MARKS = punctuation.encode()
    # Letters below this one are lower-cased one by one, as the tokenizer does.
    LATIN = "\u0250"

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.spell = self.tokenizer.model.tokenize
        # What is met once there are CACHED_WORDS, for as long as there is room.
        self.late: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        """Ids of a word that isn't held."""
        ids = self.late.get(word)
        if ids is None:
            ids = self._new(word)
            if len(self) < CACHED_WORDS:
                self[word] = ids
            else:
                if len(self.late) >= LATE_WORDS:
                    self.late.clear()
                self.late[word] = ids
        return ids

    def _whole(self, text: bytes) -> bytes:
        found = self.tokenizer.encode(text.decode(), add_special_tokens=False)
        return np.asarray(found.ids, "<u4").tobytes()

    def _new(self, word: bytes) -> bytes:
        if word.isalpha():
            return self._spelled(word.decode())
        if word.isascii():
            if not self.PRINTABLE.fullmatch(word):
                return self._whole(word)
            pieces = self.CUT.findall(word)
            return b"".join(map(self._piece, pieces)) if len(pieces) > 1 else self._spelled(word.decode())
        stem = word.rstrip(self.MARKS)
        if len(stem) < len(word) and stem.decode()[-1].lower().isalpha():
            # Marks that follow a letter are a piece of their own.
            return self._piece(stem) + self[word[len(stem) :]]
        text = word.decode()
        if text.isalpha() and is_normalized("NFC", text):
            folded = text.lower()
            if folded == text or (max(text) < self.LATIN and folded.isalpha()):
                return self._spelled(folded.encode().decode("latin-1").translate(self.SPELLED))
        return self._whole(word)

    def _piece(self, piece: bytes) -> bytes:
        """Ids of a part of a word; only short ones are worth a place among the words."""
        return (self.get(piece) or self._new(piece)) if len(piece) > 3 else self[piece]

    def _spelled(self, text: str) -> bytes:
        tokens = [t.id for t in self.spell(text)]
        return struct.pack(f"<{len(tokens)}I", *tokens)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        ids = self.__getitem__
        return [self._whole(t) if self.SPECIAL in t else b"".join(map(ids, t.lower().split())) for t in texts]


_ENCODERS: dict[str, WordIds] = {}


def word_ids(tokenizer: str) -> WordIds:
    """The encoder of this Python worker for the named vocabulary or file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if tokenizer not in _ENCODERS:
        if "/" in tokenizer:
            file = tokenizer
        else:
            import public_tokenizers

            file = public_tokenizers.path(tokenizer)
        _ENCODERS[tokenizer] = WordIds(file)
    return _ENCODERS[tokenizer]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of the tokenized documents: doc_id, piece, start, length, ids_crc32.

    `tokenizer` names a public vocabulary or a file every executor has. A
    document is its ids plus `end_id`; NULL and empty texts are the end alone.
    Only documents longer than `capacity` are cut, the last piece is the rest.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_ids(tokenizer)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            # Some documents at a time, however large the batch is.
            for at in range(0, len(batch), 500):
                some = batch.iloc[at : at + 500]
                texts = [b"" if t is None else t.encode() for t in some["text"]]
                for doc, ids in zip(some["doc_id"], encoder.encode(texts)):
                    ids += end
                    for number, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        rows.append((doc, number, start // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return with_number_id(id_and_text(docs).mapInPandas(cut, PIECES))


def best_configuration(values: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """Most valuable multiset of lengths that fits the capacity (unbounded knapsack)."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        best[room], choice[room] = best[room - 1], 0
        fits = np.searchsorted(lengths, room, "right")
        if fits:
            total = values[:fits] + best[room - lengths[:fits]]
            at = int(total.argmax())
            if total[at] > best[room]:
                best[room], choice[room] = total[at], lengths[at]
    found: dict[int, int] = {}
    room = capacity
    while room > 0:
        length = int(choice[room])
        if length:
            found[length] = found.get(length, 0) + 1
            room -= length
        else:
            room -= 1
    return found


def configuration_lp(
    histogram: Mapping[int, int], capacity: int = CAPACITY, iterations: int | None = None
) -> list[tuple[dict[int, int], float]]:
    """Fractional bins per configuration that cover the histogram, nearly fewest.

    Covering by exponential weights in full steps: the weight of a length falls
    exponentially with how far its demand is covered, to 0 when it is. Each
    iteration takes the best configuration for these weights, in the largest
    amount that covers no length by more than `STEP` of its demand. With full
    steps each one covers some length entirely, so without a limit of iterations
    all lengths are covered.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[int(n)] for n in lengths], dtype=float)
    covered = np.zeros(len(lengths))
    amounts: dict[tuple, float] = {}
    place = {int(n): i for i, n in enumerate(lengths)}
    for _ in count() if iterations is None else range(iterations):
        open_ = covered < 1 - 1e-9
        if not open_.any():
            break
        # Value per piece: more than its share of a bin if long, more if covered less.
        values = lengths[open_] ** POWER * np.exp(-RATE * covered[open_])
        found = best_configuration(values, lengths[open_], capacity)
        amount = min(demand[place[n]] * min(STEP, 1 - covered[place[n]]) / k for n, k in found.items())
        key = tuple(sorted(found.items()))
        amounts[key] = amounts.get(key, 0.0) + amount
        for n, k in found.items():
            covered[place[n]] += amount * k / demand[place[n]]
    return [(dict(key), amount) for key, amount in amounts.items()]


def best_fit_counts(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Bins by best fit, longest pieces first, as configurations and their numbers.

    A piece goes to the fullest bin it fits in, and the next of its length to
    the same bin as long as it fits; bins filled alike are taken at once. The
    steps depend on lengths and configurations, not on how many pieces there are.
    """
    rooms: list[int] = []  # sorted distinct rooms
    bins: dict[int, dict[tuple, int]] = {}

    def put(filled: tuple, length: int, each: int, number: int, room: int) -> None:
        """`number` bins with `each` more pieces of `length`, which leave `room`."""
        if room not in bins:
            bins[room] = {}
            insort(rooms, room)
        filled += ((length, each),)
        bins[room][filled] = bins[room].get(filled, 0) + number

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                filled, number, room = (), left, capacity
            else:
                room = rooms[at]
                filled, number = bins[room].popitem()
            each = min(room // length, left)
            whole = min(left // each, number)
            if at < len(rooms):
                if number > whole:
                    bins[room][filled] = number - whole
                elif not bins[room]:
                    rooms.pop(at)
                    del bins[room]
            put(filled, length, each, whole, room - each * length)
            left -= each * whole
    return [(dict(filled), number) for same in bins.values() for filled, number in same.items()]


def best_fit(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[dict[int, int]]:
    """The same, one entry per bin."""
    return [filled for filled, number in best_fit_counts(histogram, capacity) for _ in range(number)]


def plan_bins(
    histogram: Mapping[int, int], capacity: int = CAPACITY, iterations: int | None = None
) -> list[tuple[dict[int, int], int]]:
    """Whole bins per configuration that pack the histogram exactly.

    Of the program's configurations only those that fill a bin are used whole:
    bins without a gap can't be among the wasted ones.
    """
    left = {n: k for n, k in histogram.items() if k > 0}
    plan: list[tuple[dict[int, int], int]] = []
    if left.get(capacity):
        plan.append(({capacity: 1}, left.pop(capacity)))
    if not left:
        return plan
    for found, amount in sorted(configuration_lp(left, capacity, iterations), key=lambda x: -x[1]):
        empty = capacity - sum(n * k for n, k in found.items())
        whole = min(int(amount), *(left.get(n, 0) // k for n, k in found.items()))
        if whole > 0 and empty == 0:
            plan.append((found, whole))
            for n, k in found.items():
                left[n] -= k * whole
    return plan + best_fit_counts({n: k for n, k in left.items() if k}, capacity)


def places_of(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by their number within the length.

    One entry per configuration and length: from piece number `first` on,
    `each` pieces per bin, starting at bin `bin` and offset `offset`.
    """
    used: dict[int, int] = {}
    entries, bin_at = [], 0
    for found, count in plan:
        offset = 0
        for n in sorted(found, reverse=True):
            k = found[n]
            entries.append((n, used.get(n, 0), k, bin_at, offset))
            used[n] = used.get(n, 0) + k * count
            offset += n * k
        bin_at += count
    entries.sort()
    columns = np.array(entries, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "each", "bin", "offset"), columns))


def numbered_in_length(pieces: DataFrame) -> DataFrame:
    """Add `_number`, from 0 within each length; a length is spread over groups of its pieces."""
    order = ["doc_id", "piece", "start", "ids_crc32"]
    keyed = pieces.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(NUMBER_GROUPS)).cast("int"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("length", "_group")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col("length").alias("_length"),
            F.col("_group").alias("_at"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        )
    )
    inside = F.row_number().over(Window.partitionBy("length", "_group").orderBy(*order))
    # At most capacity x NUMBER_GROUPS rows of starts.
    return (
        keyed.withColumn("_inside", inside)
        .join(starts, (F.col("length") == F.col("_length")) & (F.col("_group") == F.col("_at")))
        .withColumn("_number", F.col("_start") + F.col("_inside") - 1)
        .drop("_group", "_inside", "_length", "_at", "_start")
    )


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, iterations: int | None = None) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces of 1 to `capacity` tokens.

    The plan is broadcast: its size is bounded by the lengths.
    Pieces equal in all columns are interchangeable. An empty table stays empty.
    """
    pieces = stored(pieces, "pieces")
    # At most `capacity` rows.
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = places_of(plan_bins(counts, capacity, iterations))
    shared = pieces.sparkSession.sparkContext.broadcast(places)

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = shared.value
        # One ascending key over length and number.
        keys = (at["length"] << 50) + at["first"]
        for batch in batches:
            number = batch.pop("_number").to_numpy()
            i = np.searchsorted(keys, (batch["length"].to_numpy() << 50) + number, "right") - 1
            within = number - at["first"][i]
            batch["sequence_id"] = at["bin"][i] + within // at["each"][i]
            batch["offset"] = at["offset"][i] + within % at["each"][i] * batch["length"]
            yield batch

    numbered = numbered_in_length(pieces).select(*pieces.columns, "_number")
    numbered = numbered.withColumn("doc_id", F.col("doc_id").cast("string"))
    return with_number_id(numbered.mapInPandas(put, f"{PIECES}, sequence_id bigint, offset bigint"))


def pack_documents(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """Tokenize `docs` (doc_id, text), cut what is too long, and pack the pieces."""
    return pack_pieces(token_pieces(docs, tokenizer, capacity, end_id), capacity)
