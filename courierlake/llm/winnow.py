"""Document fingerprints by winnowing.

Text is cut into pieces: words, and of a run of more than 16 characters without
a blank every 16 characters in a row, wherever they start. A passage of such a
run therefore gives the same pieces at any offset. Rolling hashes of k pieces are taken, and of every window of w consecutive
hashes the smallest is kept, the rightmost one on ties, with its position. A
run of w + k - 1 pieces shared by two texts is thereby always found in both.

Only column expressions run here; every step is one pass over an array.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import WORD

GRAM = 3
WINDOW = 4
PIECE = 16
# Matched ahead of every place of a long run.
AHEAD = rf"(?=([^\x20\x09-\x0D]{{{PIECE}}}))"
# A kept hash and its position share one long, 31 bits each. Arrays have fewer
# than 2^31 elements.
POSITION_BITS = 31
LAST_POSITION = (1 << POSITION_BITS) - 1
MULTIPLIER = 1_000_003
MODULUS = (1 << 31) - 1

# Documents per bucket of the id order, and the most buckets there are; the
# bounds of the buckets are the only thing that reaches the driver.
BUCKET_DOCUMENTS = 128
MOST_BUCKETS = 1 << 14


def _tail(values: Column, start: int) -> Column:
    """`values` from element `start` (0-based) on."""
    return F.slice(values, F.lit(start + 1), F.size(values))


def _head(values: Column, without: int) -> Column:
    """`values` without its last `without` elements, but at least one if there are any."""
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - without, F.lit(1)))


def with_winnowed(df: DataFrame, texts: Mapping[str, str], gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add the kept hashes with positions of the columns in `texts` (new name -> text column).

    Elements are longs in order of position, see :func:`hash_of` and
    :func:`position_of`. NULL and empty texts have none. A text of fewer than
    `gram` pieces has one hash, of all its pieces; a text with fewer hashes
    than a window keeps the smallest of them.

    Every array that is used twice is a column of its own: Spark would compute
    a nested expression once per use.
    """
    names = list(texts)
    df = df.withColumns(
        {n: F.regexp_extract_all(F.coalesce(F.col(texts[n]), F.lit("")), F.lit(WORD), F.lit(0)) for n in names}
    )
    df = df.withColumns({n: F.transform(_pieces(F.col(n)), lambda p: F.crc32(p.cast("binary"))) for n in names})

    def rolled(hashes: Column) -> Column:
        result = hashes
        for shift in range(1, gram):
            result = F.zip_with(result, _tail(hashes, shift), _roll)
        return result

    df = df.withColumns({n: rolled(F.col(n)) for n in names})
    keyed = {n: F.transform(_head(F.col(n), gram - 1), _keyed) for n in names}
    df = df.withColumns(keyed)
    # Minima over 2, 4, ... hashes come from two shorter ones, which may overlap.
    have = 1
    while have < window:
        shift = min(have, window - have)
        df = df.withColumns({n: F.zip_with(n, _tail(F.col(n), shift), lambda a, b: F.least(a, b)) for n in names})
        have += shift
    return df.withColumns({n: F.array_distinct(_head(F.col(n), window - 1)) for n in names})


def _pieces(words: Column) -> Column:
    """The words themselves, unless one is longer than a piece: few texts have such."""
    is_long = lambda w: F.char_length(w) > PIECE
    cut = F.transform(
        words, lambda w: F.when(is_long(w), F.regexp_extract_all(w, F.lit(AHEAD), F.lit(1))).otherwise(F.array(w))
    )
    return F.when(F.exists(words, is_long), F.flatten(cut)).otherwise(words)


def _roll(sofar: Column, piece: Column) -> Column:
    """Hash of a run, one piece longer; a piece beyond the end counts as 0."""
    mixed = F.coalesce(sofar, F.lit(0)) * F.lit(MULTIPLIER) + F.coalesce(piece, F.lit(0))
    return F.pmod(mixed, F.lit(MODULUS))


def _keyed(rolled: Column, place: Column) -> Column:
    """Scrambled hash above the reversed position: the minimum is the rightmost smallest hash."""
    scrambled = F.shiftrightunsigned(F.xxhash64(rolled), 32)
    return F.shiftleft(scrambled.bitwiseAND(F.lit(LAST_POSITION)), POSITION_BITS) + (F.lit(LAST_POSITION) - place)


def hash_of(kept: Column) -> Column:
    return F.shiftright(kept, POSITION_BITS)


def position_of(kept: Column) -> Column:
    return F.lit(LAST_POSITION) - kept.bitwiseAND(F.lit(LAST_POSITION))


def hash_set(kept: Column) -> Column:
    return F.array_distinct(F.transform(kept, hash_of))


def as_text(kept: Column) -> Column:
    """Fingerprint as text: hash and position of every kept hash, in hex."""
    return F.array_join(F.transform(kept, F.hex), " ")


def likeness(left: Column, right: Column) -> Column:
    """Twice the shared hashes over the hashes of both (Dice); 1 for two empty sets."""
    both = F.size(left) + F.size(right)
    shared = F.size(F.array_intersect(left, right))
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * shared / both)


def id_bounds(docs: DataFrame) -> list[int]:
    """Ids that cut the documents into buckets of about equal size, ascending.

    Every bound is the id of a document, the first one the smallest. A
    quantile sketch of the id column gives at most `MOST_BUCKETS` bounds.
    """
    seen = docs.agg(F.count("doc_id").alias("n"), F.min("doc_id").alias("least")).first()
    if not seen["n"]:
        return []
    buckets = min(MOST_BUCKETS, max(1, seen["n"] // BUCKET_DOCUMENTS))
    steps = F.array(*(F.lit(i / buckets) for i in range(1, buckets)))
    if buckets == 1:
        return [seen["least"]]
    cuts = docs.agg(F.percentile_approx("doc_id", steps, 10 * buckets).alias("cuts")).first()["cuts"]
    return sorted({seen["least"], *cuts})


def _bucket_of(key: Column, bounds: list[int]) -> Column:
    """Number of the last bound that is not above `key`: two short searches."""
    width = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    heads = F.array(*(F.lit(b[0]).cast("bigint") for b in blocks))
    all_blocks = F.array(
        *(F.array(*(F.lit(x).cast("bigint") for x in b)) for b in blocks)
    )
    block = F.greatest(F.size(F.filter(heads, lambda x: x <= key)) - 1, F.lit(0))
    inside = F.size(F.filter(F.get(all_blocks, block), lambda x: x <= key)) - 1
    return block * width + F.greatest(inside, F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` and `next_text`: the text of the document with the next id.

    After the last id comes the first. Documents are dealt to buckets of the
    id order once; the first document of each bucket also goes to the bucket
    before it, as its end. Rows of one id follow each other by text, NULL ids
    come last. A single document is its own next one; NULL texts count as
    empty. One id must not hold more rows than a task can sort on disk.
    """
    bounds = id_bounds(docs)
    # NULL ids share the bucket of the largest id; if all are NULL there is one bucket.
    key = F.coalesce(F.col("doc_id"), F.lit(bounds[-1] if bounds else 0)).cast("bigint")
    bounds = bounds or [0]
    last = len(bounds) - 1
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "_bucket", _bucket_of(key, bounds)
    )
    bound_at = F.get(F.array(*(F.lit(x).cast("bigint") for x in bounds)), F.col("_bucket"))
    heads = key == bound_at
    previous = F.when(F.col("_bucket") == 0, F.lit(last)).otherwise(F.col("_bucket") - 1)
    places = F.array(F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("end")))
    ends = F.array(F.struct(previous.alias("bucket"), F.lit(1).alias("end")))
    dealt = keyed.withColumn("_place", F.explode(F.when(heads, F.concat(places, ends)).otherwise(places)))
    order = Window.partitionBy("_b").orderBy(
        "_end", F.col("doc_id").asc_nulls_last(), F.col("text").asc()
    )
    return (
        dealt.select("doc_id", "text", F.col("_place.bucket").alias("_b"), F.col("_place.end").alias("_end"))
        .withColumn("next_text", F.lead("text").over(order))
        .where(F.col("_end") == 0)
        .select("doc_id", "text", F.coalesce("next_text", "text").alias("next_text"))
    )


def edited_text(text: Column, next_text: Column) -> Column:
    """`text` with its last floor(n/2) characters replaced by the first ones of `next_text`."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """`doc_id`, `n_chars` and `kept`, the winnowed hashes with positions."""
    chars = F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint")
    texts = docs.select("doc_id", "text", chars.alias("n_chars"))
    return with_winnowed(texts, {"kept": "text"}, gram, window).drop("text")


def compare_with_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each document against its edited text and against the next document.

    One row per row of `docs`; the fingerprints are those of `with_winnowed`
    as text, the likenesses compare their hashes without positions.
    """
    pairs = with_next(docs)
    pairs = pairs.withColumn("_edited_text", edited_text(F.col("text"), F.col("next_text")))
    kept = with_winnowed(pairs, {"_kept": "text", "_edited": "_edited_text", "_next": "next_text"}, gram, window)
    sets = kept.withColumns({f"{c}_set": hash_set(F.col(c)) for c in ("_kept", "_edited", "_next")})
    return sets.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("_edited_text").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("_kept")).alias("fingerprint"),
        as_text(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_kept_set"), F.col("_edited_set")).alias("near_edited"),
        likeness(F.col("_kept_set"), F.col("_next_set")).alias("near_next"),
    )
