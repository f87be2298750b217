"""The corpus operators applied to the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.llm import dedup, interactions, lm, mixing, packing, phrases, pii, quality, sharding, topk, toxicity, warc, winnow
from courierlake.llm.common import WORD, ship, stored, table, word_count
from courierlake.llm.labelled import held_out
from courierlake.session import scratch_path

SHARDS = 40
NEAREST = 10
PAGES_PER_FILE = 1000


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards whose row counts differ by at most one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digests = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.shard_rows(digests, SHARDS, seed=1).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest codes of every hundredth vector among all vectors."""
    codes = stored(
        table(spark, folder, "embeddings").select(
            F.col("vec_id").alias("id"), topk.sign_code(F.col("embedding")).alias("code")
        ),
        "codes",
    )
    return topk.nearest(codes, codes.where(F.col("id") % 100 == 0), k=NEAREST)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document by its maximum-scoring segments."""
    scores = toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scores.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op4_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    """log10 probabilities of all documents under a probabilistic suffix tree."""
    return lm.score_texts(table(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document by a sparse rule ensemble."""
    scores = quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a mix with source weights 1, 2, 3 and at most 3 epochs."""
    sized = stored(
        table(spark, folder, "documents").select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_text")
        ),
        "mix-sizes",
    )
    taken = mixing.with_repetitions(sized, sized, [1, 2, 3], ["doc_id", "_text"], seed=1)
    return taken.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("repeats")).alias("taken"),
        "source",
        "repeats",
    )


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components: three-word shingles, similarity 0.85 or more."""
    found = dedup.near_duplicates(table(spark, folder, "documents"), width=3, percent=85)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.withColumn("kept", kept)


def op8_warc_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All pages in WARC files, audited against a damaged replica of the files.

    In the replica, a bit of the last byte is flipped in the records of every
    61st page, and a hole of zero bytes stands for those of every 67th page.
    """

    def damaged(record_id: str | None, record: bytes) -> bytes:
        if record_id and int(record_id) % 67 == 0:
            return bytes(len(record))
        if record_id and int(record_id) % 61 == 0:
            return record[:-1] + bytes([record[-1] ^ 1])
        return record

    path = scratch_path(spark, "warc")
    warc.write_warc(warc.archive(table(spark, folder, "pages"), PAGES_PER_FILE), f"{path}/primary")
    warc.rewrite(spark, f"{path}/primary", f"{path}/replica", damaged)
    number = F.regexp_extract("path", r"pages-(-?\d+)\.warc", 1).cast("bigint").alias("file")
    sides = [
        stored(warc.read_warc(spark, f"{path}/{side}", content=False).select(number, "offset", "length", "hash", "record_id"), side)
        for side in ("primary", "replica")
    ]
    found = stored(warc.audit(*sides), "audit")
    return (
        sides[0]
        .select(F.col("record_id").try_cast("bigint").alias("page_id"), "file", "offset", "length", F.col("hash").alias("sha256"))
        .join(found, ["file", "offset"], "left")
        .withColumn("status", F.coalesce("status", F.lit("intact")))
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"))


def op10_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document, its edited text, and their likeness."""
    return winnow.compare_with_edits(table(spark, folder, "documents"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove of every source, in every order, and their fair shares."""
    return interactions.interaction_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: base spans, and those that boosted trees add."""
    return pii.find_spans(table(spark, folder, "documents"))


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 collocations of two and three words of every language."""
    return phrases.collocations(table(spark, folder, "documents"), top=2000, least=10)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """`query` with this package at hand on the executors."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {
        "op1_sharding": op1_sharding,
        "op2_topk": op2_topk,
        "op3_toxicity": op3_toxicity,
        "op4_suffix_tree": op4_suffix_tree,
        "op5_quality": op5_quality,
        "op6_mixing": op6_mixing,
        "op7_minhash": op7_minhash,
        "op8_warc_audit": op8_warc_audit,
        "op9_packing": op9_packing,
        "op10_winnowing": op10_winnowing,
        "op11_filter_audit": op11_filter_audit,
        "op12_personal_data": op12_personal_data,
        "op13_phrases": op13_phrases,
    }
    return {name: shipped(query) for name, query in named.items()}


# The same results in DuckDB, where its SQL can state them.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = {
    "op7_minhash": f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1),
            lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS shingles
    FROM words
), shingled AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, len(any_value(s.shingles))::BIGINT AS n_shingles, min(r.other) AS component_id,
    s.doc_id = min(r.other) AS kept
FROM sets s JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id""",
    "op2_topk": f"""
WITH signs AS (
    SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings WHERE embedding IS NOT NULL
), pairs AS (
    SELECT q.vec_id AS query_id, p.vec_id AS neighbor_id,
        list_sum(list_transform(range(1, len(q.code) + 1), lambda i: (q.code[i] <> p.code[i])::INT))::INT AS distance
    FROM signs q JOIN signs p ON q.vec_id <> p.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank FROM pairs
)
SELECT query_id, neighbor_id, distance, rank FROM ranked WHERE rank <= {NEAREST}""",
    "op8_warc_audit": f"""
WITH parts AS (
    SELECT page_id, (page_id // {PAGES_PER_FILE})::BIGINT AS file,
        concat_ws(chr(13) || chr(10), 'WARC/1.0', 'WARC-Type: resource',
            'WARC-Record-ID: <urn:x-record:' || page_id || '>', 'WARC-Target-URI: ' || url,
            'WARC-Payload-Digest: sha256:' || sha256(html), 'Content-Length: ' || strlen(html))
            || chr(13) || chr(10) || chr(13) || chr(10) || html AS record
    FROM pages
)
SELECT page_id, file, coalesce(sum(strlen(record) + 4) OVER (PARTITION BY file ORDER BY page_id, record
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset",
    strlen(record)::BIGINT AS length, sha256(record) AS sha256,
    CASE WHEN page_id % 67 = 0 THEN 'missing' WHEN page_id % 61 = 0 THEN 'damaged' ELSE 'intact' END AS status
FROM parts""",
    "op11_filter_audit": f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
    FROM documents
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), told AS (
    SELECT part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
        + 8 * regexp_matches(text, '[#$%&*|]')::INT
        + 16 * coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)::INT AS failed,
        coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM texts LEFT JOIN marks USING (doc_id)
), sets AS (
    SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM told GROUP BY ALL
), filters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
    SELECT '' AS o, 0 AS used UNION ALL
    SELECT o || f, used + bit FROM orders JOIN filters ON used & bit = 0 WHERE length(o) < 5
), steps AS (
    SELECT o, unnest(range(1, 6))::INT AS step FROM orders WHERE length(o) = 5
), masked AS (
    SELECT o, step, f, bit, (SELECT coalesce(sum(g.bit), 0) FROM filters g WHERE contains(left(o, step - 1), g.f))::INT AS gone
    FROM steps JOIN filters ON f = o[step]
), counted AS (
    SELECT part, o AS filter_order, step, f, coalesce(sum(n) FILTER (failed & (gone | bit) = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (failed & gone = 0 AND failed & bit > 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (failed & gone > 0 AND failed & bit > 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (failed = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (failed & gone = 0 AND failed & bit > 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (failed & gone = 0 AND failed & bit > 0), 0)::BIGINT AS toxic_lost
    FROM sets, masked GROUP BY ALL
)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM counted""",
    "op13_phrases": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(""" + _LOWER + r""", '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), one AS (
    SELECT lang, w, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(w) AS w FROM cut) GROUP BY ALL
), total AS (
    SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang
), two AS (
    SELECT lang, p.x, p.y, count(*)::HUGEINT AS f FROM (
        SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: {'x': w[i], 'y': w[i + 1]})) AS p FROM cut
    ) GROUP BY ALL HAVING count(*) >= 10
), three AS (
    SELECT lang, p.x, p.y, p.z, count(*)::HUGEINT AS f FROM (
        SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: {'x': w[i], 'y': w[i + 1], 'z': w[i + 2]})) AS p
        FROM cut
    ) GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
    SELECT t.lang, concat_ws(' ', t.x, t.y) AS phrase, t.f AS a, l.f AS l, r.f AS r, 1 AS k
    FROM two t JOIN one l ON l.lang = t.lang AND l.w = t.x JOIN one r ON r.lang = t.lang AND r.w = t.y
    WHERE NOT EXISTS (
        FROM three u WHERE u.lang = t.lang AND 100 * u.f >= 50 * t.f
        AND ((u.x = t.x AND u.y = t.y) OR (u.y = t.x AND u.z = t.y))
    )
    UNION ALL
    SELECT t.lang, concat_ws(' ', t.x, t.y, t.z), t.f, l.f, r.f, 1
    FROM three t JOIN one l ON l.lang = t.lang AND l.w = t.x
    JOIN two r ON r.lang = t.lang AND r.x = t.y AND r.y = t.z
    UNION ALL
    SELECT t.lang, concat_ws(' ', t.x, t.y, t.z), t.f, l.f, r.f, 2
    FROM three t JOIN two l ON l.lang = t.lang AND l.x = t.x AND l.y = t.y
    JOIN one r ON r.lang = t.lang AND r.w = t.z
), lowest AS (
    SELECT *, (1000000 * a * a) // (l * r) AS score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY (1000000 * a * a) // (l * r), k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank FROM lowest
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
