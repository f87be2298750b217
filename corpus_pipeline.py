"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.llm import dedup, mixing, packing, quality, toxicity
from courierlake.llm.common import ship, stored, table, word_count

LEAST_QUALITY, MOST_TOXIC = 0.3, 0.5
SOURCE_WEIGHTS = [1, 2, 3]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble doesn't reject.

    NULL texts are scored as empty ones. Every row is judged by its own text,
    so repeated rows go or stay together; those without an id are judged alike.
    """
    ship(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality")
    # Written before it is filtered on: the optimizer would carry the whole rule
    # ensemble through its predicates otherwise.
    scored = stored(quality.with_score(docs, model, "_quality"), "quality")
    return scored.where(F.col("_quality") >= LEAST_QUALITY).drop("_quality")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxic passages don't make them toxic.

    NULL, empty and wordless texts have no passages and stay. Repeated rows and
    those without an id are judged by their text like all others.
    """
    ship(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic")
    return toxicity.with_score(docs, model, "_toxic").where(F.col("_toxic") < MOST_TOXIC).drop("_toxic")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8).

    The smallest id of a group stays, repeated rows of it too; texts without
    words and rows without an id stay (see :func:`dedup.first_of_each`).
    """
    ship(spark)
    return dedup.first_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix of their sources asks for.

    A document without words is repeated with its source but weighs nothing; a
    NULL source is one of its own, the last. Ties of the seeded order go by id
    and text.
    """
    ship(spark)
    key = ("doc_id", "source", F.xxhash64("text").alias("_text"))
    sized = stored(docs.select(*key, word_count(F.col("text")).alias("size")), "mix-sizes")
    # The document as one column: none of its own names meets those of the mix.
    rows = docs.select(F.struct("*").alias("_document"), *key)
    mixed = mixing.with_repetitions(rows, sized, SOURCE_WEIGHTS, ["doc_id", "_text"], seed=1)
    return mixing.repeat_rows(mixed, F.col("repeats")).select("_document.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences of 2048.

    NULL texts count as empty and make one piece, their end; repeated rows are
    packed as often as they occur.
    """
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("near duplicates", dedup_stage),
    ("source mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

# The classifiers have no SQL form; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
