"""The pipeline's stages, each against what its input calls for."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courierlake.llm import queries as corpus
from courierlake.llm.common import label_fold
from parity.check import compare, connect

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(corpus.oracle_sql()))
def test_query_matches_sql(spark, name):
    ours = [row.asDict() for row in corpus.queries()[name](spark, DATA).collect()]
    cursor = connect(DATA).execute(corpus.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert compare(ours, [dict(zip(names, row)) for row in cursor.fetchall()]) == ""


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    columns = docs.columns
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], DATA).cache())
        assert kept[-1].columns == columns
    _, good, clean, single, mixed = kept
    # Learned labels take effect.
    known = labels.where(label_fold(F.col("doc_id"), 5) != 0)
    low = known.where("quality = 0")
    assert good.join(low, "doc_id", "left_semi").count() <= 0.2 * low.count()
    fine = known.where("quality = 1")
    assert good.join(fine, "doc_id", "left_semi").count() >= 0.97 * fine.count()
    assert clean.count() <= good.count()
    # One of each group stays, and every group keeps one.
    texts = [r.text for r in single.select("text").collect()]
    assert len(texts) == len(set(texts)) and 0 < single.count() <= clean.count()
    assert mixed.select("doc_id").distinct().join(single, "doc_id", "left_anti").count() == 0
    packed = corpus_pipeline.packing_stage(spark, mixed, DATA).toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
    pieces = packed[packed["piece"] == 0]
    assert len(pieces) == mixed.count()


def test_stages_take_any_columns_and_no_rows(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, None, None), (2, "", "y"), (3, "t " * 900, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    names = ("target", "whole", "cut", "repeats", "size", "label", "source_size", "score", "_text", "key")
    docs = docs.select("*", *(F.lit(1).alias(name) for name in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).columns == docs.columns
        assert stage(spark, docs.where("false"), DATA).count() == 0
    mixed = corpus_pipeline.mixing_stage(spark, docs, DATA)
    assert mixed.count() > 0 and mixed.where("doc_id = 1").count() % 2 == 0
    assert corpus_pipeline.packing_stage(spark, docs.where("false"), DATA).count() == 0


def test_run_and_entry(spark):
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries()
    assert corpus_pipeline.run(spark, DATA).count() > 0
