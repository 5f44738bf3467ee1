"""The pipeline and the registered queries of the subpackage."""

from __future__ import annotations

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from topicframe.llm import attention_mil
from topicframe.llm.queries import ORACLES, QUERIES

from ..compare import connect, differences
from . import brute
from .test_operators import tokens

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = attention_mil.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = attention_mil.scored(docs, model).where("predicted = 1").select("doc_id", "text").collect()
    kept = [(r.doc_id, r.text) for r in good]
    near = brute.near_wide(kept)
    kept = [(i, t) for i, t in kept if near[i] == i]
    texts = dict(kept)
    gone = brute.repeated_words(kept)
    kept = [(i, brute.without_repeats(kept)[i] if gone[i][1] else texts[i]) for i, _ in kept]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = brute.contaminated(kept, items)
    kept = [(i, t) for i, t in kept if not hit[i][1]]
    want = {i: len(ids) for i, ids in tokens(kept).items()}
    rows = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in rows} == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("part", F.lit(1)).withColumn("others", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        assert 0 < out.count() <= docs.count()


def test_rows_that_share_an_id(spark):
    one, other, third = "the quick brown fox jumps over the dog", "nothing in here is like the first text at all", "and a last one that stands for itself here"
    rows = [(1, one, "a"), (1, other, "b"), (1, one, "a"), (2, one, "c"), (3, third, "d"), (None, third, "e"), (None, third, "e"), (4, None, "f"), (5, "", "g")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _place string")
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id or 0, r.text or "", r._place) for r in out.collect()) == sorted([(1, one, "a"), (1, other, "b"), (3, third, "d"), (0, third, "e"), (0, third, "e"), (4, "", "f")])


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    rows = entry.queries()[name](spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    if "doc_id" in rows.columns and name != "op9_best_fit":
        assert rows.count() == documents
    if name in ORACLES:
        assert differences(rows, connect(SF), ORACLES[name]) == []


def test_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and "pipeline" in entry.queries()
