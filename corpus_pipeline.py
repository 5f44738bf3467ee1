"""A corpus pipeline from operators of topicframe.llm.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is
written as Parquet and read back as the next one's docs. All but the last return the columns of
docs, whatever they are beside doc_id and text.

Rows without doc_id pass the near-duplicate stage unlinked and the others like any row; an empty
table stays empty through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicframe.llm import attention_mil, best_fit, super_kmers, wide_simhash, winnowing
from topicframe.workspace import fresh_path, hold

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_docs(rows: DataFrame, docs: DataFrame, **new) -> DataFrame:
    """The columns of docs, in their order, from an operator's doc_id, text and others."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text") if "text" in rows.columns else None, **new}
    return rows.select(*((own[c] if c in own else F.col("others").getField(c)).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = attention_mil.train(docs, _table(spark, sf_dir, "labels"))
    return _as_docs(attention_mil.scored(docs, model).where("predicted = 1"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of each group of near duplicates stays; of rows equal in id and text, one."""
    grouped = wide_simhash.near_duplicates(docs)
    stay = hold(grouped.where("doc_id = component_id").select("doc_id").distinct(), "representatives")
    # the ids that stay grow with the documents, so they are never sent to every task
    kept = docs.where("doc_id is not null").join(stay.hint("merge"), "doc_id", "left_semi")
    # few if any, so texts are compared only there; rows that share an id alone are all kept
    repeated = hold(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    once = kept.join(repeated, "doc_id", "left_anti")
    several = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.select(docs.columns).unionByName(several.select(docs.columns)).unionByName(docs.where("doc_id is null"))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that also start in a document with a smaller id are cut out; n_chars follows."""
    removed = super_kmers.remove_repeats(docs, verbatim=True)
    text = F.col("kept_text")
    new = {"text": text, "n_chars": F.length(text).cast("bigint")} if "n_chars" in docs.columns else {"text": text}
    return _as_docs(removed, docs, **new)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with a benchmark item go."""
    found = winnowing.contaminated(docs, _table(spark, sf_dir, "benchmark"))
    return _as_docs(found.where("n_hit = 0"), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its bin."""
    return best_fit.packed(hold(best_fit.lengths(docs), "piece-lengths"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontaminated", decontaminated),
    ("packed", packed),
]

#: no stage but the fourth can be said in SQL; tests/llm holds the pipeline against a brute-force version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
