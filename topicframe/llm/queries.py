"""One query an operator, over its whole tables with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import hold
from . import attention_mil, best_fit, bond_scan, byte_shards, divergence_rules, merkle_climb, noisy_channel, run_length_index, simhash_bk, super_kmers, token_lengths, token_orc, winnowing
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_winnowing(spark, sf_dir):
    found = winnowing.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op2_run_length_bwt(spark, sf_dir):
    removed = run_length_index.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_attention_mil(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = attention_mil.train(docs, table(spark, sf_dir, "labels"))
    return attention_mil.scored(docs, model).select("doc_id", "held_out", "score", "predicted")


@query
def op4_simhash_bk(spark, sf_dir):
    return simhash_bk.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_noisy_channel(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = noisy_channel.train(docs, table(spark, sf_dir, "labels"))
    return noisy_channel.scored(docs, model).select("doc_id", "held_out", "score", "predicted")


@query
def op6_super_kmers(spark, sf_dir):
    removed = super_kmers.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op7_length_histogram(spark, sf_dir):
    lengths = hold(token_lengths.histogram(table(spark, sf_dir, "documents")), "token-lengths")
    return token_lengths.limits(lengths, token_lengths.CONTEXTS, token_lengths.SHARES)


@query
def op8_divergence_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = divergence_rules.judged(docs)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_best_fit(spark, sf_dir):
    pieces = hold(best_fit.lengths(table(spark, sf_dir, "documents")), "piece-lengths")
    return best_fit.packed(pieces)


@query
def op10_token_orc(spark, sf_dir):
    return token_orc.written_digests(table(spark, sf_dir, "documents"))


@query
def op11_bond_scan(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = bond_scan.whole_vectors(table(spark, sf_dir, "embeddings"), scale=256, label=moved)
    return bond_scan.mine(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op12_byte_shards(spark, sf_dir):
    placed = byte_shards.assigned(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit(byte_shards.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op13_merkle_climb(spark, sf_dir):
    proven = merkle_climb.proofs(table(spark, sf_dir, "documents"))
    return proven.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")
