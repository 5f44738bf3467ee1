"""Exact length histogram: totals, quantiles and truncated totals for every context limit.

Documents are encoded once and collapse to (length, documents) on the map side; what is shuffled
is bounded by the number of distinct lengths a task has seen. Every answer for every limit follows
from suffix sums over the histogram: the documents longer than a limit, their tokens, and the
tokens that remain if each document is cut at the limit. The suffix sums run in two levels
(buckets of lengths, then inside a bucket), so no task holds the whole histogram.

Defined results: null and empty texts have length 0; an empty table gives an empty histogram and
no quantile; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .encoder import default_vocabulary, encoder

#: lengths that share a bucket of the two-level sums
BUCKET = 64
#: what the query answers for beside the lengths that occur
CONTEXTS = (512, 1024, 2048, 4096, 8192, 16384, 32768, 131072)
SHARES = (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999, 1.0)


def _counted(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        for batch in batches:
            counts = [c for c, _ in known.counts_and_ids(batch.column(0), want_ids=False)]
            if counts:
                length, docs = np.unique(np.concatenate(counts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(length.astype(np.int64)), pa.array(docs.astype(np.int64))], names=["length", "n_docs"])

    return run


def histogram(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(length, n_docs): how many texts have that many tokens."""
    text = docs.select(F.col("text").cast("string").alias("text"))
    counted = text.mapInArrow(_counted(vocabulary or default_vocabulary()), "length bigint, n_docs bigint")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def limits(histogram: DataFrame, contexts: Sequence[int] = (), shares: Sequence[float] = ()) -> DataFrame:
    """One row a length L that occurs, and one for each of contexts, whether it occurs or not.

    docs_from, tokens_from: documents of at least L tokens and their tokens; docs_to, tokens_to:
    those of at most L; truncated_tokens: what stays if every document is cut at L; quantile_of: the
    shares of all documents of which L is the quantile, the least length they do not exceed. The
    histogram is read twice; give it as a stored table, or texts are encoded twice.
    """
    if contexts:
        # lengths of no document: the sums over them answer for any limit
        asked = histogram.sparkSession.createDataFrame([(int(c), 0) for c in contexts], "length bigint, n_docs bigint")
        histogram = histogram.unionByName(asked).groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
    bucket = F.floor(F.col("length") / BUCKET)
    lengths = histogram.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), bucket.alias("bucket"))
    sums = lengths.groupBy("bucket").agg(F.sum("n_docs").alias("b_docs"), F.sum("n_tokens").alias("b_tokens"))
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = sums.select(
        "bucket",
        *(F.coalesce(F.sum(f"b_{x}").over(after), F.lit(0)).alias(f"later_{x}") for x in ("docs", "tokens")),
        *(F.sum(f"b_{x}").over(total).alias(f"all_{x}") for x in ("docs", "tokens")),
    )
    down = Window.partitionBy("bucket").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    suffix = lengths.join(edges, "bucket").select(
        "length",
        "n_docs",
        "n_tokens",
        "all_docs",
        "all_tokens",
        *((F.col(f"later_{x}") + F.sum(f"n_{x}").over(down)).alias(f"{x}_from") for x in ("docs", "tokens")),
    )
    return suffix.select(
        "length",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("all_docs") - F.col("docs_from") + F.col("n_docs")).alias("docs_to"),
        (F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens")).alias("tokens_to"),
        (F.col("all_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_tokens"),
        F.filter(F.array(*(F.lit(float(s)) for s in shares)).cast("array<double>"), lambda s: _is_quantile(s)).alias("quantile_of"),
    )


def _is_quantile(share: Column) -> Column:
    reached = F.col("all_docs") - F.col("docs_from") + F.col("n_docs")
    needed = F.greatest(F.ceil(share * F.col("all_docs")), F.lit(1))
    return (reached >= needed) & (reached - F.col("n_docs") < needed)


def truncated_totals(limit_rows: DataFrame, contexts: Sequence[int]) -> DataFrame:
    """(context, kept_tokens) for limits that need not occur as lengths.

    For a limit between two lengths the longer documents are cut at the limit itself: the tokens
    of those at most as long, and the limit for each of the rest.
    """
    asked = F.explode(F.array(*(F.lit(int(c)).cast("bigint") for c in contexts))).alias("context")
    rows = limit_rows.select("length", "n_docs", asked)
    kept = F.least("length", "context") * F.col("n_docs")
    return rows.groupBy("context").agg(F.sum(kept).alias("kept_tokens"))


def quantiles(limit_rows: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the least length that at least that share of the documents do not exceed."""
    asked = F.explode(F.array(*(F.lit(float(s)) for s in shares))).alias("share")
    whole = F.col("docs_to") + F.col("docs_from") - F.col("n_docs")
    rows = limit_rows.select("length", "docs_to", whole.alias("n"), asked)
    return rows.where(F.col("docs_to") >= F.ceil(F.col("share") * F.col("n"))).groupBy("share").agg(F.min("length").alias("length"))
