"""Token ids in ORC: integer run-length encoding, row indexes and Bloom filters on document ids.

Documents are dealt out by ranges of doc_id before they are encoded, so files follow one another
in ascending order and a file is written in order by one task. Each row keeps the number of its
range and where it starts inside it, whatever files a writer cuts a range into; the place in the whole
stream is that plus the totals of the ranges before, which come from the narrow columns alone. Readers take stripes in parallel, and a filter on doc_id skips
files, stripes and row groups by their indexes and Bloom filters.

Defined results: a null or empty text is the end id alone; rows with equal doc_id are all written,
in the order of their texts' hashes; a null doc_id sorts first; an empty table writes no rows;
columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import fresh_path
from .encoder import default_vocabulary, encoder
from .numbering import before_ranges
from .sizes import parts

FILE_SCHEMA = "doc_id bigint, range_no int, at bigint, n_tokens bigint, ids array<int>"
END_ID = 0
#: rows between two entries of a row index
INDEX_STRIDE = 1000
#: bytes of a stripe before compression; a writer holds one in memory
STRIPE_BYTES = 16 << 20
#: bytes of stored input for one range
RANGE_BYTES = 64 << 20


def _encode(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at = encoder(vocabulary), 0
        for batch in batches:
            doc_ids, lo = batch.column(0), 0
            for counts, ids in known.counts_and_ids(batch.column(1)):
                ends = np.cumsum(counts + 1)
                flat = np.full(int(ends[-1]), end_id, np.int32)
                body = np.ones(len(flat), bool)
                body[ends - 1] = False
                flat[body] = ids
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                starts = at + ends - counts - 1
                at += int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids[lo : lo + len(counts)], batch.column(2)[lo : lo + len(counts)], pa.array(starts), pa.array(counts + 1), lists],
                    names=["doc_id", "range_no", "at", "n_tokens", "ids"],
                )
                lo += len(counts)

    return run


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Write the token ids of (doc_id, text) below path."""
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.xxhash64("text").alias("tie")
    dealt = (
        kept.withColumn("tie", tie)
        .repartitionByRange(parts(kept, RANGE_BYTES), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text", F.spark_partition_id().alias("range_no"))
    )
    (
        dealt.mapInArrow(_encode(vocabulary or default_vocabulary(), end_id), FILE_SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", str(INDEX_STRIDE))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, range_no, at, n_tokens, ids): filters on doc_id reach the files' indexes."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        flat, off = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("range_no"), batch.column("at"), pa.array(np.diff(off).astype(np.int64)), pa.array(sums, pa.int64())],
            names=["doc_id", "range_no", "at", "n_tokens", "ids_crc32"],
        )


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files."""
    stored = read(spark, path)
    rows = stored.mapInArrow(_checked, "doc_id bigint, range_no int, at bigint, n_tokens bigint, ids_crc32 bigint")
    placed = rows.join(before_ranges(stored, tokens="n_tokens"), "range_no")
    return placed.select("doc_id", (F.col("before_tokens") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def written_digests(docs: DataFrame) -> DataFrame:
    path = fresh_path(docs.sparkSession, "token-orc")
    write(docs, path)
    return digests(docs.sparkSession, path)
