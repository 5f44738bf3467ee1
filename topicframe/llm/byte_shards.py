"""Contiguous shards of nearly equal size, by global prefix sums of bytes.

Documents are put in order of doc_id in ranges, each range gives its total, and what stands before a
document is the totals of earlier ranges plus a running sum inside its own. With B bytes in all and
n shards, the cuts are at B/n, 2B/n and so on; a document belongs to the shard its middle byte
falls into, so no cut is further off than half a document. Only ids, sizes and checksums move, never
text, and no shard or source is ever one group, so copies and hot sources do not matter. DataFrame
functions only.

Defined results: a null text has no bytes and the checksum of none, 0; documents without doc_id come
first; rows with equal doc_id are ordered by checksum, hash and size, and each is placed for itself; a
document larger than a shard's share can leave shards beside it empty; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import hold
from .numbering import before_ranges, laid_out
from .sizes import parts

#: bytes that a document takes beside its text
OVERHEAD = 16
LAW = "bytes"
#: bytes of stored input whose rows make one range
RANGE_BYTES = 16 << 20


def assigned(docs: DataFrame, shards: int, overhead: int = OVERHEAD, ranges: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): slot counts from 0 inside a shard, in order of doc_id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("tie"),
    )
    # stored first: ranges are found by a sample, which would read the texts twice
    narrow = hold(narrow, "shard-sizes")
    laid = laid_out(narrow, ["doc_id", "text_crc32", "tie", "size"], ranges or parts(docs, RANGE_BYTES), "shard-order")
    inside = Window.partitionBy("range_no").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    started = laid.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    started = started.join(before_ranges(laid, bytes="size", rows="1"), "range_no")
    # twice the middle byte, over twice the total; decimals, since the product outgrows a long
    middle = "cast(2 * (before_bytes + start) + size as decimal(38, 0))"
    placed = started.select(
        "doc_id",
        "size",
        "text_crc32",
        F.expr(f"cast(least({shards} - 1, {middle} * {shards} div (2 * all_bytes)) as int)").alias("shard"),
        (F.col("before_rows") + F.col("place")).alias("row_no"),
    )
    # at most one row a shard
    first = placed.groupBy("shard").agg(F.min("row_no").alias("first_row"))
    slotted = placed.join(F.broadcast(first), "shard")
    return slotted.select("doc_id", "size", "text_crc32", "shard", (F.col("row_no") - F.col("first_row")).alias("slot"))
