"""Contents that are files of any size, read as numbered tokens.

Spark cuts a file into byte ranges at the demarcator: a token belongs to the range it begins in and is
read to its end, so tokens that cross a range are whole and none is read twice. What a range yields is
stored once, with the file, the range's first byte and a running number; a token's position in its file
is that number, less the range's first, plus the counts of the ranges before. Nothing needs a file, or
all ranges of one, in one task, and a stored token keeps its place whatever is lost later.

A UTF-8 byte order mark at the beginning of a file is no part of its content. A single token must fit
a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lookup import left_lookup
from ..workspace import hold


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, size) of all files below root, and the columns that its folders name; no content is read."""
    found = spark.read.format("binaryFile").load(root)
    folders = [c for c in found.columns if c not in ("path", "modificationTime", "length", "content")]
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("size"), *folders)


def tokens(spark: SparkSession, root: str, demarcator: str, kept: Column | None = None) -> DataFrame:
    """(path, pos, data): the tokens of all files below root, as ``functions.payload.tokens`` cuts one content.

    An empty file has none, and there is none behind a last demarcator. With ``kept``, a condition on
    ``data``, only such tokens are taken and counted.
    """
    if not demarcator:
        raise ValueError("a file is cut at a demarcator, which must not be empty")
    read = spark.read.option("lineSep", demarcator).text(root)
    rows = read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("data"))
    if kept is not None:
        rows = rows.where(kept)
    # rows of a range follow one another in one task, so their ids count up without gaps
    stored = hold(rows.withColumn("number", F.monotonically_increasing_id()), "file-tokens")
    ranges = stored.groupBy("path", "block").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    shifts = hold(ranges.select("path", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")), "file-ranges")
    placed = left_lookup(stored, shifts, ["path", "block"], spread="number")
    return placed.select("path", (F.col("number") + F.col("shift")).alias("pos"), "data")
