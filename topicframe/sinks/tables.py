"""Writing messages and failures as partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schema import MESSAGE_SCHEMA, conform

# wire compression settings and the Parquet codecs that stand for them
COMPRESSION = {"NONE": "none", "LZ4": "lz4", "ZLIB": "gzip"}


def write_messages(
    df: DataFrame,
    path: str,
    compression: str = "NONE",
    mode: str = "append",
    rebalance: bool = True,
) -> None:
    """Append messages to a topic table.

    Rebalancing groups rows by log so that each task opens few files, and lets adaptive
    execution cut a log that holds much of the data into several tasks.
    """
    rows = conform(df, MESSAGE_SCHEMA)
    if rebalance:
        rows = rows.hint("rebalance", "topic", "part")
    codec = COMPRESSION[compression.upper()]
    rows.write.mode(mode).option("compression", codec).partitionBy("topic", "part").parquet(path)


def dead_letter(df: DataFrame, path: str, mode: str = "append") -> None:
    """Keep failed messages or bundles for replay, by route; the topic stays as it is, blank or not."""
    df.hint("rebalance", "relationship", "topic").write.mode(mode).partitionBy("relationship").parquet(path)
