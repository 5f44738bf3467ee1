"""Subscribing to topics kept as a table partitioned by ``topic`` and ``part``."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import left_lookup
from ..schema import MESSAGE_SCHEMA

LOG = ["topic", "part"]


def topic_names(topics: str) -> list[str]:
    """The names in a list separated by commas or blanks."""
    return [name for name in re.split(r"[,\s]+", topics) if name]


def subscribed(topics: str | None = None, pattern: str | None = None) -> Column:
    """Predicate on ``topic``; both forms prune table partitions."""
    if (topics is None) == (pattern is None):
        raise ValueError("give either a topic list or a topic pattern")
    if topics is not None:
        return F.col("topic").isin(topic_names(topics))
    return F.col("topic").rlike(f"^(?:{pattern})$")


def read_topics(
    spark: SparkSession, path: str, topics: str | None = None, pattern: str | None = None
) -> DataFrame:
    """The messages of the subscribed topics.

    Folders above ``topic``, as streamed publishers write per poll, are no part of a message.
    """
    found = spark.read.schema(MESSAGE_SCHEMA).parquet(path).where(subscribed(topics, pattern))
    return found.select(*MESSAGE_SCHEMA.names)


def consumer_identity(
    subscription: str,
    topics: str | None = None,
    pattern: str | None = None,
    consumer_name: str | None = None,
) -> str:
    """The name a durable position is kept under."""
    parts = [topics if topics is not None else pattern or "", subscription]
    if consumer_name:
        parts.append(consumer_name)
    return "-".join(parts)


def snapshot(df: DataFrame) -> DataFrame:
    """The end of each log now; kept from a subscription's first run for ``latest``."""
    return df.groupBy(*LOG).agg(F.max("off").alias("position"))


def snapshot_once(df: DataFrame, path: str) -> DataFrame:
    """The snapshot kept under ``path``, taken from ``df`` if there is none yet."""
    spark = df.sparkSession
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        # also replaces what a run that died while writing may have left
        snapshot(df).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def after(df: DataFrame, cursors: DataFrame) -> DataFrame:
    """Messages beyond each log's cursor; a log without one is read from its beginning.

    ``cursors`` is a small stored table; hold a derived one first.
    """
    placed = left_lookup(df, cursors.select(*LOG, "position"), LOG)
    return placed.where(F.col("off") > F.coalesce("position", F.lit(-1))).drop("position")


def start_position(df: DataFrame, at_subscribe: DataFrame | None, start: str = "latest") -> DataFrame:
    """Where a new subscription begins: at the first message, or behind the snapshot's ends."""
    if start == "earliest":
        return df
    if start != "latest":
        raise ValueError(f"unknown start {start!r}; use earliest or latest")
    if at_subscribe is None:
        raise ValueError("latest needs the snapshot taken when the subscription was made")
    return after(df, at_subscribe)


def resume(df: DataFrame, cursors: DataFrame, consumer_id: str) -> DataFrame:
    """Continue behind what this consumer has acknowledged."""
    return after(df, cursors.where(F.col("consumer_id") == consumer_id))
