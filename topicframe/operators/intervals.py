"""Acknowledgements as intervals of offsets.

A row a message would keep for good what a subscription has acknowledged singly. Here a row is
(consumer_id, topic, part, first_off, last_off): every message of the log from the first to the last
offset is acknowledged. Two intervals without an open message between them are one, so a ledger has at
most one row more than a log has gaps, however many messages it covers and however sparse offsets are.

Nothing is expanded into single offsets or fixed bins. Whether a message is covered follows from the
furthest end of the intervals that begin at or before it, a running maximum; which intervals are one
follows from the open messages before each, a running count. Both run over spans of a log
(``operators.ordering``), so no task holds a log.

An interval whose first offset is above its last, or with a null in it, covers nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import hold
from .delivery import LOG
from .ordering import DEFAULT_SPAN, running_max, running_total

INTERVAL = ["consumer_id", *LOG, "first_off", "last_off"]


def of_acks(acks: DataFrame) -> DataFrame:
    """Single acknowledgements as intervals of one offset."""
    return acks.select("consumer_id", *LOG, F.col("off").alias("first_off"), F.col("off").alias("last_off"))


def _whole(intervals: DataFrame) -> DataFrame:
    """Intervals that cover something, each once; of those that begin alike the longest."""
    kept = intervals.where("topic is not null and part is not null and first_off <= last_off")
    return kept.groupBy("consumer_id", *LOG, "first_off").agg(F.max("last_off").alias("last_off"))


def uncovered(df: DataFrame, intervals: DataFrame, span: int = DEFAULT_SPAN) -> DataFrame:
    """The messages that no interval covers; ``intervals`` are those of one consumer."""
    starts = _whole(intervals).select(*LOG, F.col("first_off").alias("off"), F.col("last_off").alias("_last"))
    # at one offset an interval counts before the message
    marked = starts.withColumn("_message", F.lit(0)).unionByName(df.withColumn("_message", F.lit(1)), allowMissingColumns=True)
    placed = running_max(marked, LOG, "off", F.col("_last"), "_reached", ties=["_message"], span=span)
    open_ = (F.col("_message") == 1) & (F.col("_reached").isNull() | (F.col("_reached") < F.col("off")))
    return placed.where(open_).select(df.columns)


def merge(df: DataFrame, intervals: DataFrame, span: int = DEFAULT_SPAN) -> DataFrame:
    """The fewest intervals that cover the same messages of the log ``df``, of one consumer.

    New acknowledgements are merged by giving them, ``of_acks``, together with the old intervals.
    """
    whole = hold(_whole(intervals), "intervals")
    still_open = hold(uncovered(df.select(*LOG, "off"), whole, span), "open-messages")
    begun = whole.select("consumer_id", *LOG, F.col("first_off").alias("off"), "last_off")
    both = begun.unionByName(still_open, allowMissingColumns=True)
    # an open message is in no interval, so the two never share an offset that matters
    is_open = F.when(F.col("last_off").isNull(), 1).otherwise(0)
    counted = running_total(both, LOG, "off", is_open, "_gaps", ties=["last_off"], span=span).where("last_off is not null")
    return counted.groupBy("consumer_id", *LOG, "_gaps").agg(F.min("off").alias("first_off"), F.max("last_off").alias("last_off")).select(*INTERVAL)
