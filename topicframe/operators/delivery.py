"""Acknowledgement, backlog, redelivery, duplicates and dispatch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.keys import key_bucket
from ..workspace import hold
from .lookup import left_lookup

MESSAGE = ["topic", "part", "off"]
LOG = ["topic", "part"]


def acknowledges_singly(subscription_type: str) -> bool:
    """Shared subscriptions may not acknowledge cumulatively."""
    return subscription_type.lower() in {t.lower() for t in C.SHARED_TYPES}


def cumulative_acks(bundles: DataFrame) -> DataFrame:
    """Per consumer and log, the last offset of any bundle: it covers all before it."""
    return bundles.groupBy("consumer_id", *LOG).agg(F.max("last_off").alias("position"))


def merge_cursors(cursors: DataFrame, acks: DataFrame) -> DataFrame:
    """Cursors moved forward by acknowledgements; none ever moves back."""
    return (
        cursors.unionByName(acks).groupBy("consumer_id", *LOG).agg(F.max("position").alias("position"))
    )


def individual_acks(df: DataFrame, consumer_id: str) -> DataFrame:
    """One acknowledgement per message."""
    return df.select(F.lit(consumer_id).alias("consumer_id"), *MESSAGE)


def acknowledger(
    subscription_type: str, consumer_id: str
) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """How a subscription acknowledges, given the bundles it wrote and the messages they are from."""
    if subscription_type not in C.SUBSCRIPTION_TYPES:
        raise ValueError(f"unknown subscription type {subscription_type!r}; use one of {C.SUBSCRIPTION_TYPES}")
    if acknowledges_singly(subscription_type):
        return lambda bundles, messages: individual_acks(messages, consumer_id)
    return lambda bundles, messages: cumulative_acks(bundles)


def backlog(df: DataFrame, acks: DataFrame | None = None, cursors: DataFrame | None = None) -> DataFrame:
    """Messages still to be acknowledged: beyond the cursor, and not acknowledged singly."""
    left = df
    if cursors is not None:
        placed = left_lookup(left, cursors.select(*LOG, "position"), LOG)
        left = placed.where(F.col("off") > F.coalesce("position", F.lit(-1))).drop("position")
    if acks is not None:
        left = _without(left, acks)
    return left


def _without(df: DataFrame, acks: DataFrame) -> DataFrame:
    """Messages no acknowledgement names; repeated ones are merged before they are moved."""
    return df.join(acks.select(*MESSAGE).distinct(), MESSAGE, "left_anti")


def compact_acks(df: DataFrame, acks: DataFrame, consumer_id: str) -> tuple[DataFrame, DataFrame]:
    """A cursor below the oldest open message of each log, and the single acks above it."""
    open_from = backlog(df, acks).groupBy(*LOG).agg((F.min("off") - 1).alias("_open"))
    ends = df.groupBy(*LOG).agg(F.max("off").alias("_end"))
    cursors = ends.join(open_from, LOG, "left").select(
        F.lit(consumer_id).alias("consumer_id"), *LOG, F.coalesce("_open", "_end").alias("position")
    )
    cursors = hold(cursors, "cursors")
    gaps = left_lookup(acks, cursors.select(*LOG, "position"), LOG).where("off > position").drop("position")
    return cursors, gaps


def check_ack_timeout(seconds: float) -> None:
    if seconds < C.MINIMUM_ACK_TIMEOUT_SECONDS:
        raise ValueError(f"the acknowledgement timeout must be at least {C.MINIMUM_ACK_TIMEOUT_SECONDS} seconds")


def due_for_redelivery(
    delivered: DataFrame,
    acks: DataFrame,
    now: Column,
    timeout_seconds: float = C.DEFAULT_ACK_TIMEOUT_SECONDS,
) -> DataFrame:
    """Messages delivered (``delivered_at``) at least the timeout ago and not acknowledged."""
    check_ack_timeout(timeout_seconds)
    waited = F.unix_micros(now) - F.unix_micros("delivered_at")
    overdue = delivered.where(waited >= int(timeout_seconds * 1_000_000))
    return _without(overdue, acks)


def dedupe(df: DataFrame) -> DataFrame:
    """One row per message, however often it was delivered."""
    return df.dropDuplicates(MESSAGE)


def dispatch(df: DataFrame, consumers: int, subscription_type: str) -> DataFrame:
    """Add ``consumer``, the number of the consumer that gets the message.

    Exclusive and Failover have one active consumer, Shared spreads by offset, Key_Shared
    sends equal keys to one consumer and spreads messages without a key.
    """
    spread = F.pmod(F.col("off"), F.lit(consumers))
    if subscription_type in (C.EXCLUSIVE, C.FAILOVER):
        chosen = F.lit(0)
    elif subscription_type == C.SHARED:
        chosen = spread
    elif subscription_type == C.KEY_SHARED:
        chosen = F.coalesce(key_bucket(F.col("key"), consumers), spread)
    else:
        raise ValueError(f"unknown subscription type {subscription_type!r}; use one of {C.SUBSCRIPTION_TYPES}")
    return df.withColumn("consumer", chosen.cast("bigint"))
