"""Messages above the size limit: cutting, rejoining and giving up on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as C

ACK = "ack"
REDELIVER = "redeliver"
COMPLETE = "complete"
PENDING = "pending"
EXPIRED = "expired"


def split(
    df: DataFrame,
    max_bytes: int = C.DEFAULT_CHUNK_BYTES,
    chunk_set: Column | str = "message_id",
    batching: bool = False,
) -> DataFrame:
    """One row per chunk: ``chunk_set``, ``chunk_no`` from 0, ``chunk_count`` and its ``data``.

    A payload within the limit is a set of one. The pieces are cut before rows multiply, so
    no row carries more than its own chunk.
    """
    if batching:
        raise ValueError("batching and chunking exclude each other")
    identity = F.col(chunk_set) if isinstance(chunk_set, str) else chunk_set
    size = F.coalesce(F.octet_length("data"), F.lit(0))
    count = F.greatest(F.ceil(size / F.lit(max_bytes)), F.lit(1)).cast("bigint")
    pieces = F.transform(
        F.sequence(F.lit(0).cast("bigint"), count - 1),
        lambda i: F.substring("data", (i * max_bytes + 1).cast("int"), F.lit(max_bytes)),
    )
    rest = [c for c in df.columns if c not in ("data", "chunk_set")]
    return df.select(
        *rest,
        identity.alias("chunk_set"),
        count.alias("chunk_count"),
        F.posexplode(pieces).alias("chunk_no", "data"),
    )


def assemble(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Payloads whose chunks are all there, rejoined in order; a repeated chunk counts once.

    Repeats are dropped before rows are moved, so a message delivered over and over does not
    fill one task.
    ``carry`` names columns that are equal on all chunks of a message.
    """
    chunk = F.struct("chunk_no", F.col("data").cast("string").alias("text"))
    return (
        df.groupBy("chunk_set")
        .agg(
            F.collect_set(chunk).alias("_chunks"),
            F.max("chunk_count").alias("chunk_count"),
            *[F.first(c).alias(c) for c in carry],
        )
        .where(F.size("_chunks") == F.col("chunk_count"))
        .withColumn("data", joined(F.col("_chunks")))
        .drop("_chunks")
    )


def joined(chunks: Column) -> Column:
    """Chunk texts of a set put together in order.

    Casting between binary and string keeps the bytes as they are, whatever they encode.
    """
    return F.array_join(F.transform(F.array_sort(chunks), lambda c: c["text"]), "").cast("binary")


def sets(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """State of each chunk set: chunks received and expected, first and last arrival."""
    return df.groupBy(*by, "chunk_set").agg(
        F.size(F.collect_set("chunk_no")).cast("bigint").alias("received"),
        F.max("chunk_count").alias("chunk_count"),
        F.min("publish_time").alias("first_time"),
        F.max("publish_time").alias("last_time"),
    )


def expire(df: DataFrame, now: Column, after_seconds: int = C.DEFAULT_CHUNK_EXPIRY_SECONDS) -> DataFrame:
    """``sets`` with a ``status``: incomplete ones expire once nothing came for that long."""
    idle = F.unix_micros(now) - F.unix_micros("last_time")
    return sets(df).withColumn(
        "status",
        F.when(F.col("received") == F.col("chunk_count"), COMPLETE)
        .when(idle >= after_seconds * 1_000_000, EXPIRED)
        .otherwise(PENDING),
    )


def cap_pending(
    state: DataFrame,
    max_pending: int = C.DEFAULT_PENDING_CHUNKED,
    auto_ack: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Incomplete sets beyond the newest ``max_pending``, with the ``action`` they get.

    ``state`` comes from ``sets``. The newest are found by a top-n that keeps n rows per task
    before anything is moved; the rest is what they do not cover.
    """
    incomplete = state.where("received < chunk_count")
    newest = [F.col("last_time").desc(), F.col("chunk_set").desc()]
    if by:
        window = Window.partitionBy(*by).orderBy(*newest)
        kept = incomplete.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= max_pending)
        beyond = incomplete.join(kept.select(*by, "chunk_set"), [*by, "chunk_set"], "left_anti")
    else:
        # at most max_pending rows, so the broadcast is bounded by the setting itself
        kept = incomplete.orderBy(*newest).limit(max_pending).select("chunk_set")
        beyond = incomplete.join(F.broadcast(kept), "chunk_set", "left_anti")
    return beyond.withColumn("action", F.lit(ACK if auto_ack else REDELIVER))
