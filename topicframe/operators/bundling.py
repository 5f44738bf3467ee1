"""Grouping consecutive messages of a receive batch into bundles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as C
from ..functions import attributes as A
from ..functions import payload as P

# every ordered window below is keyed by a receive batch, whose size is limited
BATCH = ("topic", "part", "batch_no")


def by_topic(df: DataFrame, within: Sequence[str]) -> DataFrame:
    """Position of each message among those of its topic inside a batch that mixes topics."""
    window = Window.partitionBy(*reversed(within), "topic").orderBy("off")
    return df.withColumn("topic_pos", F.row_number().over(window).cast("bigint"))


def run_key(spec: str | None, scope: str = "mapped", records: bool = False) -> Column:
    """What two neighbours must share to stay in one bundle.

    ``mapped``: mapped attributes, and for records topic and schema. ``all``: every attribute,
    hence also the message id, so that messages with ids are never bundled together.
    """
    if scope == "mapped":
        values = [v.alias(f"v{i}") for i, v in enumerate(A.mapped_values(spec).values())]
        shared = [F.col("topic"), A.schema_text().alias("schema")] if records else [F.lit(0).alias("_")]
        return F.struct(*shared, *values)
    if scope == "all":
        return F.struct(A.entries(A.automatic(spec, records)).alias("entries"))
    raise ValueError(f"unknown scope {scope!r}; use mapped or all")


def runs(df: DataFrame, key: Column, within: Sequence[str] = BATCH, order: str = "off") -> DataFrame:
    """Add ``run``, counting from 1 wherever ``key`` differs from the previous message's.

    Equal keys that are not neighbours are different runs. ``seq`` numbers the messages of
    the batch.
    """
    # sorting compares the batch number before the topic's name
    window = Window.partitionBy(*reversed(within)).orderBy(order)
    return (
        df.withColumn("_key", key)
        .withColumn("seq", F.row_number().over(window).cast("bigint"))
        .withColumn("_begins", (~F.lag("_key").over(window).eqNullSafe(F.col("_key"))).cast("bigint"))
        .withColumn("run", F.sum("_begins").over(window.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("_key", "_begins")
    )


def counts() -> Column:
    """Messages of a group that have a payload."""
    return F.count(F.when(P.is_filled(), 1))


def concat(
    df: DataFrame,
    demarcator: str = C.DEFAULT_DEMARCATOR,
    within: Sequence[str] = BATCH,
    drop_empty: bool = True,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per run with its joined ``content`` and ``message_count``.

    A demarcator goes before every message that follows a non-empty one, so empty messages
    ahead of the first payload leave no trace and later ones leave a bare demarcator. The
    ones ahead are counted in the same aggregation and cut off the front.
    """
    mark = P.byte_length(demarcator)
    grouped = (
        df.withColumn("_data", F.coalesce("data", F.lit("").cast("binary")))
        .groupBy("run", *reversed(within))
        .agg(
            P.joined("_data", demarcator, "seq").alias("_joined"),
            (F.min(F.when(P.is_filled(), F.col("seq"))) - F.min("seq")).alias("_ahead"),
            counts().alias("message_count"),
            F.min("off").alias("first_off"),
            F.max("off").alias("last_off"),
            *extra,
        )
        .withColumn(
            "content",
            F.when(
                F.col("message_count") > 0,
                F.substring("_joined", (F.col("_ahead") * mark + 1).cast("int"), F.octet_length("_joined")),
            ).otherwise(F.lit("").cast("binary")),
        )
        .drop("_joined", "_ahead")
    )
    return grouped.where("message_count > 0") if drop_empty else grouped


def failures(
    df: DataFrame,
    demarcator: str = C.DEFAULT_DEMARCATOR,
    within: Sequence[str] = (*BATCH, "run"),
    order: str = "off",
) -> DataFrame:
    """One bundle per run of the messages flagged ``failed``, whole and joined in order."""
    return (
        df.where("failed")
        .groupBy(*reversed(within))
        .agg(
            P.joined("data", demarcator, order).alias("content"),
            F.count("*").alias("failed_count"),
            F.min("off").alias("first_off"),
            F.max("off").alias("last_off"),
        )
        .withColumn("relationship", F.lit(C.PARSE_FAILURE))
    )
