"""Cutting a subscription into receive batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as C
from .ordering import DEFAULT_SPAN, ordinal

LOG = ("topic", "part")
SEGMENT = 65536
SEGMENT_BATCH = (*LOG, "segment_no", "batch_no")


def assign_receive_batches(
    df: DataFrame,
    max_messages: int = C.DEFAULT_RECEIVE_BATCH,
    by: Sequence[str] = LOG,
    order: str = "off",
    ties: Sequence[str] = (),
    span: int = DEFAULT_SPAN,
    segment: int | None = None,
) -> DataFrame:
    """Add ``batch_no``: each batch holds up to ``max_messages`` consecutive messages of ``by``.

    With ``segment`` a batch also ends where the log enters its next segment of that many
    offsets, as a poll does that finds nothing more waiting. ``segment_no`` is added, and all
    later work on batches stays in the partitions this one shuffle makes, provided it groups
    by ``segment_no`` as well. Without it every batch but a log's last is full; that takes a
    counting pass first, and grouping by batch shuffles again.
    """
    if max_messages < 1:
        raise ValueError("max_messages must be positive")
    if segment is None:
        numbered = ordinal(df, by, order, "_ordinal", ties, span)
        return numbered.withColumn("batch_no", F.expr(f"_ordinal div {max_messages}")).drop("_ordinal")

    per_segment = -(-segment // max_messages)
    in_segment = Window.partitionBy(*by, "_segment").orderBy(order, *ties)
    return (
        df.withColumn("_segment", F.expr(f"`{order}` div {segment}"))
        .withColumn("_rank", F.row_number().over(in_segment) - 1)
        .withColumn("batch_no", F.expr(f"_segment * {per_segment} + _rank div {max_messages}"))
        .drop("_rank")
        .withColumnRenamed("_segment", "segment_no")
    )
