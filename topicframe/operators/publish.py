"""Turning bundles into keyed, routed messages.

A bundle is a row with ``bundle_id``, ``attributes`` and ``content``. Everything that depends
on one bundle alone (its topic, key, tokens, records, failure) is computed inside its row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import constants as C
from ..functions import codecs
from ..functions import keys as K
from ..functions import payload as P
from ..functions.mapping import map_of, mapped_columns
from ..functions.templates import is_blank, render
from .lookup import left_lookup
from .ordering import DEFAULT_SPAN, running_total
from .records import Format


def with_topic(df: DataFrame, template: str) -> DataFrame:
    """Add the target ``topic``, rendered from each bundle's attributes."""
    return df.withColumn("topic", render(template))


def with_key(df: DataFrame, template: str | None = None) -> DataFrame:
    """Add the message ``key``: the rendered template, else the key attribute, else null."""
    fallback = F.col("attributes").getItem(C.KEY_ATTRIBUTE)
    if template is None:
        return df.withColumn("key", fallback)
    key = render(template)
    return df.withColumn("key", F.coalesce(F.when(~is_blank(key), key), fallback))


def with_properties(df: DataFrame, spec: str | None) -> DataFrame:
    """Add the message ``properties`` a mapping spec picks from the bundle's attributes."""
    return df.withColumn("properties", map_of(mapped_columns(spec, lambda name: F.col("attributes").getItem(name))))


def with_key_field(df: DataFrame, field: str | None, fmt: Format = "json") -> DataFrame:
    """Add ``key`` from a top-level column holding a record field; no field, no key."""
    if field is None:
        return df.withColumn("key", F.lit(None).cast("string"))
    return df.withColumn("key", K.key_text(F.col(field), df.schema[field].dataType, fmt))


def to_messages(df: DataFrame) -> DataFrame:
    """One message per bundle, holding its whole content."""
    return df.withColumn("pos", F.lit(0)).withColumnRenamed("content", "data")


def split(df: DataFrame, demarcator: str | None) -> DataFrame:
    """One message per token of the content, numbered by ``pos``; all else is repeated.

    The demarcator may itself hold ``${name}`` references to the bundle's attributes.
    """
    if not demarcator:
        return to_messages(df)
    mark = render(demarcator) if "${" in demarcator else demarcator
    rest = [c for c in df.columns if c != "content"]
    return df.select(*rest, F.posexplode(P.tokens(F.col("content"), mark)).alias("pos", "data"))


def records_to_messages(df: DataFrame, record: Column, fmt: Format) -> DataFrame:
    """Add ``data``: one record written alone, as the payload of one message."""
    return df.withColumn("data", codecs.serialize(record, fmt).cast("binary"))


def record_messages(
    schema: T.StructType | str, writer: Format, key_field: str | None, options: dict[str, str] | None = None
) -> Column:
    """``records`` as an array of message key and payload, in their order."""
    fields = {f.name: f.dataType for f in codecs.as_struct(schema).fields}

    def message(record: Column) -> Column:
        key = F.lit(None).cast("string")
        if key_field in fields:
            key_writer = writer if callable(writer) or writer in ("json", "csv") else "json"
            key = K.key_text(record.getField(key_field), fields[key_field], key_writer)
        data = codecs.serialize(codecs.without_corrupt(record), writer, options).cast("binary")
        return F.struct(key.alias("key"), data.alias("data"))

    return F.transform("records", message)


def route(df: DataFrame, partial: str = "none") -> DataFrame:
    """Add ``relationship``; a failed bundle is kept whole and, by default, sends nothing.

    A bundle fails on a blank topic, missing content, or a malformed record where it has
    ``records``. With ``partial="prefix"`` the records before a malformed one are still sent.
    Where there are records, the ones to send replace them.
    """
    if partial not in ("none", "prefix"):
        raise ValueError(f"unknown partial mode {partial!r}; use none or prefix")
    unusable = is_blank(F.col("topic")) | F.col("content").isNull()
    if "records" not in df.columns:
        return df.withColumn("relationship", F.when(unusable, C.FAILURE).otherwise(C.SUCCESS))
    routed = df.withColumn("_bad", codecs.first_bad(F.col("records"))).withColumn(
        "relationship", F.when(unusable | (F.col("_bad") > 0), C.FAILURE).otherwise(C.SUCCESS)
    )
    nothing = F.slice("records", F.lit(1), F.lit(0))
    if partial == "prefix":
        sent = F.when(unusable, nothing).otherwise(codecs.good_prefix(F.col("records"), F.col("_bad")))
    else:
        sent = F.when(F.col("relationship") == C.FAILURE, nothing).otherwise(F.col("records"))
    return routed.withColumn("records", sent).drop("_bad")


def route_partitions(
    df: DataFrame,
    partitions: int,
    mode: str = "RoundRobinPartition",
    sequence: str = "off",
    partition: Column | int = 0,
) -> DataFrame:
    """Add ``part``. Round robin follows ``sequence``, single and custom take ``partition``.

    Except in custom mode, a message with a key goes to the partition of its key.
    """
    if mode == "CustomPartition":
        chosen = partition if isinstance(partition, Column) else F.lit(partition)
        return df.withColumn("part", chosen.cast("int"))
    if mode == "RoundRobinPartition":
        unkeyed = F.pmod(F.col(sequence), F.lit(partitions))
    elif mode == "SinglePartition":
        unkeyed = F.lit(partition)
    else:
        raise ValueError(f"unknown routing mode {mode!r}")
    return df.withColumn("part", F.coalesce(K.key_bucket(F.col("key"), partitions), unkeyed).cast("int"))


def assign_offsets(
    bundles: DataFrame,
    sent: Column,
    order: str = "bundle_id",
    ends: DataFrame | None = None,
    span: int = DEFAULT_SPAN,
) -> DataFrame:
    """Add ``first_off``, where each bundle's messages begin in its topic.

    ``sent`` is the number of messages of a bundle, so only bundles are numbered, not the
    messages they are split into; a message's offset is ``first_off + pos``. A topic begins
    at its ``next_off`` in ``ends``, or at 0.
    """
    placed = running_total(bundles, ["topic"], order, sent, "first_off", span=span)
    if ends is None:
        return placed
    known = left_lookup(placed, ends.select("topic", "next_off"), ["topic"], spread=order)
    return known.withColumn("first_off", F.col("first_off") + F.coalesce("next_off", F.lit(0))).drop("next_off")


def assign_batches(
    df: DataFrame,
    max_messages: int = C.DEFAULT_PUBLISH_BATCH_MESSAGES,
    max_bytes: int = C.DEFAULT_PUBLISH_BATCH_BYTES,
    interval: timedelta = timedelta(milliseconds=C.DEFAULT_PUBLISH_BATCH_MILLISECONDS),
    within: Sequence[str] = ("topic", "part", "batch_no"),
    order: str = "off",
    sends_per_flush: int | None = C.DEFAULT_SENDS_PER_FLUSH,
    chunking: bool = False,
) -> DataFrame:
    """Add ``publish_batch``, counting from 1 inside ``within``.

    Messages are taken in order; one that would make its batch too many, too large or too
    old opens the next (so a message above the size limit has a batch to itself).
    A publisher waits for the sends of a bundle before it begins the next and flushes after
    every ``sends_per_flush``, so batches end there too; ``flush_no`` numbers those groups.
    That keeps a group to what a publisher itself holds between two flushes, so a group is
    gathered into one row, walked there over sizes and times, and laid out again. Where the
    input is already partitioned by ``within``, as receive batches are, nothing is moved.
    """
    if chunking:
        raise ValueError("batching and chunking exclude each other")
    keys = list(within)
    if sends_per_flush:
        window = Window.partitionBy(*reversed(keys)).orderBy(order)
        df = df.withColumn("_rank", F.row_number().over(window) - 1)
        df = df.withColumn("flush_no", F.expr(f"_rank div {sends_per_flush}")).drop("_rank")
        keys.append("flush_no")

    age_limit = int(interval / timedelta(microseconds=1))

    def advance(state: Column, message: Column) -> Column:
        opens = (
            (state["count"] == 0)
            | (state["count"] + 1 > max_messages)
            | (state["bytes"] + message["size"] > max_bytes)
            | (message["at"] - state["since"] >= age_limit)
        )

        def next_state(opening: Column) -> Column:
            return F.struct(
                F.when(opening, F.array_append(state["starts"], message["off"])).otherwise(state["starts"]),
                F.when(opening, F.lit(1).cast("bigint")).otherwise(state["count"] + 1),
                F.when(opening, message["size"]).otherwise(state["bytes"] + message["size"]),
                F.when(opening, message["at"]).otherwise(state["since"]),
            )

        return P.bind(opens, next_state)

    none = F.lit(0).cast("bigint")
    begin = F.struct(
        F.array().cast("array<bigint>").alias("starts"),
        none.alias("count"),
        none.alias("bytes"),
        none.alias("since"),
    )
    def step(row: Column) -> Column:
        size = F.coalesce(F.octet_length(row["data"]), F.lit(0)).cast("bigint")
        return F.named_struct(
            F.lit("off"),
            row[order].cast("bigint"),
            F.lit("size"),
            size,
            F.lit("at"),
            F.unix_micros(row["publish_time"]),
        )

    rest = [c for c in df.columns if c not in keys]
    gathered = df.groupBy(*reversed(keys)).agg(F.collect_list(F.struct(*rest)).alias("_rows"))
    steps = F.array_sort(F.transform("_rows", step))
    starts = F.aggregate(steps, begin, advance, lambda state: state["starts"])
    reached = F.size(F.filter("_starts", lambda start: start <= F.col(order)))
    # the walk gets a column of its own below the layout, so that it runs once per group
    return (
        gathered.withColumn("_starts", starts)
        .select(*keys, "_starts", F.inline("_rows"))
        .withColumn("publish_batch", reached.cast("bigint"))
        .drop("_starts")
    )
