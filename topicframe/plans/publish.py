"""From bundles to messages and routed bundles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import payload as P
from ..functions.templates import render
from ..operators import audit, publish, records
from ..schema import MESSAGE_SCHEMA, conform
from ..workspace import hold


@dataclass(frozen=True)
class Target:
    """Settings shared by both publishers."""

    topic: str
    properties: str | None = None
    partitions: int = 1
    routing: str = "RoundRobinPartition"
    partition: Column | int = 0


@dataclass(frozen=True)
class Published:
    """What a publisher makes: messages for the topic tables, and each bundle with its route."""

    messages: DataFrame
    bundles: DataFrame


def publish_bytes(
    bundles: DataFrame,
    target: Target,
    key: str | None = None,
    demarcator: str | None = None,
    ends: DataFrame | None = None,
) -> Published:
    """The raw publisher: each token of a bundle's content is a message.

    Offsets of a topic go on from ``ends`` (topic, next_off), a small stored table.
    """
    addressed = publish.with_properties(
        publish.with_key(publish.with_topic(with_id(bundles), target.topic), key), target.properties
    )
    routed = publish.route(addressed)
    if demarcator:
        mark = render(demarcator) if "${" in demarcator else demarcator
        sent = P.token_count(F.col("content"), mark)
    else:
        sent = F.lit(1)
    sending = routed.where(F.col("relationship") == C.SUCCESS)
    # only narrow rows are put in order; the content joins them afterwards
    numbered = publish.assign_offsets(sending.select("bundle_id", "topic", sent.cast("bigint").alias("sent")), F.col("sent"), ends=ends)
    cut = publish.split(sending.join(numbered.select("bundle_id", "first_off"), "bundle_id"), demarcator)
    return Published(as_messages(cut, target), audit.publish_counts(routed, sent))


def publish_records(
    bundles: DataFrame,
    target: Target,
    schema: T.StructType | str,
    reader: records.Format = "csv",
    writer: records.Format = "csv",
    key_field: str | None = None,
    partial: str = "none",
    options: dict[str, str] | None = None,
    ends: DataFrame | None = None,
    writer_options: dict[str, str] | None = None,
) -> Published:
    """The record publisher: each record of a bundle's content is a message.

    Keys come from a record field alone, never from the bundle. ``ends`` as above. Bundles are
    parsed and their records written once, into a stored table; offsets are numbered over its
    narrow columns, and messages and bundles are read from it.
    """
    addressed = publish.with_properties(publish.with_topic(with_id(bundles), target.topic), target.properties)
    parsed = records.parse(addressed, schema, reader, options, data="content")
    routed = publish.route(parsed, partial)
    messages = publish.record_messages(schema, writer, key_field, writer_options)
    made = hold(routed.withColumn("messages", messages).withColumn("sent", F.size("records").cast("bigint")).drop("records"), "record-bundles")
    numbered = publish.assign_offsets(made.select("bundle_id", "topic", "sent").where("sent > 0"), F.col("sent"), ends=ends)
    sending = made.select("bundle_id", "topic", "properties", "messages").where("sent > 0")
    placed = sending.join(numbered.select("bundle_id", "first_off"), "bundle_id")
    cut = placed.select("topic", "properties", "first_off", F.posexplode("messages").alias("pos", "_message"))
    cut = cut.select("topic", "properties", "first_off", "pos", "_message.*")
    return Published(as_messages(cut, target), audit.publish_counts(made.drop("messages"), F.col("sent")).drop("sent"))


def with_id(bundles: DataFrame) -> DataFrame:
    """Bundles whose missing ids raise. It is the id itself that raises: a join on it would drop such rows unseen."""
    missing = F.raise_error(F.lit("a bundle without bundle_id cannot be put in order")).cast(bundles.schema["bundle_id"].dataType)
    return bundles.withColumn("bundle_id", F.coalesce("bundle_id", missing))


def as_messages(cut: DataFrame, target: Target) -> DataFrame:
    numbered = cut.withColumn("off", F.col("first_off") + F.col("pos"))
    placed = publish.route_partitions(numbered, target.partitions, target.routing, "off", target.partition)
    return conform(placed.withColumn("publish_time", F.current_timestamp()), MESSAGE_SCHEMA)
