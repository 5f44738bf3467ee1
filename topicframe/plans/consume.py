"""From subscribed messages to bundles."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import attributes as A
from ..functions import payload as P
from ..functions import schemas
from ..functions.mapping import map_of
from ..operators import bundling, delivery, records
from ..operators.receive import LOG, assign_receive_batches
from ..schema import BUNDLE_SCHEMA, conform


@dataclass(frozen=True)
class Subscription:
    """Settings shared by both consumers.

    A receive batch is full but for a log's last. With ``segment`` it also ends where the log
    enters its next segment of that many offsets, which saves a pass and a shuffle but makes
    bundles depend on how dense the offsets are.
    """

    consumer_id: str
    mapping: str | None = None
    demarcator: str = C.DEFAULT_DEMARCATOR
    max_messages: int = C.DEFAULT_RECEIVE_BATCH
    scope: str = "mapped"
    by: Sequence[str] = LOG
    segment: int | None = None
    subscription_type: str = C.SHARED

    def acknowledge(self, bundles: DataFrame, messages: DataFrame) -> DataFrame:
        """Acknowledgements for messages whose bundles are written.

        Where they are cumulative, empty bundles must be among them (``drop_empty=False``).
        """
        return delivery.acknowledger(self.subscription_type, self.consumer_id)(bundles, messages)

    def batches(self, messages: DataFrame) -> tuple[DataFrame, list[str]]:
        """The messages in receive batches, and the columns that name a batch."""
        cut = assign_receive_batches(messages, self.max_messages, self.by, segment=self.segment)
        within = [*self.by, "batch_no"] if self.segment is None else [*self.by, "segment_no", "batch_no"]
        return cut, within

    def shared_attributes(self, records: bool) -> dict[str, Column]:
        """Attributes equal on all messages of a run, as columns under their final names.

        The record consumer's runs also share topic and schema. In ``all`` scope that is every
        attribute, kept as one map under the empty name.
        """
        if self.scope == "all":
            return {"": A.automatic(self.mapping, records)}
        if self.scope != "mapped":
            raise ValueError(f"unknown scope {self.scope!r}; use mapped or all")
        values = A.mapped_values(self.mapping)
        if records:
            values[C.TOPIC_ATTRIBUTE] = F.col("topic")
            schema = A.schema_text()
            mapped = values.get(C.SCHEMA_ATTRIBUTE)
            values[C.SCHEMA_ATTRIBUTE] = schema if mapped is None else F.coalesce(schema, mapped)
        return values

    def numbered(self, messages: DataFrame, records: bool, carried: Sequence[Column] = ()) -> _Runs:
        """Batches and runs over no more than the columns a consumer needs, and those carried.

        Shared attributes are taken from the messages before they are moved. Message id and
        properties are those of a run's first message; the map of all is built once per bundle.
        """
        shared = self.shared_attributes(records)
        columns = {name: f"_attribute{i}" for i, name in enumerate(shared)}
        whole = "" in columns
        narrow = messages.select(
            *LOG,
            "off",
            "data",
            F.col("schema_def").isNotNull().alias("_has_schema"),
            *carried,
            *[value.alias(columns[name]) for name, value in shared.items()],
            *([] if whole else ["message_id", "properties"]),
        )
        first = F.min_by(F.struct(*columns.values(), *([] if whole else ["message_id", "properties"])), "off")
        of_first = lambda name: F.col("_first").getField(name)
        if whole:
            key = F.struct(A.entries(F.col(columns[""])).alias("entries"))
            attributes = lambda added: A.merge(of_first(columns[""]), map_of(added))
        else:
            key = F.struct(F.lit(0).alias("_"), *columns.values())
            late = (C.TOPIC_ATTRIBUTE, C.SCHEMA_ATTRIBUTE) if records else ()

            def attributes(added: dict[str, Column]) -> Column:
                early = map_of({n: of_first(c) for n, c in columns.items() if n not in late})
                last = map_of({**{n: of_first(columns[n]) for n in late}, **added})
                carried = [A.message_id(of_first("message_id")), A.prefixed_properties(of_first("properties"))]
                return A.merge(early, *carried, last)

        cut, within = self.batches(narrow)
        if records and "topic" not in within:
            within = [*within, "topic"]
        return _Runs(bundling.runs(cut, key, within), within, [first.alias("_first")], attributes)


@dataclass(frozen=True)
class _Runs:
    """Messages with their run; what names a batch; aggregates that keep the attributes; and the
    map of those and any added ones, which win."""

    messages: DataFrame
    within: list[str]
    kept: list[Column]
    attributes: Callable[[dict[str, Column]], Column]


def consume_bytes(messages: DataFrame, sub: Subscription, drop_empty: bool = True) -> DataFrame:
    """The raw consumer: payloads of each run joined by the demarcator.

    Runs break on mapped attributes alone. A bundle that mixes topics, as batches across topics
    may give, has no topic of its own.
    """
    runs = sub.numbered(messages, records=False)
    topic = F.when(F.min("topic") == F.max("topic"), F.min("topic"))
    bundles = bundling.concat(
        runs.messages, sub.demarcator, runs.within, drop_empty, extra=[topic.alias("_topic"), *runs.kept]
    )
    counted = runs.attributes({C.MESSAGE_COUNT_ATTRIBUTE: F.col("message_count")})
    named = (
        bundles.withColumn("topic", F.col("_topic"))
        .withColumn("consumer_id", F.lit(sub.consumer_id))
        .withColumn("attributes", counted)
        .withColumn("relationship", F.lit(C.SUCCESS))
        .withColumnRenamed("run", "bundle_no")
    )
    return conform(named, BUNDLE_SCHEMA)


def consume_records(
    messages: DataFrame,
    sub: Subscription,
    schema: T.StructType | str | None = None,
    reader: records.Format = "csv",
    writer: records.Format = "csv",
    options: dict[str, str] | None = None,
    needs_schema: bool = False,
    writer_options: dict[str, str] | None = None,
) -> DataFrame:
    """The record consumer: good records of each run rewritten, bad messages kept whole.

    Without ``schema`` each message is read by the schema it carries itself, an Avro record schema
    as JSON text (``functions.schemas``), and a message whose schema text is missing or cannot be
    read is one whose schema cannot be found.

    A run yields up to two bundles, one per route, both from a single aggregation. Messages
    are parsed and rewritten in their own rows beforehand. With ``needs_schema`` a message
    without schema text counts as one whose schema cannot be found.
    """
    if schema is None:
        numbered = sub.numbered(messages, records=True, carried=[schemas.key_of(F.col("schema_def")).alias("_schema_key")])
        placed = records.with_own_fields(numbered.messages, messages)
        reader, writer = schemas.reader(reader, options), schemas.writer(writer, writer_options)
        parsed = records.route(records.parse(placed, "", reader)).withColumn("_has_schema", F.col("_fields").isNotNull())
        needs_schema = True
    else:
        numbered = sub.numbered(messages, records=True)
        parsed = records.route(records.parse(numbered.messages, schema, reader, options))
    if needs_schema:
        parsed = parsed.withColumn("failed", F.col("failed") | ~F.col("_has_schema")).withColumn(
            "kept", F.when(F.col("_has_schema"), F.col("kept")).otherwise(F.slice("kept", F.lit(1), F.lit(0)))
        )
    rewritten = parsed.withColumn("_written", records.written(F.col("kept"), writer, writer_options)).withColumn(
        "_bad", F.when(F.col("failed"), F.col("data"))
    )
    runs = rewritten.groupBy("run", *reversed(numbered.within)).agg(
        F.expr("listagg(_written, X'') within group (order by off)").alias("_good"),
        P.joined("_bad", sub.demarcator, "off").alias("_failed"),
        F.sum(F.size("kept")).alias("record_count"),
        F.count("*").alias("message_count"),
        F.count("_bad").alias("_failed_count"),
        F.min("off").alias("first_off"),
        F.max("off").alias("last_off"),
        *numbered.kept,
    )
    counted = numbered.attributes({C.RECORD_COUNT_ATTRIBUTE: F.col("record_count")})
    nothing = F.lit(0).cast("bigint")
    routes = F.array(
        F.struct(
            F.lit(C.SUCCESS).alias("relationship"),
            F.col("_good").alias("content"),
            counted.alias("attributes"),
            F.col("record_count"),
            F.col("message_count"),
        ),
        F.struct(
            F.lit(C.PARSE_FAILURE).alias("relationship"),
            F.col("_failed").alias("content"),
            F.create_map().cast("map<string,string>").alias("attributes"),
            nothing.alias("record_count"),
            F.col("_failed_count").alias("message_count"),
        ),
    )
    routed = runs.select(
        *numbered.within, F.col("run").alias("bundle_no"), "first_off", "last_off", F.inline(routes)
    ).where((F.col("relationship") == C.PARSE_FAILURE) & (F.col("message_count") > 0) | (F.col("record_count") > 0))
    return conform(routed.withColumn("consumer_id", F.lit(sub.consumer_id)), BUNDLE_SCHEMA)
