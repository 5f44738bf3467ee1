"""The given tables seen as messages, bundles and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codecs
from ..functions.mapping import map_of
from ..operators import bundling, chunking
from ..operators.receive import LOG, assign_receive_batches
from ..schema import MESSAGE_SCHEMA, conform
from ..sources import files

NAMESPACE = "persistent://public/default/"
RECORD = "uid bigint, cents bigint"
ORDER = "orderkey bigint, custkey bigint, status string, priority string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages: null keys and tiers, empty and malformed payloads included."""
    user, event = F.col("user_id"), F.col("event_id")
    cents = F.round(F.col("value") * 100).cast("bigint")
    tier = F.when(user % 3 != 0, F.concat(F.lit("t"), (user % 3).cast("string")))
    body = (
        F.when(event % 97 == 0, "")
        .when(event % 53 == 0, "Malformed message")
        .otherwise(F.concat_ws(",", user.cast("string"), cents.cast("string")))
    )
    part = (user % 4).cast("int")
    return conform(
        table(spark, sf_dir, "events").select(
            F.concat(F.lit(NAMESPACE), "event_type").alias("topic"),
            part.alias("part"),
            event.alias("off"),
            F.concat_ws(":", event.cast("string"), part.cast("string")).alias("message_id"),
            F.when(user % 10 != 0, user.cast("string")).alias("key"),
            map_of({"tier": tier, "etype": F.col("event_type")}).alias("properties"),
            F.col("ts").cast("timestamp").alias("publish_time"),
            F.when(user % 4 == 0, "AVRO").otherwise("JSON").alias("schema_type"),
            F.concat(F.lit("v"), F.expr("event_id div 5000 + 1").cast("string")).alias("schema_def"),
            body.cast("binary").alias("data"),
        ),
        MESSAGE_SCHEMA,
    )


#: files a bounded poll takes in queries, so that streams are read in several polls
SOME_FILES = 8


def json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages whose payload is the event's JSON properties."""
    return messages(spark, sf_dir).drop("data").join(
        table(spark, sf_dir, "events").select(F.col("event_id").alias("off"), F.col("props").cast("binary").alias("data")), "off"
    )


#: schema texts of two kinds of record, one that is no record, and one that is no JSON
OWN_SCHEMAS = (
    '{"type":"record","name":"Seen","fields":[{"name":"uid","type":"long"},{"name":"kind","type":["null","string"]}]}',
    '{"type":"record","name":"Paid","fields":[{"name":"uid","type":"long"},{"name":"cents","type":["long","null"]},{"name":"tags","type":{"type":"array","items":"string"}}]}',
    '{"type":"enum","name":"Kind","symbols":["a"]}',
    '{"type":"record","fields":[{"name":"uid"',
)


def own_schema_messages(spark: SparkSession, sf_dir: str, fmt: str = "json") -> DataFrame:
    """Events as messages that each carry a schema of their own; every 41st has a uid that does not fit it.

    In JSON a message holds two records with the fields of both schemas; as CSV one line for its own.
    """
    event, user = F.col("event_id"), F.col("user_id")
    cents = F.when(user % 5 != 0, F.round(F.col("value") * 100).cast("bigint"))
    uid = F.when(event % 41 == 0, F.lit('"none"')).otherwise(user.cast("string"))
    text = lambda *pieces: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in pieces))
    amount = F.coalesce(cents.cast("string"), F.lit("null"))
    first = text('{"kind": "', F.col("event_type"), '", "uid": ', user.cast("string"), ', "cents": ', amount, ', "tags": ["a", "', event.cast("string"), '"]}')
    second = text('{"uid":', uid, ',"tags":[],"cents":', amount, "}")
    line = text(F.replace(uid, F.lit('"'), F.lit("")), ",", F.when(event % 3 == 0, F.col("event_type")).otherwise(F.coalesce(cents.cast("string"), F.lit(""))))
    number = F.expr("if(event_id % 10 = 9, event_id % 20 div 10 + 2, event_id % 3 div 2)")
    schema = F.get(F.array(*map(F.lit, OWN_SCHEMAS)), number.cast("int"))
    body = text("[", first, ", ", second, "]") if fmt == "json" else line
    own = table(spark, sf_dir, "events").select(event.alias("off"), F.when(event % 29 != 0, schema).alias("schema_def"), body.cast("binary").alias("data"))
    return conform(messages(spark, sf_dir).drop("schema_def", "data").join(own, "off"), MESSAGE_SCHEMA)


def many_record_messages(spark: SparkSession, sf_dir: str, lines: int = 20) -> DataFrame:
    """Messages of up to ``lines`` records each: consecutive payloads joined by newlines."""
    batched = assign_receive_batches(messages(spark, sf_dir), lines)
    joined = bundling.concat(
        bundling.runs(batched, F.struct("topic")),
        "\n",
        extra=[F.max("publish_time").alias("publish_time")],
    )
    return joined.select(*LOG, F.col("first_off").alias("off"), "publish_time", F.col("content").alias("data"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as bundles. German ones lack a topic attribute."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("bundle_id"),
        map_of(
            {
                "topic": F.when(F.col("lang") != "de", F.col("lang")),
                "lang": F.col("lang"),
                "source": F.col("source"),
            }
        ).alias("attributes"),
        F.col("text").cast("binary").alias("content"),
    )


LANGS = ("de", "en", "es", "fr")


def document_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Documents written below root, a text file for each language and thousand; the files as bundles.

    German ones lack a topic attribute; a last bundle names no file.
    """
    block = F.expr("doc_id div 1000").alias("block")
    texts = table(spark, sf_dir, "documents").select("text", "lang", block, "doc_id")
    laid = texts.repartition("lang", "block").sortWithinPartitions("lang", "block", "doc_id").drop("doc_id")
    laid.write.partitionBy("lang", "block").text(root)
    found = files.listed(spark, root)
    place = F.array_position(F.array(*map(F.lit, LANGS)), F.col("lang"))
    bundles = found.select((F.col("block") * 10 + place).cast("bigint").alias("bundle_id"), map_of({"topic": F.when(F.col("lang") != "de", F.col("lang")), "lang": F.col("lang")}).alias("attributes"), "path")
    lost = spark.range(1).select(F.lit(0).cast("bigint").alias("bundle_id"), map_of({"topic": F.lit("en"), "lang": F.lit("en")}).alias("attributes"), F.lit("nowhere").alias("path"))
    return bundles.unionByName(lost)


def order_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Orders as CSV lines in files of ten thousand order keys, with a header; in some files keys ending in 777 are malformed."""
    key = F.col("orderkey")
    line = F.regexp_replace(codecs.serialize(order_record(), "csv"), "\n$", "")
    spoilt = (key % 1000 == 777) & (F.expr("orderkey div 10000") % 3 == 1)
    lines = orders(spark, sf_dir).select(F.when(spoilt, F.concat(F.lit("broken "), key.cast("string"))).otherwise(line).alias("line"), F.expr("orderkey div 10000").alias("number"), "orderkey")
    heads = lines.select("number").distinct().select(F.lit("orderkey,custkey,status,priority").alias("line"), "number", F.lit(-1).cast("bigint").alias("orderkey"))
    laid = lines.unionByName(heads).repartition("number").sortWithinPartitions("number", "orderkey").drop("orderkey")
    laid.write.partitionBy("number").text(root)
    found = files.listed(spark, root)
    return found.select(F.col("number").cast("bigint").alias("bundle_id"), map_of({"topic": F.lit("orders")}).alias("attributes"), "path")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as typed records."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def order_record() -> Column:
    return F.struct("orderkey", "custkey", "status", "priority")


def order_attributes() -> Column:
    """Attributes of an order: no status when pending, a key of its own for some."""
    return map_of(
        {
            "status": F.when(F.col("status") != "P", F.col("status")),
            "cust": F.when(F.col("custkey") % 7 != 0, F.col("custkey").cast("string")),
            "msg.key": F.when(F.col("custkey") % 5 == 0, F.lit("fallback")),
        }
    )


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages, each a quoted CSV line, by status and customer."""
    return orders(spark, sf_dir).select(
        F.concat(F.lit("orders-"), "status").alias("topic"),
        (F.col("custkey") % 4).cast("int").alias("part"),
        F.col("orderkey").alias("off"),
        order_record().alias("order"),
        codecs.serialize(order_record(), "csv").cast("binary").alias("data"),
    )


def order_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bundles of up to a hundred CSV lines."""
    batched = assign_receive_batches(order_messages(spark, sf_dir), 100)
    joined = bundling.concat(bundling.runs(batched, F.struct("topic")), "")
    return joined.select(
        F.col("first_off").alias("bundle_id"),
        map_of({"topic": F.col("topic")}).alias("attributes"),
        "content",
    )


def document_chunks(spark: SparkSession, sf_dir: str, max_bytes: int = 500) -> DataFrame:
    """Document texts cut into chunks, a minute apart by document."""
    whole = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.timestamp_seconds(F.col("doc_id") * 60).alias("publish_time"),
        F.col("text").cast("binary").alias("data"),
    )
    return chunking.split(whole, max_bytes, "doc_id")


def broken_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the first chunk of German documents lost."""
    return document_chunks(spark, sf_dir).where(~((F.col("lang") == "de") & (F.col("chunk_no") == 0)))
