"""Spark side: every entry calls the library's operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import attributes as A
from ..functions import codecs
from ..functions.templates import render
from ..operators import audit, bundling, chunking, delivery, intervals, publish, records
from ..operators.receive import assign_receive_batches
from ..plans import consume
from ..plans import publish as publishers
from ..plans import publish_files as publish_files_plan
from ..sinks import tables
from ..sources import topics
from ..streaming import reader, runner, stateful
from ..workspace import fresh_path, hold
from . import views as V

Query = Callable[[SparkSession, str], DataFrame]

CONSUMER = "events-audit"
BROKER = "broker://local"
MARK = "***"
# what a broker would know beside the log: when the subscription was made, how far it got,
# and which messages were acknowledged (here those with a key)
SUBSCRIBED = "publish_time < timestamp '2024-01-15 00:00:00'"
PROCESSED = "publish_time < timestamp '2024-01-25 00:00:00'"
ACKED = "key is not null"
OPEN = "key is null"
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _big(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def _n() -> Column:
    return F.count("*").alias("n")


def _md5(column: str, name: str = "digest") -> Column:
    return F.md5(column).alias(name)


def _checksum(column: str) -> Column:
    """Order-free sum over payload digests."""
    return F.sum(F.conv(F.substring(F.md5(column), 1, 8), 16, 10).cast("bigint")).alias("checksum")


def _name_values(df: DataFrame, attributes: Column, key: str = "off") -> DataFrame:
    return df.select(key, F.explode(attributes).alias("name", "value"))


def _batched(spark: SparkSession, sf_dir: str, size: int = 100) -> DataFrame:
    return assign_receive_batches(V.messages(spark, sf_dir), size)


def _subscription(**settings) -> consume.Subscription:
    return consume.Subscription(CONSUMER, **{"mapping": "tier", "demarcator": MARK, "max_messages": 100, **settings})


# ---------------------------------------------------------------- whole consumers


@query
def consume_bundles(spark, sf_dir):
    bundles = consume.consume_bytes(V.messages(spark, sf_dir), _subscription())
    return bundles.select(
        "topic",
        _big("part").alias("part"),
        "batch_no",
        F.col("bundle_no").alias("run"),
        F.col("attributes").getItem("tier").alias("tier"),
        "message_count",
        F.col("last_off").alias("cum_ack"),
        _md5("content"),
    )


def _bundle_keys(bundles: DataFrame) -> DataFrame:
    return bundles.select(
        "topic",
        _big("part").alias("part"),
        "batch_no",
        F.col("bundle_no").alias("run"),
        "message_count",
        "first_off",
        _md5("content"),
    )


@query
def consume_short_segments(spark, sf_dir):
    return _bundle_keys(consume.consume_bytes(V.messages(spark, sf_dir), _subscription(segment=4096)))


@query
def consume_full_batches(spark, sf_dir):
    return _bundle_keys(consume.consume_bytes(V.messages(spark, sf_dir), _subscription(segment=None)))


@query
def consume_sparse_offsets(spark, sf_dir):
    """The same log with offsets far apart has the same bundles."""
    sparse = V.messages(spark, sf_dir).withColumn("off", F.col("off") * 70_000)
    bundles = _bundle_keys(consume.consume_bytes(sparse, _subscription()))
    return bundles.withColumn("first_off", F.expr("first_off div 70000"))


@query
def consume_attributes(spark, sf_dir):
    """Every attribute of every bundle, of both consumers in both scopes."""
    log = V.messages(spark, sf_dir)

    def listed(scope: str, consumer: str) -> DataFrame:
        sub = _subscription(scope=scope)
        made = consume.consume_bytes(log, sub) if consumer == "bytes" else consume.consume_records(log, sub, V.RECORD)
        good = made.where(F.col("relationship") == C.SUCCESS)
        rows = good.select("topic", _big("part").alias("part"), "first_off", F.explode("attributes").alias("name", "value"))
        return rows.withColumns({"scope": F.lit(scope), "consumer": F.lit(consumer)})

    return _union([listed(scope, consumer) for scope in ("mapped", "all") for consumer in ("bytes", "records")])


@query
def json_lines(spark, sf_dir):
    """Several JSON records in a message: a line each, leftovers behind some, some arrays cut off."""
    batched = assign_receive_batches(V.json_messages(spark, sf_dir), 10)
    joined = bundling.concat(bundling.runs(batched, F.struct("topic")), "\n")
    broken = F.when(F.col("first_off") % 3 == 0, F.concat(F.col("content").cast("string"), F.lit("\nleft over")))
    arrays = F.concat(F.lit("["), F.replace(F.col("content").cast("string"), F.lit("\n"), F.lit(",")))
    cut_off = F.when(F.col("first_off") % 3 == 1, arrays)
    text = F.coalesce(broken, cut_off, F.col("content").cast("string"))
    parsed = records.route(records.parse(joined.withColumn("data", text.cast("binary")), "k bigint", "json"))
    kept = F.aggregate("kept", F.lit(0).cast("bigint"), lambda total, r: total + r["k"])
    return parsed.select("topic", "first_off", _big(F.size("kept")).alias("n"), kept.alias("k_sum"), "failed")


@query
def csv_roundtrip(spark, sf_dir):
    """Texts with quotes, line breaks and nulls, written as CSV and read back."""
    null_text = {"nullValue": "\\N"}
    docs = V.table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 10 != 0, F.col("text")).alias("text"), F.concat(F.lit('say "'), "lang", F.lit('", '), "source").alias("quoted")
    )
    written = codecs.serialize(F.struct("doc_id", "text", "quoted"), "csv", null_text)
    lines = docs.select(F.concat(F.lit(codecs.csv_header(docs.columns)), written).cast("binary").alias("data"))
    back = records.parse(lines, "doc_id bigint, text string, quoted string", "csv", {**null_text, "header": "true"})
    rows = records.explode(back)
    return rows.select("doc_id", _md5("text"), "quoted", F.col(codecs.CORRUPT).isNotNull().alias("corrupt"))


@query
def consume_record_bundles(spark, sf_dir):
    bundles = consume.consume_records(V.messages(spark, sf_dir), _subscription(), V.RECORD)
    return bundles.select(
        "topic",
        _big("part").alias("part"),
        "batch_no",
        "bundle_no",
        "relationship",
        "record_count",
        "message_count",
        F.col("attributes").getItem(C.SCHEMA_ATTRIBUTE).alias("schema"),
        _md5("content"),
    )


def _own_schemas(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    log = V.own_schema_messages(spark, sf_dir, fmt)
    return consume.consume_records(log, _subscription(), None, fmt, fmt).select(
        "topic",
        _big("part").alias("part"),
        "batch_no",
        "bundle_no",
        "relationship",
        "record_count",
        "message_count",
        F.col("attributes").getItem(C.SCHEMA_ATTRIBUTE).alias("schema"),
        _md5("content"),
    )


@query
def consume_own_schemas(spark, sf_dir):
    """Each message read by the schema it carries: two kinds of record, broken texts, none."""
    return _own_schemas(spark, sf_dir, "json")


@query
def consume_own_csv(spark, sf_dir):
    """The same with lines, whose fields go by place."""
    return _own_schemas(spark, sf_dir, "csv")


# ---------------------------------------------------------------- sources


@query
def topic_list(spark, sf_dir):
    wanted = f"{V.NAMESPACE}click, {V.NAMESPACE}view"
    found = topics.read_topics(spark, _staged(spark, sf_dir), topics=wanted)
    return found.select("topic", _big("part").alias("part"), "off", _md5("data"))


@query
def topic_pattern(spark, sf_dir):
    found = topics.read_topics(spark, _staged(spark, sf_dir), pattern=V.NAMESPACE + "(p|s).*")
    return found.select("topic", _big("part").alias("part"), "off", _md5("data"))


@query
def start_position(spark, sf_dir):
    log = V.messages(spark, sf_dir)
    ends = hold(topics.snapshot(log.where(SUBSCRIBED)), "snapshot")
    return _union(
        [
            topics.start_position(log, ends, start)
            .groupBy("topic")
            .agg(_n(), F.min("off").alias("lo"))
            .withColumn("mode", F.lit(start))
            for start in ("earliest", "latest")
        ]
    )


@query
def resume_cursor(spark, sf_dir):
    log = V.messages(spark, sf_dir)
    identity = topics.consumer_identity("audit", topics="all-events")
    earlier = topics.snapshot(log.where(PROCESSED))
    cursors = hold(earlier.withColumn("consumer_id", F.lit(identity)), "cursors")
    return (
        topics.resume(log, cursors, identity)
        .groupBy("topic", _big("part").alias("part"))
        .agg(_n(), F.min("off").alias("lo"))
    )


@query
def receive_batches(spark, sf_dir):
    return (
        _batched(spark, sf_dir)
        .groupBy("topic", _big("part").alias("part"), "batch_no")
        .agg(_n(), F.min("off").alias("lo"), F.max("off").alias("hi"))
    )


@query
def parse_records(spark, sf_dir):
    parsed = records.parse(V.messages(spark, sf_dir), V.RECORD, "csv")
    return records.explode(parsed).select(
        "off", _big("pos").alias("pos"), "uid", "cents", F.col(codecs.CORRUPT).isNotNull().alias("corrupt")
    )


@query
def parse_json_records(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").select("event_id", F.col("props").cast("binary").alias("data"))
    return records.explode(records.parse(events, "k bigint", "json")).select("event_id", "k")


# ---------------------------------------------------------------- attributes


@query
def mapped_attributes(spark, sf_dir):
    built = A.mapped("tier,kind=etype, =x,none=missing")
    return V.messages(spark, sf_dir).select("off", A.as_text(built).alias("entries"))


@query
def key_attribute(spark, sf_dir):
    return V.messages(spark, sf_dir).select("off", A.mapped(f"uid={C.KEY_SOURCE}").getItem("uid").alias("value"))


@query
def id_attribute(spark, sf_dir):
    return _name_values(V.messages(spark, sf_dir), A.message_id())


@query
def prefixed_properties(spark, sf_dir):
    return _name_values(V.messages(spark, sf_dir), A.prefixed_properties())


@query
def topic_attribute(spark, sf_dir):
    return _name_values(V.messages(spark, sf_dir), A.topic())


@query
def schema_attribute(spark, sf_dir):
    return _name_values(V.messages(spark, sf_dir), A.schema())


@query
def merged_attributes(spark, sf_dir):
    spec = f"{C.TOPIC_ATTRIBUTE}=tier,{C.MESSAGE_ID_ATTRIBUTE}={C.KEY_SOURCE},a=tier"
    return V.messages(spark, sf_dir).select("off", A.as_text(A.automatic(spec, records=True)).alias("entries"))


@query
def render_template(spark, sf_dir):
    text = render("orders-${status}/${cust}", V.order_attributes())
    return V.orders(spark, sf_dir).select("orderkey", text.alias("rendered"))


@query
def dynamic_topic(spark, sf_dir):
    bundles = V.orders(spark, sf_dir).withColumn("attributes", V.order_attributes())
    return publish.with_topic(bundles, "orders-${status}").select("orderkey", "topic")


@query
def message_key(spark, sf_dir):
    bundles = V.orders(spark, sf_dir).withColumn("attributes", V.order_attributes())
    return publish.with_key(bundles, "${cust}").select("orderkey", "key")


@query
def message_properties(spark, sf_dir):
    bundles = V.orders(spark, sf_dir).withColumn("attributes", V.order_attributes())
    with_map = publish.with_properties(bundles, "state=status,cust,none")
    return _name_values(with_map, F.col("properties"), "orderkey")


@query
def key_from_field(spark, sf_dir):
    rows = V.orders(spark, sf_dir).select(
        "orderkey",
        F.col("custkey").alias("number"),
        F.col("priority").alias("text"),
        F.col("priority").cast("binary").alias("bytes"),
        F.struct("status", "custkey").alias("nested"),
        F.when(F.col("status") == "F", F.col("status")).alias("absent"),
    )
    return _union(
        [
            publish.with_key_field(rows, field).select("orderkey", F.lit(field).alias("field"), "key")
            for field in ("number", "text", "bytes", "nested", "absent")
        ]
    )


# ---------------------------------------------------------------- bundling


@query
def topic_groups(spark, sf_dir):
    mixed = assign_receive_batches(V.messages(spark, sf_dir), 100, by=("part",))
    return (
        bundling.by_topic(mixed, ("part", "batch_no"))
        .groupBy(_big("part").alias("part"), "batch_no", "topic")
        .agg(_n(), F.min("off").alias("first_off"), F.max("topic_pos").alias("last_pos"))
    )


@query
def bundle_runs(spark, sf_dir):
    def counted(scope: str) -> DataFrame:
        numbered = bundling.runs(_batched(spark, sf_dir), bundling.run_key("tier", scope))
        return (
            numbered.groupBy("topic", _big("part").alias("part"), "batch_no", "run")
            .agg(_n())
            .withColumn("scope", F.lit(scope))
        )

    return counted("mapped").unionByName(counted("all"))


def _contents(spark, sf_dir, drop_empty: bool = True) -> DataFrame:
    numbered = bundling.runs(_batched(spark, sf_dir), bundling.run_key("tier"))
    return bundling.concat(numbered, MARK, drop_empty=drop_empty)


@query
def bundle_content(spark, sf_dir):
    return _contents(spark, sf_dir).select("topic", _big("part").alias("part"), "batch_no", "run", _md5("content"))


@query
def message_counts(spark, sf_dir):
    return _contents(spark, sf_dir, drop_empty=False).select(
        "topic", _big("part").alias("part"), "batch_no", "run", "message_count"
    )


@query
def empty_bundles(spark, sf_dir):
    return _union(
        [
            _contents(spark, sf_dir, flag).groupBy("topic").agg(_n()).withColumn("drop_empty", F.lit(flag))
            for flag in (True, False)
        ]
    )


@query
def record_counts(spark, sf_dir):
    parsed = records.route(records.parse(V.many_record_messages(spark, sf_dir), V.RECORD))
    return records.counts(parsed).select("topic", _big("part").alias("part"), "off", "record_count")


@query
def schema_runs(spark, sf_dir):
    numbered = bundling.runs(_batched(spark, sf_dir, 1000), bundling.run_key(None, records=True))
    return numbered.groupBy("topic", _big("part").alias("part"), "batch_no", "run").agg(
        _n(), F.min(A.schema_text()).alias("schema")
    )


@query
def failure_bundles(spark, sf_dir):
    numbered = bundling.runs(_batched(spark, sf_dir, 1000), F.struct("topic"))
    parsed = records.route(records.parse(numbered, V.RECORD))
    return bundling.failures(parsed, MARK).select(
        "topic", _big("part").alias("part"), "batch_no", _md5("content"), F.col("failed_count").alias("n")
    )


@query
def audit_receipts(spark, sf_dir):
    bundles = consume.consume_bytes(V.messages(spark, sf_dir), _subscription())
    return audit.receipts(bundles, BROKER)


@query
def publish_counts(spark, sf_dir):
    published = publishers.publish_bytes(V.documents(spark, sf_dir), publishers.Target("docs-${lang}"), demarcator="\n")
    return published.bundles.select(
        "bundle_id",
        F.col("attributes").getItem(C.PUBLISHED_COUNT_ATTRIBUTE).alias("sent"),
        F.col("attributes").getItem(C.PUBLISHED_TOPIC_ATTRIBUTE).alias("topic"),
    )


@query
def audit_sends(spark, sf_dir):
    published = publishers.publish_bytes(V.documents(spark, sf_dir), publishers.Target("${topic}"), demarcator="\n")
    return audit.sends(published.bundles, BROKER)


# ---------------------------------------------------------------- splitting and writing


@query
def whole_messages(spark, sf_dir):
    return publish.to_messages(V.documents(spark, sf_dir)).select("bundle_id", _md5("data"))


@query
def split_messages(spark, sf_dir):
    cut = publish.split(V.documents(spark, sf_dir), "\n")
    return cut.select("bundle_id", _big("pos").alias("pos"), _md5("data"))


@query
def explode_records(spark, sf_dir):
    parsed = records.parse(V.many_record_messages(spark, sf_dir), V.RECORD)
    return records.explode(parsed).select(
        "topic",
        _big("part").alias("part"),
        "off",
        _big("pos").alias("pos"),
        "uid",
        F.col(codecs.CORRUPT).isNotNull().alias("corrupt"),
    )


@query
def records_to_messages(spark, sf_dir):
    rows = V.orders(spark, sf_dir)
    return _union(
        [
            publish.records_to_messages(rows, V.order_record(), fmt).select(
                "orderkey", F.lit(fmt).alias("fmt"), _md5("data")
            )
            for fmt in ("json", "csv")
        ]
    )


@query
def written_bundles(spark, sf_dir):
    batched = assign_receive_batches(V.order_messages(spark, sf_dir), 100)
    parsed = records.route(records.parse(batched, V.ORDER, "csv"))
    return records.write(parsed, "json", ("topic", "part", "batch_no")).select(
        "topic", _big("part").alias("part"), "batch_no", _md5("content"), F.col("record_count").alias("n")
    )


# ---------------------------------------------------------------- failures


@query
def prefix_keep(spark, sf_dir):
    parsed = records.route(records.parse(V.many_record_messages(spark, sf_dir), V.RECORD))
    total = F.aggregate("kept", F.lit(0).cast("bigint"), lambda acc, r: acc + r["uid"])
    return parsed.select(
        "topic",
        _big("part").alias("part"),
        "off",
        _big(F.size("kept")).alias("kept"),
        total.alias("uid_sum"),
        "failed",
    )


@query
def schema_failures(spark, sf_dir):
    known = F.col("properties").getItem("tier").isNotNull()
    log = V.messages(spark, sf_dir).withColumn("schema_def", F.when(known, F.col("schema_def")))
    return records.route_schema(log).select("topic", "off", "relationship")


@query
def unreadable_schemas(spark, sf_dir):
    """Schema texts that are there but are no schema fail as missing ones do."""
    log = V.own_schema_messages(spark, sf_dir)
    return records.route_schema(log, readable=True).select("topic", "off", "relationship")


@query
def publish_routes(spark, sf_dir):
    routed = publish.route(publish.with_topic(V.documents(spark, sf_dir), "${topic}"))
    return routed.groupBy("topic", "relationship").agg(_n(), _checksum("content"))


@query
def publish_record_routes(spark, sf_dir):
    bundles = V.many_record_messages(spark, sf_dir).select(
        F.col("off").alias("bundle_id"),
        F.create_map(F.lit("t"), "topic").alias("attributes"),
        F.col("data").alias("content"),
    )

    def counted(partial: str) -> DataFrame:
        published = publishers.publish_records(bundles, publishers.Target("${t}"), V.RECORD, partial=partial)
        sent = published.messages.groupBy("topic").agg(_n()).withColumn("what", F.lit("messages"))
        routed = published.bundles.groupBy("topic", F.col("relationship").alias("what")).agg(_n())
        return sent.unionByName(routed).withColumn("partial", F.lit(partial))

    return counted("none").unionByName(counted("prefix"))


@query
def error_policy(spark, sf_dir):
    parsed = records.parse(V.messages(spark, sf_dir), V.RECORD)

    def counted(policy: str) -> DataFrame:
        usable = F.size(F.filter("records", lambda r: r.isNotNull()))
        kept = records.apply_policy(parsed, policy)
        return kept.select("off", "relationship", _big(usable).alias("usable"), F.lit(policy).alias("policy"))

    return _union([counted(policy) for policy in ("consume", "discard", "fail")])


@query
def dead_letters(spark, sf_dir):
    parsed = records.route(records.parse(V.many_record_messages(spark, sf_dir), V.RECORD))
    path = fresh_path(spark, "dead-letters")
    bad = parsed.where("failed").select("topic", "off", "data", F.lit(C.PARSE_FAILURE).alias("relationship"))
    tables.dead_letter(bad, path)
    return spark.read.parquet(path).groupBy("relationship", "topic").agg(_n(), _checksum("data"))


# ---------------------------------------------------------------- publishing


def _written_back(spark, published: publishers.Published, label: str, compression: str = "NONE") -> DataFrame:
    path = fresh_path(spark, label)
    tables.write_messages(published.messages, path, compression)
    return (
        topics.read_topics(spark, path, pattern=".*")
        .groupBy("topic", _big("part").alias("part"))
        .agg(_n(), F.min("off").alias("lo"), F.max("off").alias("hi"), _checksum("data"))
    )


@query
def publish_bytes(spark, sf_dir):
    target = publishers.Target("docs-${topic}", "src=source", partitions=4)
    published = publishers.publish_bytes(V.documents(spark, sf_dir), target, demarcator="\n")
    return _written_back(spark, published, "publish-bytes", "LZ4")


@query
def publish_records(spark, sf_dir):
    target = publishers.Target("${topic}", partitions=4)
    published = publishers.publish_records(
        V.order_bundles(spark, sf_dir), target, V.ORDER, "csv", "json", key_field="custkey"
    )
    return _written_back(spark, published, "publish-records", "ZLIB")


@query
def publish_files(spark, sf_dir):
    """Files as contents: their lines as messages, and each file's route and count."""
    root = fresh_path(spark, "document-files")
    bundles = V.document_files(spark, sf_dir, root)
    published = publish_files_plan.publish_files(bundles, root, publishers.Target("${topic}", "lang", partitions=4), "\n")
    sent = published.messages.select("topic", _big("part").alias("part"), "off", _md5("data"))
    routed = published.bundles.select(F.col("relationship").alias("topic"), F.col("bundle_id").alias("part"), _big("sent_count").alias("off"), F.col("attributes").getItem("lang").alias("digest"))
    return sent.unionByName(routed)


@query
def publish_file_records(spark, sf_dir):
    """Files of records in both partial modes: what is sent of each, and its route."""
    root = fresh_path(spark, "order-files")
    bundles = V.order_files(spark, sf_dir, root)

    def published(partial: str) -> DataFrame:
        target = publishers.Target("${topic}", partitions=4)
        made = publish_files_plan.publish_file_records(
            bundles, root, target, V.ORDER, "csv", "json", key_field="custkey", partial=partial, options={"header": "true"}
        )
        sent = made.messages.select(F.lit("sent").alias("what"), "off", "key", _md5("data"))
        routed = made.bundles.select(F.col("relationship").alias("what"), F.col("bundle_id").alias("off"), F.col("sent_count").cast("string").alias("key"), F.lit("").alias("digest"))
        return sent.unionByName(routed).withColumn("partial", F.lit(partial))

    return published("none").unionByName(published("prefix"))


@query
def partition_routes(spark, sf_dir):
    log = V.messages(spark, sf_dir).drop("part")
    chosen = {
        "RoundRobinPartition": 0,
        "SinglePartition": 2,
        "CustomPartition": F.length("topic") % 4,
    }
    return _union(
        [
            publish.route_partitions(log, 4, mode, "off", partition).select(
                "off", _big("part").alias("part"), F.lit(mode).alias("mode")
            )
            for mode, partition in chosen.items()
        ]
    )


@query
def publish_batches(spark, sf_dir):
    assigned = publish.assign_batches(
        _batched(spark, sf_dir, 1000), 50, 400, timedelta(hours=12), sends_per_flush=100
    )
    return assigned.groupBy("topic", _big("part").alias("part"), "batch_no", "flush_no", "publish_batch").agg(
        _n(), _big(F.sum(F.octet_length("data"))).alias("bytes"), F.min("off").alias("lo")
    )


# ---------------------------------------------------------------- delivery


@query
def cumulative_acks(spark, sf_dir):
    bundles = consume.consume_bytes(V.messages(spark, sf_dir), _subscription(), drop_empty=False)
    return delivery.cumulative_acks(bundles).select("consumer_id", "topic", _big("part").alias("part"), "position")


@query
def individual_acks(spark, sf_dir):
    acks = delivery.individual_acks(V.messages(spark, sf_dir), CONSUMER)
    return acks.select("consumer_id", "topic", _big("part").alias("part"), "off")


def _acked(log: DataFrame) -> DataFrame:
    return delivery.individual_acks(log.where(ACKED), CONSUMER)


@query
def backlog(spark, sf_dir):
    log = V.messages(spark, sf_dir)
    cursors = hold(topics.snapshot(log.where(PROCESSED)), "cursors")
    forms = {
        "cursor": delivery.backlog(log, cursors=cursors),
        "singly": delivery.backlog(log, acks=_acked(log)),
        "both": delivery.backlog(log, _acked(log), cursors),
    }
    return _union([left.select("topic", "off", F.lit(form).alias("form")) for form, left in forms.items()])


@query
def compact_acks(spark, sf_dir):
    log = V.messages(spark, sf_dir)
    cursors, gaps = delivery.compact_acks(log, _acked(log), CONSUMER)
    left = gaps.groupBy("topic", "part").agg(_n())
    return cursors.join(left, ["topic", "part"], "left").select(
        "topic", _big("part").alias("part"), "position", F.coalesce("n", F.lit(0)).alias("n")
    )


@query
def ack_intervals(spark, sf_dir):
    """Single acknowledgements as the fewest intervals, merged in two turns."""
    log = V.messages(spark, sf_dir)
    acks = intervals.of_acks(_acked(log))
    early = hold(intervals.merge(log, acks.where("first_off % 2 = 0")), "early-intervals")
    merged = intervals.merge(log, early.unionByName(acks.where("first_off % 2 = 1")))
    return merged.select("consumer_id", "topic", _big("part").alias("part"), "first_off", "last_off")


@query
def backlog_intervals(spark, sf_dir):
    """What intervals leave open, as single acknowledgements do."""
    log = V.messages(spark, sf_dir)
    ledger = hold(intervals.merge(log, intervals.of_acks(_acked(log))), "ack-intervals")
    return intervals.uncovered(log, ledger).select("topic", _big("part").alias("part"), "off", _md5("data"))


@query
def due_for_redelivery(spark, sf_dir):
    log = V.messages(spark, sf_dir)
    delivered = log.withColumnRenamed("publish_time", "delivered_at")
    now = log.agg(F.max("publish_time")).scalar()
    due = delivery.due_for_redelivery(delivered, _acked(log), now, 86400)
    return due.select("topic", _big("part").alias("part"), "off")


@query
def dedupe(spark, sf_dir):
    log = V.messages(spark, sf_dir)
    twice = log.unionByName(log.where(OPEN))
    return delivery.dedupe(twice).select("topic", _big("part").alias("part"), "off", _md5("data"))


@query
def dispatch(spark, sf_dir):
    log = V.messages(spark, sf_dir)
    return _union(
        [
            delivery.dispatch(log, 4, mode).select("off", "consumer", F.lit(mode).alias("mode"))
            for mode in C.SUBSCRIPTION_TYPES
        ]
    )


# ---------------------------------------------------------------- chunks


@query
def chunk_split(spark, sf_dir):
    return V.document_chunks(spark, sf_dir).select(
        "doc_id", _big("chunk_no").alias("chunk_no"), "chunk_count", _md5("data")
    )


@query
def chunk_roundtrip(spark, sf_dir):
    whole = chunking.assemble(V.document_chunks(spark, sf_dir))
    return whole.select(F.col("chunk_set").alias("doc_id"), "chunk_count", _md5("data"))


@query
def expired_chunks(spark, sf_dir):
    chunks = V.broken_chunks(spark, sf_dir)
    now = V.table(spark, sf_dir, "documents").agg(F.max(F.timestamp_seconds(F.col("doc_id") * 60))).scalar()
    return chunking.expire(chunks, now, 3600).select(F.col("chunk_set").alias("doc_id"), "received", "status")


@query
def pending_chunk_cap(spark, sf_dir):
    state = chunking.sets(V.broken_chunks(spark, sf_dir))
    return _union(
        [
            chunking.cap_pending(state, 10, auto_ack).select(F.col("chunk_set").alias("doc_id"), "action")
            for auto_ack in (True, False)
        ]
    )


# ---------------------------------------------------------------- streams


def _staged(spark, sf_dir) -> str:
    """The message view written as a topic table, for streams to read."""
    path = fresh_path(spark, "topics")
    tables.write_messages(V.messages(spark, sf_dir), path)
    return path


#: bytes of payload in a file of a stream's source
SOURCE_BYTES = 128 << 20


def _source(df: DataFrame, payloads: int, keys: list[str], label: str) -> tuple[str, int]:
    """df stored for a stream to read, and the files that make half of it.

    There are four files, or a multiple of four that holds ``payloads`` bytes. Rows are dealt out by
    ``keys``, which should tell them apart: then no file is larger than the others.
    """
    number = 4 * max(1, -(-payloads // (4 * SOURCE_BYTES)))
    path = fresh_path(df.sparkSession, label)
    df.repartition(number, *keys).write.parquet(path)
    return path, number // 2


def _bytes(df: DataFrame, payload: str) -> int:
    return df.agg(F.sum(F.octet_length(payload)).alias("n")).first()["n"] or 0


def _drained(spark, stream: DataFrame, pipeline, label: str) -> DataFrame:
    sink = fresh_path(spark, label)
    runner.run(stream, pipeline, sink, fresh_path(spark, f"{label}-checkpoint"))
    return spark.read.parquet(sink)


@query
def stream_topics(spark, sf_dir):
    wanted = f"{V.NAMESPACE}click, {V.NAMESPACE}view"
    stream = reader.stream_topics(spark, _staged(spark, sf_dir), wanted, start="earliest", max_files=4)
    return _drained(spark, stream, lambda poll: poll.select("topic", "off"), "stream-topics").select("topic", "off")


@query
def commit_replay(spark, sf_dir):
    path, sink, acks = _staged(spark, sf_dir), fresh_path(spark, "replay"), fresh_path(spark, "replay-acks")
    identity = fresh_path(spark, topics.consumer_identity("audit", pattern=".*", consumer_name="replay"))
    sub = _subscription(subscription_type=C.EXCLUSIVE)
    for _ in range(2):
        stream = reader.stream_topics(spark, path, pattern=".*", start="earliest", max_files=8)
        runner.run(
            stream, lambda poll: consume.consume_bytes(poll, sub, drop_empty=False), sink, identity, acks, sub.acknowledge
        )
    bundles = spark.read.parquet(sink).groupBy("topic", "part").agg(F.sum("message_count").alias("n"))
    cursors = runner.acknowledged(spark.read.parquet(acks)).select("topic", "part", "position")
    return bundles.join(cursors, ["topic", "part"]).withColumn("part", _big("part"))


@query
def stream_latest(spark, sf_dir):
    """By default a subscription begins behind what was there when it was made."""
    log, path = V.messages(spark, sf_dir), fresh_path(spark, "topics")
    consumer = fresh_path(spark, "consumer")
    tables.write_messages(log.where(SUBSCRIBED), path)
    reader.stream_topics(spark, path, pattern=".*", consumer_id=consumer)
    tables.write_messages(log.where(f"not {SUBSCRIBED}"), path)
    stream = reader.stream_topics(spark, path, pattern=".*", consumer_id=consumer)
    return _drained(spark, stream, lambda poll: poll.select("topic", "off"), "stream-latest").select("topic", "off")


@query
def stream_dedupe(spark, sf_dir):
    path, sink = _staged(spark, sf_dir), fresh_path(spark, "stream-dedupe")
    tables.write_messages(V.messages(spark, sf_dir).where(OPEN), path)
    stream = reader.stream_topics(spark, path, pattern=".*", start="earliest", max_files=V.SOME_FILES)
    stateful.dedupe(stream, sink, fresh_path(spark, "ledger"), fresh_path(spark, "dedupe-checkpoint"))
    return spark.read.parquet(sink).select("topic", _big("part").alias("part"), "off", _md5("data"))


@query
def stream_receipts(spark, sf_dir):
    """Each poll's receipt is observed while its bundles are written; the receipts add up to the log."""
    receipts, sub = fresh_path(spark, "receipts"), _subscription(subscription_type=C.EXCLUSIVE)
    stream = reader.stream_topics(spark, _staged(spark, sf_dir), pattern=".*", start="earliest", max_files=8)
    runner.run(
        stream,
        lambda poll: consume.consume_bytes(poll, sub, drop_empty=False),
        fresh_path(spark, "received"),
        fresh_path(spark, "receipts-checkpoint"),
        receipts=receipts,
    )
    return spark.read.parquet(receipts).agg(F.sum("messages").alias("messages"), F.min("first_off").alias("first_off"), F.max("last_off").alias("last_off"))


@query
def stream_redelivery(spark, sf_dir):
    log = V.messages(spark, sf_dir)
    sent, acked = fresh_path(spark, "sent"), fresh_path(spark, "acked")
    tables.write_messages(log, sent)
    tables.write_messages(log.where(ACKED), acked)

    def noted(path: str, label: str) -> str:
        keys = lambda poll: poll.select(*delivery.MESSAGE, F.col("publish_time").alias("delivered_at"))
        stream = reader.stream_topics(spark, path, pattern=".*", start="earliest", max_files=8)
        ledger = fresh_path(spark, label)
        runner.run(stream, keys, ledger, fresh_path(spark, f"{label}-checkpoint"))
        return ledger

    deliveries = stateful.delivered(noted(sent, "sent-ledger"), spark)
    acks = spark.read.parquet(noted(acked, "acked-ledger"))
    now = log.agg(F.max("publish_time")).scalar()
    due = delivery.due_for_redelivery(deliveries, acks, now, 86400)
    return due.select("topic", _big("part").alias("part"), "off")


@query
def stream_chunks(spark, sf_dir):
    sink = fresh_path(spark, "stream-chunks")
    # a set's chunks come in different polls
    path, half = _source(V.broken_chunks(spark, sf_dir), _bytes(V.documents(spark, sf_dir), "content"), ["chunk_set", "chunk_no"], "chunks")
    chunks = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", half).parquet(path)
    stateful.assemble(chunks, sink, fresh_path(spark, "open-chunks"), fresh_path(spark, "chunks-checkpoint"))
    return spark.read.parquet(sink).select(_big("chunk_set").alias("doc_id"), "chunk_count", _md5("data"))


@query
def stream_dead_letters(spark, sf_dir):
    """A streamed record consumer keeps what it cannot parse in the dead-letter table."""
    dead, sub = fresh_path(spark, "dead"), _subscription()
    stream = reader.stream_topics(spark, _staged(spark, sf_dir), pattern=".*", start="earliest")
    runner.run(
        stream,
        lambda poll: consume.consume_records(poll, sub, V.RECORD),
        fresh_path(spark, "good"),
        fresh_path(spark, "dead-checkpoint"),
        dead_letters=dead,
    )
    return spark.read.parquet(dead).select("relationship", "topic", _big("part").alias("part"), "batch_no", "bundle_no", _md5("content"))


def _publish_stream(spark, bundles: DataFrame, table: str, ends: str, checkpoint: str, failures: str) -> None:
    source, half = _source(bundles, _bytes(bundles, "content"), ["bundle_id"], "bundles")
    runner.publish(
        reader.stream_bundles(spark, source, max_files=half),
        lambda poll, reached: publishers.publish_bytes(
            poll, publishers.Target("${topic}", partitions=4), demarcator="\n", ends=reached
        ),
        table,
        ends,
        checkpoint,
        failures,
    )


@query
def stream_publish(spark, sf_dir):
    table, ends, checkpoint, failures = (fresh_path(spark, x) for x in ("streamed-topics", "ends", "checkpoint", "failed"))
    _publish_stream(spark, V.documents(spark, sf_dir), table, ends, checkpoint, failures)
    return (
        topics.read_topics(spark, table, pattern=".*")
        .groupBy("topic")
        .agg(_n(), F.min("off").alias("lo"), F.max("off").alias("hi"), F.sum("off").alias("off_sum"), _checksum("data"))
    )


@query
def stream_publish_failures(spark, sf_dir):
    """Bundles without a topic come back from the failure table of a streamed publisher."""
    table, ends, checkpoint, failures = (fresh_path(spark, x) for x in ("streamed-topics", "ends", "checkpoint", "failed"))
    _publish_stream(spark, V.documents(spark, sf_dir), table, ends, checkpoint, failures)
    return spark.read.parquet(failures).select("bundle_id", "relationship", _md5("content"))


@query
def stream_two_publishers(spark, sf_dir):
    """Two publishers into one topic table, one after the other: every message, and every offset once."""
    table, ends, failures = (fresh_path(spark, x) for x in ("shared-topics", "shared-ends", "failed"))
    for rest in (0, 1):
        some = V.documents(spark, sf_dir).where(F.col("bundle_id") % 2 == rest)
        _publish_stream(spark, some, table, ends, fresh_path(spark, "publisher"), failures)
    found = topics.read_topics(spark, table, pattern=".*").groupBy("topic")
    return found.agg(_n(), F.countDistinct("off").alias("offsets"), F.min("off").alias("lo"), F.max("off").alias("hi"), _checksum("data"))
