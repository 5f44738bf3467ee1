"""Shape of physical plans: what is read, what is moved, and where rows are ordered."""

import re

import __spark_entry__ as entry
import pytest

from topicframe.catalogue.queries import REGISTRY
from topicframe.operators import publish
from topicframe.operators.receive import assign_receive_batches
from topicframe.plans.consume import Subscription, consume_bytes, consume_records
from topicframe.plans.publish import Target, publish_bytes, publish_records
from topicframe.sinks.tables import write_messages
from topicframe.sources.topics import read_topics
from topicframe.workspace import fresh_path


@pytest.fixture
def settled(spark):
    """Plans as they are before run-time statistics, with no side small enough to broadcast."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for key, value in kept.items():
        spark.conf.set(key, value)


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def exchanges(text: str) -> list[str]:
    return re.findall(r"(?<!Reused)Exchange (\w+\([^)]*\))", text)


@pytest.fixture
def table(spark, log):
    path = fresh_path(spark, "plan-topics")
    write_messages(log([{"topic": t, "data": t} for t in "abcabc"]), path)
    return path


@pytest.mark.parametrize("choice", [{"topics": "a, b"}, {"pattern": "a|b"}])
def test_subscription_prunes_partitions(spark, table, choice):
    df = read_topics(spark, table, **choice)
    text = plan(df.select("off"))
    assert re.search(r"PartitionFilters: \[[^\]]*topic", text)
    assert "ReadSchema: struct<off:bigint>" in text
    files = {row.f.split("/topic=")[1][0] for row in df.selectExpr("input_file_name() as f").collect()}
    assert files == {"a", "b"}


@pytest.mark.parametrize("consume", ["bytes", "records"])
def test_a_consumer_moves_its_messages_once(settled, table, consume):
    messages = read_topics(settled, table, pattern=".*")
    sub = Subscription("c", mapping="p", segment=65536)
    df = consume_bytes(messages, sub) if consume == "bytes" else consume_records(messages, sub, "x string")
    assert exchanges(plan(df)) == ["hashpartitioning(topic, part, _segment, 8)"]


def test_full_batches_order_rows_by_span_only(settled, table):
    text = plan(assign_receive_batches(read_topics(settled, table, pattern=".*"), 10))
    # windows over message rows read the message's own offset
    rows = [w for w in re.findall(r"windowspecdefinition\(([^)]*)", text) if "off ASC" in w]
    assert rows and all("_span" in w.split("off ASC")[0] for w in rows)
    assert "ReusedExchange" in text
    assert text.count("FileScan") == 2 and "ReadSchema: struct<off:bigint>" in text


def test_a_full_batch_consumer_reads_its_messages_twice(settled, table):
    """Once narrow, to count, and once whole; every level of the count is reused, not read again."""
    text = plan(consume_bytes(read_topics(settled, table, pattern=".*"), Subscription("c", mapping="p")))
    assert text.count("FileScan") == 2 and text.count("ReadSchema: struct<off:bigint>") == 1


def test_every_level_of_the_count_has_a_window_of_its_own(settled, table):
    text = plan(assign_receive_batches(read_topics(settled, table, pattern=".*"), 10))
    windows = re.findall(r"windowspecdefinition\(([^)]*) ASC", text)
    assert {w.split(", ")[-1] for w in windows} == {"off", "_span", "_group1", "_group2"}
    for group, inner in (("_group1", "_span"), ("_group2", "_group1")):
        assert any(w.startswith(group) and w.endswith(inner) for w in windows)


def test_publishing_records_parses_once(settled, bundles):
    published = publish_records(bundles(({"t": "a"}, "1,x\n2,y")), Target("${t}"), "n int, s string")
    for df in (published.messages, published.bundles):
        assert "from_csv" not in plan(df)


def test_publish_batches_need_no_further_move(settled, table):
    messages = assign_receive_batches(read_topics(settled, table, pattern=".*"), 10, segment=100)
    within = ("topic", "part", "segment_no", "batch_no")
    assert exchanges(plan(publish.assign_batches(messages, within=within))) == ["hashpartitioning(topic, part, _segment, 8)"]


def test_splitting_moves_nothing(settled, bundles):
    assert exchanges(plan(publish.split(bundles(({}, "a\nb")), "\n"))) == []


def test_publish_counts_need_no_join(settled, bundles):
    published = publish_bytes(bundles(({}, "a\nb")), Target("t"), demarcator="\n")
    assert "Join" not in plan(published.bundles) and exchanges(plan(published.bundles)) == []


SCANNED = {
    "topic_list": "struct<off:bigint,data:binary>",
    "key_attribute": "struct<event_id:bigint,user_id:bigint>",
    "parse_json_records": "struct<event_id:bigint,props:string>",
    "dynamic_topic": "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>",
    "whole_messages": "struct<doc_id:bigint,text:string>",
}


@pytest.mark.parametrize("name, schema", SCANNED.items())
def test_only_needed_columns_are_read(spark, name, schema):
    read = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan(entry.queries()[name](spark, entry.SMOKE_DIR)))
    assert read and all(r == schema for r in read)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_no_cross_join_and_no_python(settled, name):
    text = plan(entry.queries()[name](settled, entry.SMOKE_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert unwanted not in text
