import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from topicframe import constants as C
from topicframe.functions.payload import tokens
from topicframe.operators import audit, publish
from topicframe.plans.publish import Target, publish_bytes, publish_records
from topicframe.sinks.tables import write_messages
from topicframe.sources.topics import read_topics
from topicframe.workspace import fresh_path

PERSON = "name string, age int"
PEOPLE = "Mary Jane, 32\nJohn Doe, 35\nBusta Move, 26"


def _messages(published):
    return published.messages.orderBy("topic", "off").collect()


def test_whole_content(bundles):
    df = bundles(({"k": "test-key", "a": "1", "b": "2"}, "test content"))
    (only,) = _messages(publish_bytes(df, Target("t", "a,b"), key="${k}"))
    assert (only.topic, only.key, bytes(only.data)) == ("t", "test-key", b"test content")
    assert only.properties == {"a": "1", "b": "2"}


def test_null_and_blank_keys(bundles):
    df = bundles(({"prop": "val"}, "x"), ({}, "y"), ({"prop": "  "}, "z"), ({C.KEY_ATTRIBUTE: "fall"}, "w"))
    assert [m.key for m in _messages(publish_bytes(df, Target("t"), key="${prop}"))] == ["val", None, None, "fall"]
    assert [m.key for m in _messages(publish_bytes(df, Target("t")))] == [None, None, None, "fall"]


@pytest.mark.parametrize(
    "content, demarcator, expected",
    [
        ("message1\nmessage2\nmessage3", "\n", ["message1", "message2", "message3"]),
        ("some content\n" * 20, "\n", ["some content"] * 20),
        ("a\n\nb", "\n", ["a", "", "b"]),
        ("a***b***", "***", ["a", "b"]),
        ("a\\Eb", "\\E", ["a", "b"]),
        ("", "\n", []),
        ("\n", "\n", [""]),
        ("aéb", "é", ["a", "b"]),
        ("a.b", ".", ["a", "b"]),
    ],
)
def test_split(bundles, content, demarcator, expected):
    df = bundles(({"x": "1"}, content))
    got = publish.split(df, demarcator).orderBy("pos").collect()
    assert [bytes(r.data).decode() for r in got] == expected
    assert [r.pos for r in got] == list(range(len(expected)))
    assert all(r.attributes == {"x": "1"} for r in got)


def test_split_keeps_bytes(bundles):
    raw = bytes(b for b in range(256) if b != 10)
    got = publish.split(bundles(({}, raw + b"\n" + raw)), "\n").collect()
    assert [bytes(r.data) for r in got] == [raw, raw]


def test_demarcator_from_attributes(bundles):
    df = bundles(({"d": "|"}, "a|b"), ({"d": "--"}, "a--b--c"), ({}, "a|b"))
    got = publish.split(df, "${d}").orderBy("bundle_id", "pos").collect()
    assert [(r.bundle_id, bytes(r.data)) for r in got] == [
        (0, b"a"), (0, b"b"), (1, b"a"), (1, b"b"), (1, b"c"), (2, b"a|b"),
    ]


def test_long_tokens(bundles):
    rng = random.Random(5)
    content = "".join("".join(rng.choices("abcdefghij", k=1000)) + "\n" for _ in range(584))
    df = bundles(({}, content))
    assert publish.split(df, "\n").count() == 584
    assert df.select(F.size(tokens(F.col("content"), "\n")).alias("n")).first().n == 584


def test_topics_of_bundles(bundles):
    df = bundles(({"topic": "topic-a"}, "1"), ({"topic": "topic-b"}, "2"), ({}, "3"), ({"topic": " "}, "4"))
    published = publish_bytes(df, Target("${topic}"))
    assert [(m.topic, bytes(m.data)) for m in _messages(published)] == [("topic-a", b"1"), ("topic-b", b"2")]
    routes = published.bundles.orderBy("bundle_id").collect()
    assert [r.relationship for r in routes] == [C.SUCCESS, C.SUCCESS, C.FAILURE, C.FAILURE]
    assert bytes(routes[2].content) == b"3" and routes[2].attributes == {}
    assert routes[0].attributes[C.PUBLISHED_TOPIC_ATTRIBUTE] == "topic-a"


def test_missing_content_fails(bundles):
    published = publish_bytes(bundles(({}, None)), Target("t"), demarcator="\n")
    assert published.messages.count() == 0 and published.bundles.first().relationship == C.FAILURE


def test_offsets_run_on_in_a_topic(bundles):
    df = bundles(({"t": "a"}, "1\n2"), ({"t": "b"}, "3"), ({"t": "a"}, ""), ({"t": "a"}, "4\n5\n6"))
    got = _messages(publish_bytes(df, Target("${t}"), demarcator="\n"))
    assert [(m.topic, m.off, bytes(m.data)) for m in got] == [
        ("a", 0, b"1"), ("a", 1, b"2"), ("a", 2, b"4"), ("a", 3, b"5"), ("a", 4, b"6"), ("b", 0, b"3"),
    ]


def test_records(bundles):
    published = publish_records(bundles(({}, PEOPLE)), Target("t"), PERSON, key_field="name")
    got = _messages(published)
    assert [bytes(m.data) for m in got] == [b'"Mary Jane","32"\n', b'"John Doe","35"\n', b'"Busta Move","26"\n']
    assert [m.key for m in got] == ["Mary Jane", "John Doe", "Busta Move"]
    done = published.bundles.first()
    assert done.attributes == {C.PUBLISHED_COUNT_ATTRIBUTE: "3", C.PUBLISHED_TOPIC_ATTRIBUTE: "t"}
    assert bytes(done.content).decode() == PEOPLE
    (event,) = audit.sends(published.bundles, "broker://x").collect()
    assert event.details == "Sent 3 records"


@pytest.mark.parametrize("field", [None, "nowhere"])
def test_records_without_key_field(bundles, field):
    df = bundles(({C.KEY_ATTRIBUTE: "ignored"}, PEOPLE))
    assert {m.key for m in _messages(publish_records(df, Target("t"), PERSON, key_field=field))} == {None}


@pytest.mark.parametrize("partial, sent", [("none", 0), ("prefix", 1)])
def test_malformed_records(bundles, partial, sent):
    df = bundles(({}, "Mary Jane, 32\ninvalid content\nJohn Doe, 35"))
    published = publish_records(df, Target("t"), PERSON, partial=partial)
    assert published.messages.count() == sent
    assert published.bundles.first().relationship == C.FAILURE
    assert C.PUBLISHED_COUNT_ATTRIBUTE not in published.bundles.first().attributes


def test_blank_topic_sends_no_records(bundles):
    published = publish_records(bundles(({}, PEOPLE)), Target("${topic}"), PERSON, partial="prefix")
    assert published.messages.count() == 0 and published.bundles.first().relationship == C.FAILURE


@pytest.mark.parametrize("lines", [1000, 98634])
def test_many_records(bundles, lines):
    published = publish_records(bundles(({}, "Mary Jane, 32\n" * lines)), Target("t"), PERSON)
    assert published.messages.count() == lines
    assert published.bundles.first().attributes[C.PUBLISHED_COUNT_ATTRIBUTE] == str(lines)


PERSON_JSON = "name string, age int, address struct<city:string>, phones array<string>"


@pytest.mark.parametrize("copies", [1, 2])
def test_json_records(bundles, copies):
    one = '{"name":"M","age":1,"address":{"city":"X"},"phones":["1","2"]}'
    content = one if copies == 1 else f"[{one},{one}]"
    published = publish_records(bundles(({}, content)), Target("t"), PERSON_JSON, "json", "json", key_field="address")
    got = _messages(published)
    assert [bytes(m.data).decode() for m in got] == [one] * copies
    assert {m.key for m in got} == {'{"city":"X"}'}


def test_key_field_types(spark):
    df = spark.sql(
        """select 7L as n, cast('by' as binary) as b, array(104Y, -61Y, -87Y) as a, true as t, cast(null as string) as z"""
    )
    got = {f: publish.with_key_field(df, f).first().key for f in "nbatz"}
    assert got == {"n": "7", "b": "by", "a": "hé", "t": "true", "z": None}


def test_routing(log):
    messages = log([{"key": k} for k in (None, None, "x", "x", None)]).drop("part")
    robin = [r.part for r in publish.route_partitions(messages, 2).orderBy("off").collect()]
    assert robin[:2] == [0, 1] and robin[2] == robin[3] and robin[4] == 0
    single = [r.part for r in publish.route_partitions(messages, 2, "SinglePartition", partition=1).orderBy("off").collect()]
    assert single[0] == single[1] == single[4] == 1
    custom = publish.route_partitions(messages, 2, "CustomPartition", partition=F.col("off") % 3)
    assert [r.part for r in custom.orderBy("off").collect()] == [0, 1, 2, 0, 1]
    with pytest.raises(ValueError):
        publish.route_partitions(messages, 2, "Other")


def _greedy(rows, max_messages, max_bytes, micros):
    batch, count, size, since, out = 0, 0, 0, None, {}
    for off, length, at in rows:
        if count == 0 or count + 1 > max_messages or size + length > max_bytes or at - since >= micros:
            batch, count, size, since = batch + 1, 0, 0, at
        count, size = count + 1, size + length
        out[off] = batch
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("flush", [None, 10])
def test_batches_against_a_walk(log, seed, flush):
    rng = random.Random(seed)
    at, rows = dt.datetime(2024, 1, 1), []
    for i in range(200):
        # publish times may step back
        at += dt.timedelta(milliseconds=rng.choice([0, 1, 5, -2]))
        rows.append({"off": i, "data": b"x" * rng.choice([0, 1, 10, 60]), "publish_time": at})
    messages = log(rows).withColumn("batch_no", F.lit(0))
    got = publish.assign_batches(messages, 8, 50, dt.timedelta(milliseconds=20), sends_per_flush=flush).collect()
    start = dt.datetime(2024, 1, 1)
    walk = [(r["off"], len(r["data"]), (r["publish_time"] - start) // dt.timedelta(microseconds=1)) for r in rows]
    expected = {}
    for begin in range(0, 200, flush or 200):
        expected.update(_greedy(walk[begin : begin + (flush or 200)], 8, 50, 20000))
    assert {r.off: r.publish_batch for r in got} == expected
    assert {r.off: bytes(r.data) for r in got} == {r["off"]: r["data"] for r in rows}


def test_batching_excludes_chunking(log):
    with pytest.raises(ValueError):
        publish.assign_batches(log([{}]).withColumn("batch_no", F.lit(0)), chunking=True)


@pytest.mark.parametrize("compression", ["NONE", "LZ4", "ZLIB"])
def test_written_topics_read_back(spark, bundles, compression):
    path = fresh_path(spark, "test-topics")
    df = bundles(({"t": "persistent://a/b/one"}, "1\n2"), ({"t": "persistent://a/b/two"}, "3"), ({"t": "other"}, "4"))
    write_messages(publish_bytes(df, Target("${t}", partitions=2), demarcator="\n").messages, path, compression)
    listed = read_topics(spark, path, topics="persistent://a/b/one, other")
    assert sorted(bytes(r.data) for r in listed.collect()) == [b"1", b"2", b"4"]
    matched = read_topics(spark, path, pattern="persistent://a/b/.*")
    assert sorted(bytes(r.data) for r in matched.collect()) == [b"1", b"2", b"3"]
    assert read_topics(spark, path, pattern="persistent://a").count() == 0
