import random

import pytest
from pyspark.sql import functions as F

from topicframe import constants as C
from topicframe.operators import bundling, delivery
from topicframe.operators.receive import assign_receive_batches
from topicframe.plans.consume import Subscription, consume_bytes
from topicframe.schema import BUNDLE_SCHEMA


def _bundles(messages, drop_empty=True, **settings):
    sub = Subscription("c", **settings)
    return consume_bytes(messages, sub, drop_empty).orderBy("topic", "part", "batch_no", "bundle_no").collect()


def test_same_message_many_times(log):
    (only,) = _bundles(log([{"data": "Mocked Message"}] * 40), max_messages=40)
    assert only.message_count == 40
    assert bytes(only.content) == b"\n".join([b"Mocked Message"] * 40)
    assert only.attributes == {C.MESSAGE_COUNT_ATTRIBUTE: "40"}
    assert (only.first_off, only.last_off, only.relationship) == (0, 39, C.SUCCESS)


def test_runs_by_mapped_attributes(log):
    messages = log(
        [
            {"data": "A"},
            {"data": "B"},
            {"data": "C", "properties": {"prop": "val"}},
            {"data": "D", "properties": {"prop": "val"}, "key": "K"},
        ]
    )
    got = _bundles(messages, mapping=f"prop,key={C.KEY_SOURCE}", demarcator="===")
    assert [bytes(b.content) for b in got] == [b"A===B", b"C", b"D"]
    carried = {"prop": "val", C.PROPERTY_PREFIX + "prop": "val"}
    assert [b.attributes for b in got] == [
        {C.MESSAGE_COUNT_ATTRIBUTE: "2"},
        {**carried, C.MESSAGE_COUNT_ATTRIBUTE: "1"},
        {**carried, "key": "K", C.MESSAGE_COUNT_ATTRIBUTE: "1"},
    ]


def test_a_bundle_carries_its_first_messages_id_and_properties(log):
    messages = log([{"data": d, "message_id": f"{i}:1", "properties": {"n": d}} for i, d in enumerate("abc")])
    (only,) = _bundles(messages)
    assert only.attributes == {C.MESSAGE_ID_ATTRIBUTE: "0:1", C.PROPERTY_PREFIX + "n": "a", C.MESSAGE_COUNT_ATTRIBUTE: "3"}


def test_raw_runs_do_not_break_on_schema(log):
    messages = log([{"data": d, "schema_type": "AVRO", "schema_def": s} for d, s in zip("abcd", "1122")])
    assert [bytes(b.content) for b in _bundles(messages)] == [b"a\nb\nc\nd"]


def test_bundles_do_not_depend_on_how_far_offsets_are_apart(log):
    for step in (1, 70_000, 2**40):
        (only,) = _bundles(log([{"data": "x", "off": i * step} for i in range(50)]))
        assert only.message_count == 50


def test_equal_attributes_apart_are_different_bundles(log):
    messages = log([{"data": d, "properties": {"p": p}} for d, p in [("a", "1"), ("b", "2"), ("c", "1")]])
    assert [bytes(b.content) for b in _bundles(messages, mapping="p")] == [b"a", b"b", b"c"]


def test_scope_all_separates_by_properties_and_ids(log):
    messages = log(
        [
            {"data": "Message 1", "properties": {"batch": "1", "sequence": "first"}},
            {"data": "Message 2", "properties": {"batch": "1", "sequence": "second"}},
        ]
    )
    assert len(_bundles(messages, scope="mapped")) == 1
    got = _bundles(messages, scope="all")
    assert [b.attributes[C.PROPERTY_PREFIX + "sequence"] for b in got] == ["first", "second"]
    with_ids = log([{"data": "x", "message_id": str(i)} for i in range(3)])
    assert len(_bundles(with_ids, scope="mapped")) == 1
    assert len(_bundles(with_ids, scope="all")) == 3
    without_ids = log([{"data": "x"}] * 3)
    assert len(_bundles(without_ids, scope="all")) == 1


@pytest.mark.parametrize("data", ["", None])
def test_empty_bundle_rule(log, data):
    messages = log([{"data": data}])
    assert _bundles(messages) == []
    (kept,) = _bundles(messages, drop_empty=False)
    assert (kept.message_count, bytes(kept.content)) == (0, b"")


@pytest.mark.parametrize(
    "payloads, content, count",
    [
        (["", "A", "", "B"], b"A++B", 2),
        (["", "", "A"], b"A", 1),
        (["A", "", ""], b"A++", 1),
        (["A", None, "B"], b"A++B", 2),
        (["++", "", "B"], b"++++B", 2),
    ],
)
def test_empty_messages_in_a_bundle(log, payloads, content, count):
    (only,) = _bundles(log([{"data": p} for p in payloads]), demarcator="+")
    assert (bytes(only.content), only.message_count) == (content, count)


def test_payload_bytes_survive(log):
    raw = bytes(range(256))
    (only,) = _bundles(log([{"data": raw}, {"data": raw[::-1]}]), demarcator="é")
    assert bytes(only.content) == raw + "é".encode() + raw[::-1]


def test_no_demarcator_concatenates(log):
    (only,) = _bundles(log([{"data": "a"}, {"data": ""}, {"data": "b"}]), demarcator="")
    assert bytes(only.content) == b"ab"


def test_a_batch_closes_its_bundles(log):
    got = _bundles(log([{"data": str(i)} for i in range(5)]), max_messages=2)
    assert [bytes(b.content) for b in got] == [b"0\n1", b"2\n3", b"4"]
    assert [b.batch_no for b in got] == [0, 1, 2]


def test_a_segment_closes_a_batch(log):
    got = _bundles(log([{"data": str(i), "off": i} for i in range(5)]), max_messages=3, segment=4)
    assert [bytes(b.content) for b in got] == [b"0\n1\n2", b"3", b"4"]


def test_logs_are_bundled_apart(log):
    messages = log([{"topic": t, "part": p, "data": f"{t}{p}"} for t in "ab" for p in (0, 1)])
    assert [bytes(b.content) for b in _bundles(messages)] == [b"a0", b"a1", b"b0", b"b1"]


def test_output_has_the_bundle_schema(log):
    got = consume_bytes(log([{"data": "x"}]), Subscription("c"))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in BUNDLE_SCHEMA]


def test_topics_in_a_mixed_batch_keep_their_order(log):
    messages = log([{"topic": t, "data": t} for t in "foo bar foo bar".split()])
    mixed = assign_receive_batches(messages, 10, by=("part",))
    got = bundling.by_topic(mixed, ("part", "batch_no")).orderBy("topic", "topic_pos").collect()
    assert [(r.topic, r.topic_pos, r.off) for r in got] == [("bar", 1, 1), ("bar", 2, 3), ("foo", 1, 0), ("foo", 2, 2)]


def test_unknown_scope():
    with pytest.raises(ValueError):
        bundling.run_key(None, "some")


def _fold(rows, size, mark):
    """What a one-by-one reader of each log makes of it."""
    out = []
    logs = {}
    for row in sorted(rows, key=lambda r: r["off"]):
        logs.setdefault((row["topic"], row["part"]), []).append(row)
    for log_rows in logs.values():
        for start in range(0, len(log_rows), size):
            last, content, count, end = None, b"", 0, None
            for row in log_rows[start : start + size]:
                key = (row["properties"] or {}).get("p")
                if last is not None and key != last[0]:
                    out.append((row["topic"], row["part"], content, count, end))
                    content, count = b"", 0
                if count > 0:
                    content += mark
                if row["data"]:
                    content += row["data"]
                    count += 1
                last, end = (key,), row["off"]
            out.append((row["topic"], row["part"], content, count, end))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_random_logs_against_a_fold(log, seed):
    rng = random.Random(seed)
    rows = [
        {
            "topic": rng.choice(["a", "a", "a", "b"]),
            "part": rng.randrange(2),
            "off": off,
            "properties": rng.choice([None, {"p": "1"}, {"p": "1"}, {"p": "2", "q": "3"}]),
            "data": rng.choice([b"", b"x", b"**", b"yy", b"\xff\x00"]),
        }
        for off in range(300)
    ]
    size = rng.choice([1, 3, 7, 50])
    for segment in (None, 10**6):
        sub = Subscription("c", mapping="p", demarcator="**", max_messages=size, segment=segment)
        got = consume_bytes(log(rows), sub, drop_empty=False).collect()
        bundles = sorted((b.topic, b.part, bytes(b.content), b.message_count, b.last_off) for b in got)
        assert bundles == _fold(rows, size, b"**")


def test_acknowledgements(log):
    messages = log([{"data": "x", "topic": t} for t in "aab"])
    bundles = consume_bytes(messages, Subscription("c"))
    got = {(r.topic, r.part): r.position for r in delivery.cumulative_acks(bundles).collect()}
    assert got == {("a", 0): 1, ("b", 0): 2}
    assert delivery.individual_acks(messages, "c").count() == 3
    assert [delivery.acknowledges_singly(t) for t in C.SUBSCRIPTION_TYPES] == [False, True, True, False]


def test_failures_are_joined_whole(log):
    messages = log([{"data": "message"}, {"data": "message"}, {"data": "fine"}])
    flagged = messages.withColumns({"batch_no": F.lit(0), "run": F.lit(1), "failed": F.col("off") < 2})
    (only,) = bundling.failures(flagged, "***").collect()
    assert bytes(only.content) == b"message***message" and only.relationship == C.PARSE_FAILURE
    assert (only.failed_count, only.first_off, only.last_off) == (2, 0, 1)
