import datetime as dt

import pytest
from pyspark.sql import functions as F

from topicframe import constants as C
from topicframe.operators import chunking, delivery
from topicframe.sinks.tables import dead_letter
from topicframe.sources import topics
from topicframe.workspace import fresh_path, safe_name

CURSORS = "consumer_id string, topic string, part int, position bigint"


def _offs(df):
    return sorted((r.topic, r.off) for r in df.collect())


def test_topic_names():
    assert topics.topic_names("a, b,c  d") == ["a", "b", "c", "d"]


@pytest.mark.parametrize("topic_list, pattern", [(None, None), ("a", "b")])
def test_one_way_to_subscribe(topic_list, pattern):
    with pytest.raises(ValueError):
        topics.subscribed(topic_list, pattern)


def test_identity():
    assert topics.consumer_identity("sub", topics="a, b") == "a, b-sub"
    assert topics.consumer_identity("sub", pattern="p.*", consumer_name="me") == "p.*-sub-me"
    assert safe_name("a/b") != safe_name("a:b")


def test_start_and_resume(spark, log):
    messages = log([{"topic": t} for t in "aabab"])
    ends = spark.createDataFrame([("c", "a", 0, 1)], CURSORS)
    assert topics.start_position(messages, None, "earliest").count() == 5
    assert _offs(topics.start_position(messages, ends)) == [("a", 3), ("b", 2), ("b", 4)]
    with pytest.raises(ValueError):
        topics.start_position(messages, None)
    with pytest.raises(ValueError):
        topics.start_position(messages, ends, "middle")
    other = spark.createDataFrame([("c", "a", 0, 1), ("d", "b", 0, 4)], CURSORS)
    assert _offs(topics.resume(messages, other, "d")) == [("a", 0), ("a", 1), ("a", 3)]


def test_snapshot_is_taken_once(spark, log):
    path = fresh_path(spark, "snapshot")
    first = topics.snapshot_once(log([{}, {}]), path)
    again = topics.snapshot_once(log([{}, {}, {}]), path)
    assert [r.position for r in first.collect()] == [r.position for r in again.collect()] == [1]


def test_cursors_only_move_forward(spark):
    old = spark.createDataFrame([("c", "a", 0, 5), ("c", "b", 0, 1)], CURSORS)
    new = spark.createDataFrame([("c", "a", 0, 3), ("c", "b", 0, 9), ("c", "z", 1, 0)], CURSORS)
    got = {(r.topic, r.position) for r in delivery.merge_cursors(old, new).collect()}
    assert got == {("a", 5), ("b", 9), ("z", 0)}


def test_backlog_and_compaction(log):
    messages = log([{} for _ in range(10)])
    acks = delivery.individual_acks(messages.where("off in (0, 1, 2, 5, 6)"), "c")
    twice = acks.unionByName(acks)
    assert [o for _, o in _offs(delivery.backlog(messages, twice))] == [3, 4, 7, 8, 9]
    cursors, gaps = delivery.compact_acks(messages, twice.distinct(), "c")
    assert [r.position for r in cursors.collect()] == [2]
    assert [o for _, o in _offs(gaps)] == [5, 6]
    assert _offs(delivery.backlog(messages, gaps, cursors)) == _offs(delivery.backlog(messages, acks))
    done, none = delivery.compact_acks(messages, delivery.individual_acks(messages, "c"), "c")
    assert [r.position for r in done.collect()] == [9] and none.count() == 0


def test_redelivery(log):
    start = dt.datetime(2024, 1, 1)
    messages = log([{"publish_time": start + dt.timedelta(seconds=10 * i)} for i in range(6)])
    delivered = messages.withColumnRenamed("publish_time", "delivered_at")
    acks = delivery.individual_acks(messages.where("off = 1"), "c")
    now = F.lit(start + dt.timedelta(seconds=50))
    assert [o for _, o in _offs(delivery.due_for_redelivery(delivered, acks, now))] == [0, 2]
    assert [o for _, o in _offs(delivery.due_for_redelivery(delivered, acks, now, 10))] == [0, 2, 3, 4]
    with pytest.raises(ValueError):
        delivery.due_for_redelivery(delivered, acks, now, 9)


def test_dedupe(log):
    messages = log([{"data": "a"}, {"data": "b"}])
    assert _offs(delivery.dedupe(messages.unionByName(messages))) == [("t", 0), ("t", 1)]


def test_dispatch(log):
    messages = log([{"key": k} for k in ("x", "y", "x", None, "y", None)])

    def consumers(mode):
        return [r.consumer for r in delivery.dispatch(messages, 3, mode).orderBy("off").collect()]

    assert set(consumers(C.EXCLUSIVE)) == set(consumers(C.FAILOVER)) == {0}
    assert consumers(C.SHARED) == [0, 1, 2, 0, 1, 2]
    keyed = consumers(C.KEY_SHARED)
    assert keyed[0] == keyed[2] and keyed[1] == keyed[4] and (keyed[3], keyed[5]) == (0, 2)
    with pytest.raises(ValueError):
        delivery.dispatch(messages, 3, "Other")


@pytest.mark.parametrize("size, limit, sizes", [(0, 4, [0]), (4, 4, [4]), (5, 4, [4, 1]), (256, 100, [100, 100, 56])])
def test_chunks_there_and_back(log, size, limit, sizes):
    raw = bytes(range(size))
    messages = log([{"data": raw, "message_id": "m", "key": "k"}])
    chunks = chunking.split(messages, limit)
    got = chunks.orderBy("chunk_no").collect()
    assert [len(c.data) for c in got] == sizes
    assert {c.chunk_count for c in got} == {len(sizes)} and {c.key for c in got} == {"k"}
    (back,) = chunking.assemble(chunks.unionByName(chunks), carry=["key"]).collect()
    assert (bytes(back.data), back.key) == (raw, "k")


def test_chunking_excludes_batching(log):
    with pytest.raises(ValueError):
        chunking.split(log([{}]), 4, batching=True)


def _sets(log, missing):
    start = dt.datetime(2024, 1, 1)
    rows = [
        {"data": "abcdef", "message_id": f"m{i:02}", "publish_time": start + dt.timedelta(seconds=i)} for i in range(20)
    ]
    chunks = chunking.split(log(rows), 2)
    return start, chunks.where(~(F.col("chunk_set").isin(missing) & (F.col("chunk_no") == 1)))


def test_incomplete_sets(log):
    start, chunks = _sets(log, ["m00", "m15"])
    assert chunking.assemble(chunks).count() == 18
    status = chunking.expire(chunks, F.lit(start + dt.timedelta(seconds=60)), 60).collect()
    by_set = {r.chunk_set: (r.received, r.status) for r in status}
    assert by_set["m00"] == (2, chunking.EXPIRED)
    assert by_set["m15"] == (2, chunking.PENDING)
    assert by_set["m01"] == (3, chunking.COMPLETE)


@pytest.mark.parametrize("auto_ack, action", [(True, chunking.ACK), (False, chunking.REDELIVER)])
@pytest.mark.parametrize("by", [(), ("topic",)])
def test_pending_cap(log, auto_ack, action, by):
    missing = [f"m{i:02}" for i in range(12)]
    _, chunks = _sets(log, missing)
    got = chunking.cap_pending(chunking.sets(chunks, by), 10, auto_ack, by).collect()
    assert sorted((r.chunk_set, r.action) for r in got) == [("m00", action), ("m01", action)]
    assert chunking.cap_pending(chunking.sets(chunks, by), 12, auto_ack, by).count() == 0


def test_dead_letters_come_back(spark, log):
    path = fresh_path(spark, "test-dead")
    bad = log([{"data": "x"}, {"data": "y", "topic": "a/b"}]).withColumn("relationship", F.lit(C.FAILURE))
    dead_letter(bad, path)
    assert _offs(spark.read.parquet(path).where(F.col("relationship") == C.FAILURE)) == [("a/b", 1), ("t", 0)]
