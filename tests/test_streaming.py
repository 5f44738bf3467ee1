import datetime as dt

import pytest
from pyspark.sql import functions as F

from topicframe import constants as C
from topicframe.operators import audit, chunking, delivery
from topicframe.plans.consume import Subscription, consume_bytes, consume_records
from topicframe.plans.publish import Target, publish_bytes, publish_records
from topicframe.sinks.tables import write_messages
from topicframe.sources.topics import read_topics, snapshot
from topicframe.streaming import reader, runner, stateful
from topicframe.workspace import fresh_path, shared_dir


SUB = Subscription("c", subscription_type=C.FAILOVER)


def _pipeline(poll):
    return consume_bytes(poll, SUB, drop_empty=False)


def _run(spark, path, sink, acks, checkpoint, sub=SUB, **options):
    stream = reader.stream_topics(spark, path, pattern=".*", start="earliest", **options)
    runner.run(stream, _pipeline, sink, checkpoint, acks, sub.acknowledge)


def test_a_shared_subscription_acknowledges_each_message(spark, log):
    path, sink, acks, checkpoint = (fresh_path(spark, label) for label in ("log", "sink", "acks", "checkpoint"))
    messages = log([{"data": str(i), "off": 3 * i} for i in range(5)])
    write_messages(messages, path)
    _run(spark, path, sink, acks, checkpoint, Subscription("c"))
    assert sorted(r.off for r in spark.read.parquet(acks).collect()) == [0, 3, 6, 9, 12]
    assert delivery.backlog(messages, spark.read.parquet(acks)).count() == 0
    (receipt,) = audit.receipts(spark.read.parquet(sink), "broker://x").collect()
    assert (receipt.messages, receipt.first_off, receipt.last_off) == (5, 0, 12)
    assert receipt.transit_uri == "broker://x/t"
    with pytest.raises(ValueError):
        delivery.acknowledger("Other", "c")


def test_resume_adds_only_what_is_new(spark, log):
    path, sink, acks, checkpoint = (fresh_path(spark, label) for label in ("log", "sink", "acks", "checkpoint"))
    write_messages(log([{"data": str(i)} for i in range(5)]), path)
    _run(spark, path, sink, acks, checkpoint, max_files=1)
    _run(spark, path, sink, acks, checkpoint, max_files=1)
    assert spark.read.parquet(sink).agg({"message_count": "sum"}).first()[0] == 5
    # a topic and a partition that were not there before
    write_messages(log([{"data": "x", "topic": "new", "part": 3, "off": 7}]), path)
    _run(spark, path, sink, acks, checkpoint, max_files=1)
    assert spark.read.parquet(sink).agg({"message_count": "sum"}).first()[0] == 6
    cursors = {(r.topic, r.part): r.position for r in runner.acknowledged(spark.read.parquet(acks)).collect()}
    assert cursors == {("t", 0): 4, ("new", 3): 7}


def test_a_crash_between_output_and_commit_replays(spark, log):
    path, sink, acks, checkpoint = (fresh_path(spark, label) for label in ("log", "sink", "acks", "checkpoint"))
    write_messages(log([{"data": str(i)} for i in range(4)]), path)

    def failing(bundles, messages):
        raise RuntimeError("lost before the acknowledgement")

    stream = reader.stream_topics(spark, path, pattern=".*", start="earliest")
    with pytest.raises(Exception, match="lost before"):
        runner.run(stream, _pipeline, sink, checkpoint, acks, failing)
    assert spark.read.parquet(sink).count() == 1
    _run(spark, path, sink, acks, checkpoint)
    rows = spark.read.parquet(sink).collect()
    assert [bytes(r.content) for r in rows] == [b"0\n1\n2\n3"]
    assert runner.acknowledged(spark.read.parquet(acks)).first().position == 3


def test_latest_starts_behind_the_snapshot(spark, log):
    path = fresh_path(spark, "log")
    write_messages(log([{"data": "old"}, {"data": "old"}]), path)
    ends = snapshot(spark.read.parquet(path))
    ends = spark.createDataFrame(ends.collect(), ends.schema)
    write_messages(log([{"data": "new", "off": 9}]), path)
    stream = reader.stream_topics(spark, path, topics="t", start="latest", at_subscribe=ends)
    sink = fresh_path(spark, "sink")
    runner.run(stream, lambda poll: poll.select("off"), sink, fresh_path(spark, "checkpoint"))
    assert [r.off for r in spark.read.parquet(sink).collect()] == [9]


def test_one_bound_per_poll(spark):
    with pytest.raises(ValueError):
        reader.stream_topics(spark, "/nowhere", "t", max_files=1, max_bytes=1_000_000)
    with pytest.raises(ValueError):
        reader.stream_bundles(spark, "/nowhere", max_files=1, max_bytes=1_000_000)


def test_a_poll_can_be_bounded_by_bytes(spark, log):
    path, sink = fresh_path(spark, "log"), fresh_path(spark, "sink")
    for i in range(3):
        write_messages(log([{"off": i}]), path)
    stream = reader.stream_topics(spark, path, "t", start="earliest", max_bytes=1000)
    runner.run(stream, lambda poll: poll.select("off"), sink, fresh_path(spark, "checkpoint"))
    polls = spark.read.parquet(sink).groupBy("poll").count().collect()
    assert len(polls) == 3 and sum(r["count"] for r in polls) == 3


def test_checkpoint_follows_identity(spark, log):
    df = log([{}])
    assert runner.checkpoint_path(df, "a-sub") == runner.checkpoint_path(df, "a-sub")
    assert runner.checkpoint_path(df, "a-sub") != runner.checkpoint_path(df, "b-sub")
    assert runner.checkpoint_path(df, "a-sub").startswith(shared_dir(spark))


def test_latest_without_a_snapshot_needs_an_identity(spark, log):
    path = fresh_path(spark, "log")
    write_messages(log([{"data": "old"}]), path)
    with pytest.raises(ValueError):
        reader.stream_topics(spark, path, topics="t")
    consumer, sink, checkpoint = (fresh_path(spark, label) for label in ("consumer", "sink", "checkpoint"))
    for off in (1, 2):
        reader.stream_topics(spark, path, topics="t", consumer_id=consumer)
        write_messages(log([{"data": "new", "off": off}]), path)
        stream = reader.stream_topics(spark, path, topics="t", consumer_id=consumer)
        runner.run(stream, lambda poll: poll.select("off"), sink, checkpoint)
    assert sorted(r.off for r in spark.read.parquet(sink).collect()) == [1, 2]


def test_a_repeated_poll_takes_its_committed_output_as_it_is(spark, log):
    path, sink, checkpoint = (fresh_path(spark, label) for label in ("log", "sink", "checkpoint"))
    write_messages(log([{"data": "x"}]), path)
    stream = reader.stream_topics(spark, path, "t", start="earliest")

    def failing(written, batch):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        runner.run(stream, lambda poll: poll.select("off"), sink, checkpoint, fresh_path(spark, "acks"), failing)
    files = sorted(spark.read.parquet(sink).inputFiles())
    runner.run(stream, lambda poll: poll.select("off"), sink, checkpoint)
    assert sorted(spark.read.parquet(sink).inputFiles()) == files


def test_no_distinct_message_is_dropped_in_bounded_polls(spark, log):
    path, sink, ledger, checkpoint = (fresh_path(spark, label) for label in ("log", "sink", "ledger", "checkpoint"))
    start = dt.datetime(2024, 1, 1)
    for topic in "abc":
        rows = [{"topic": topic, "off": i, "publish_time": start + dt.timedelta(hours=i)} for i in range(10)]
        write_messages(log(rows).coalesce(1), path)
        write_messages(log(rows[:4]).coalesce(1), path)
    for _ in range(2):
        stateful.dedupe(reader.stream_topics(spark, path, "a,b,c", start="earliest", max_files=1), sink, ledger, checkpoint)
    got = sorted((r.topic, r.off) for r in spark.read.parquet(sink).collect())
    assert got == [(t, i) for t in "abc" for i in range(10)]


def test_streamed_redelivery_equals_batch(spark, log):
    start = dt.datetime(2024, 1, 1)
    sent = log([{"publish_time": start + dt.timedelta(seconds=i)} for i in range(100)])
    path, ledger = fresh_path(spark, "sent"), fresh_path(spark, "ledger")
    write_messages(sent, path)
    keys = lambda poll: poll.select(*delivery.MESSAGE, F.col("publish_time").alias("delivered_at"))
    stream = reader.stream_topics(spark, path, pattern=".*", start="earliest", max_files=1)
    runner.run(stream, keys, ledger, fresh_path(spark, "checkpoint"))
    deliveries = stateful.delivered(ledger, spark)
    acks = sent.where("off % 2 = 0")
    now = F.lit(start + dt.timedelta(seconds=99))
    got = delivery.due_for_redelivery(deliveries, acks, now, 10).collect()
    # the topic is idle since; its messages fall due all the same
    assert sorted(r.off for r in got) == [i for i in range(90) if i % 2 == 1]
    assert "data" not in deliveries.columns


def test_chunk_sets_come_out_with_their_last_chunk(spark, log):
    path, sink, staged, checkpoint = (fresh_path(spark, label) for label in ("chunks", "sink", "staged", "checkpoint"))
    rows = [{"data": f"message {i}", "message_id": f"m{i}"} for i in range(10)]
    chunks = chunking.split(log(rows), 4).select("chunk_set", "chunk_no", "chunk_count", "data")
    lost = (F.col("chunk_set") == "m3") & (F.col("chunk_no") == 0)
    for number in (0, 1, 2):
        chunks.where(F.col("chunk_no") == number).where(~lost).coalesce(1).write.mode("append").parquet(path)
    chunks.where("chunk_set = 'm1'").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", 1).parquet(path)
    stateful.assemble(stream, sink, staged, checkpoint)
    got = {r.chunk_set: bytes(r.data).decode() for r in spark.read.parquet(sink).collect()}
    assert got == {f"m{i}": f"message {i}" for i in range(10) if i != 3} and spark.read.parquet(sink).count() == 9
    waiting = stateful.open_chunks(spark, staged, checkpoint, 3).collect()
    assert {r.chunk_set for r in waiting} == {"m3"}
    # the missing chunk comes after all
    chunks.where(lost).coalesce(1).write.mode("append").parquet(path)
    stateful.assemble(stream, sink, staged, checkpoint)
    assert spark.read.parquet(sink).where("chunk_set = 'm3'").count() == 1


def test_streamed_parse_failures_are_kept_apart(spark, log):
    path, sink, dead = (fresh_path(spark, label) for label in ("log", "sink", "dead"))
    write_messages(log([{"data": "1,a"}, {"data": "broken", "topic": "a/b"}]), path)
    stream = reader.stream_topics(spark, path, pattern=".*", start="earliest")
    pipeline = lambda poll: consume_records(poll, SUB, "n int, s string")
    runner.run(stream, pipeline, sink, fresh_path(spark, "checkpoint"), dead_letters=dead)
    assert [r.relationship for r in spark.read.parquet(sink).collect()] == [C.SUCCESS]
    assert [(r.topic, bytes(r.content)) for r in spark.read.parquet(dead).collect()] == [("a/b", b"broken")]


def test_single_acknowledgements_add_up(spark, log):
    acks = delivery.individual_acks(log([{}, {}]), "c")
    assert sorted(r.off for r in runner.acknowledged(acks.unionByName(acks)).collect()) == [0, 1]


def _publish(spark, source, table, state, checkpoint, failures, publisher=None):
    def split(poll, ends):
        return publish_bytes(poll, Target("${t}"), demarcator="\n", ends=ends)

    stream = reader.stream_bundles(spark, source, max_files=1)
    runner.publish(stream, publisher or split, table, state, checkpoint, failures)


def test_published_offsets_go_on_from_poll_to_poll(spark, bundles):
    source, table, state, checkpoint, failures = (fresh_path(spark, label) for label in "stcpf")
    for content in ("1\n2", "3", "4\n5"):
        rows = bundles(({"t": "a"}, content), ({"t": "b"}, "x"), ({}, "lost"))
        rows.coalesce(1).write.mode("append").parquet(source)
    _publish(spark, source, table, state, checkpoint, failures)
    _publish(spark, source, table, state, checkpoint, failures)
    got = read_topics(spark, table, pattern=".*").orderBy("topic", "off").collect()
    assert [(r.topic, r.off) for r in got] == [("a", i) for i in range(5)] + [("b", i) for i in range(3)]
    assert {bytes(r.data) for r in got if r.topic == "a"} == {b"1", b"2", b"3", b"4", b"5"}
    assert spark.read.parquet(failures).count() == 3


def test_a_repeated_poll_keeps_its_messages(spark, bundles):
    source, table, state, checkpoint, failures = (fresh_path(spark, label) for label in "stcpf")
    bundles(({"t": "a"}, "1\n2"), ({}, "lost")).coalesce(1).write.parquet(source)
    lost = []

    def failing(poll, ends):
        published = publish_bytes(poll, Target("${t}"), demarcator="\n", ends=ends)
        if not lost:
            lost.append(True)
            # the messages are written, then the poll is lost before its ends are
            write_messages(published.messages, runner.poll_folder(spark, table, checkpoint, 0), mode="overwrite")
            raise RuntimeError("lost in between")
        return published

    with pytest.raises(Exception, match="lost in between"):
        _publish(spark, source, table, state, checkpoint, failures, publisher=failing)
    files = sorted(read_topics(spark, table, pattern=".*").inputFiles())
    assert read_topics(spark, table, pattern=".*").count() == 2
    _publish(spark, source, table, state, checkpoint, failures)
    assert sorted(r.off for r in read_topics(spark, table, pattern=".*").collect()) == [0, 1]
    assert sorted(read_topics(spark, table, pattern=".*").inputFiles()) == files


def test_a_failure_table_is_required(spark, bundles):
    source = fresh_path(spark, "source")
    bundles(({"t": "a"}, "x")).write.parquet(source)
    with pytest.raises(ValueError, match="table for the bundles"):
        _publish(spark, source, "t", "s", "c", None)


def test_two_publishers_share_a_table(spark, bundles):
    table, state, failures = (fresh_path(spark, label) for label in "tsf")
    for content in ("first", "second"):
        source, checkpoint = fresh_path(spark, "source"), fresh_path(spark, "checkpoint")
        bundles(({"t": "a"}, content)).coalesce(1).write.parquet(source)
        _publish(spark, source, table, state, checkpoint, failures)
    got = read_topics(spark, table, pattern=".*").orderBy("off").collect()
    assert [(r.off, bytes(r.data)) for r in got] == [(0, b"first"), (1, b"second")]


def test_a_lost_checkpoint_overwrites_nothing(spark, bundles):
    source, table, state, failures = (fresh_path(spark, label) for label in "stof")
    bundles(({"t": "a"}, "x")).coalesce(1).write.parquet(source)
    for _ in range(2):
        _publish(spark, source, table, state, fresh_path(spark, "checkpoint"), failures)
    assert sorted(r.off for r in read_topics(spark, table, pattern=".*").collect()) == [0, 1]


def test_a_bundle_without_an_id_raises(spark, bundles):
    nameless = bundles(({"t": "a"}, "x")).withColumn("bundle_id", F.lit(None).cast("bigint"))
    with pytest.raises(Exception, match="cannot be put in order"):
        publish_bytes(nameless, Target("${t}")).messages.collect()
    with pytest.raises(Exception, match="cannot be put in order"):
        publish_bytes(nameless, Target("${t}")).bundles.collect()
    with pytest.raises(Exception, match="cannot be put in order"):
        publish_records(nameless, Target("${t}"), "name string").messages.collect()
    stored = fresh_path(spark, "nameless")
    bundles(({"t": "a"}, "x"), ({"t": "a"}, "y")).withColumn("bundle_id", F.expr("nullif(bundle_id, 1)")).write.parquet(stored)
    with pytest.raises(Exception, match="cannot be put in order"):
        publish_bytes(spark.read.parquet(stored), Target("${t}")).messages.collect()


def test_receipts_of_a_stream_equal_the_batch_audit(spark, log):
    path, sink, receipts, checkpoint = (fresh_path(spark, label) for label in ("log", "sink", "receipts", "checkpoint"))
    for topic in "abc":
        write_messages(log([{"data": str(i), "topic": topic} for i in range(20)]).coalesce(1), path)
    stream = reader.stream_topics(spark, path, pattern=".*", start="earliest", max_files=1)
    runner.run(stream, _pipeline, sink, checkpoint, receipts=receipts)
    batch = audit.receipts(spark.read.parquet(sink), "broker://x").agg(F.sum("bundles"), F.sum("messages"), F.min("first_off"), F.max("last_off")).first()
    noted = spark.read.parquet(receipts)
    assert noted.count() == 3
    total = noted.agg(F.sum("bundles"), F.sum("messages"), F.min("first_off"), F.max("last_off"), F.sum("bytes")).first()
    assert tuple(total)[:4] == tuple(batch) and total[1] == 60
    assert total[4] == spark.read.parquet(sink).agg(F.sum(F.octet_length("content"))).first()[0]


def test_a_receipt_lost_with_its_poll_is_made_of_the_output(spark, log, monkeypatch):
    path, sink, receipts, checkpoint = (fresh_path(spark, label) for label in ("log", "sink", "receipts", "checkpoint"))
    write_messages(log([{"data": "1,a"}, {"data": "broken", "topic": "u"}]), path)
    stream = lambda: reader.stream_topics(spark, path, pattern=".*", start="earliest")
    pipeline = lambda poll: consume_records(poll, SUB, "n int, s string")

    def lost(*args):
        raise RuntimeError("lost before the receipt")

    dead, options = fresh_path(spark, "dead"), {"receipts": receipts}
    with monkeypatch.context() as m:
        m.setattr(runner, "_note", lost)
        with pytest.raises(Exception, match="lost before"):
            runner.run(stream(), pipeline, sink, checkpoint, dead_letters=dead, **options)
    runner.run(stream(), pipeline, sink, checkpoint, dead_letters=dead, **options)
    (row,) = spark.read.parquet(receipts).collect()
    assert (row.bundles, row.messages) == (2, 2)


def test_staged_chunks_are_written_once(spark, log):
    path, sink, staged, checkpoint = (fresh_path(spark, label) for label in ("chunks", "sink", "staged", "checkpoint"))
    chunks = chunking.split(log([{"data": "x" * 40, "message_id": f"m{i}"} for i in range(6)]), 4).select("chunk_set", "chunk_no", "chunk_count", "data")
    for number in range(10):
        chunks.where(F.col("chunk_no") == number).coalesce(1).write.mode("append").parquet(path)
    chunks.where("chunk_no = 2 and chunk_set = 'm1'").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", 1).parquet(path)
    stateful.assemble(stream, sink, staged, checkpoint)
    assert spark.read.parquet(sink).where("octet_length(data) = 40").count() == spark.read.parquet(sink).count() == 6
    kept = spark.read.parquet(f"{staged}/data")
    assert kept.count() == kept.select("chunk_set", "chunk_no").distinct().count() == 9 * 6
    assert stateful.open_chunks(spark, staged, checkpoint, 9).count() == 0


def test_the_ledger_is_read_for_the_logs_of_a_poll_alone(spark, log):
    ledger = fresh_path(spark, "ledger")
    log([{"topic": t, "off": i} for t in "abc" for i in range(3)]).select(*delivery.MESSAGE).write.partitionBy("topic", "part").parquet(f"{ledger}/poll=x-0")
    unseen = stateful._unseen(log([{"topic": "b", "off": 1}, {"topic": "b", "off": 9}]), ledger)
    assert [r.off for r in unseen.collect()] == [9]
    plan = unseen._jdf.queryExecution().executedPlan().toString()
    assert any("PartitionFilters" in line and "topic" in line and "b)" in line.split("PushedFilters")[0] for line in plan.splitlines())


def test_stream_sources_grow_in_files_and_not_in_tasks(spark, monkeypatch):
    from topicframe.catalogue import queries

    monkeypatch.setattr(queries, "SOURCE_BYTES", 1000)
    # one chunk a set: dealt by chunk_no alone all would be in one file
    chunks = spark.range(4000).selectExpr("id as chunk_set", "0 as chunk_no", "1 as chunk_count", "cast('0123456789' as binary) as data")
    path, half = queries._source(chunks, queries._bytes(chunks, "data"), ["chunk_set", "chunk_no"], "grown-source")
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 40 and half == 20 and sum(sizes) == 4000 and max(sizes) < 200
    few, half = queries._source(chunks.limit(3), 30, ["chunk_set", "chunk_no"], "small-source")
    assert half == 2 and spark.read.parquet(few).count() == 3


def test_streams_of_many_files_give_the_same_rows(spark, monkeypatch):
    from topicframe.catalogue import queries

    folder = "/root/testdata/sf0.001"
    for name in ("stream_chunks", "stream_publish_failures"):
        want = sorted(queries.REGISTRY[name](spark, folder).collect())
        with monkeypatch.context() as patch:
            patch.setattr(queries, "SOURCE_BYTES", 30_000)
            assert sorted(queries.REGISTRY[name](spark, folder).collect()) == want and want
