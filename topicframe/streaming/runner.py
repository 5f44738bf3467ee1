"""Running a pipeline over a stream: output first, acknowledgement after.

A poll's output is a folder named by the stream's own identity (that of its checkpoint) and the
poll's number. A folder that a writer has committed is never written again: a repeated poll takes
it as it stands, so readers of the table, streams among them, see its files once. Two streams into
one table have two identities, and a stream whose checkpoint was lost has a new one, so none
overwrites another's output.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..plans.publish import Published
from ..operators.audit import received
from ..schema import MESSAGE_SCHEMA
from ..sinks.tables import dead_letter, write_messages
from ..workspace import complete, exists, hold, safe_name, shared_dir


def checkpoint_path(df: DataFrame, consumer_id: str) -> str:
    """The checkpoint folder of a consumer; the same identity finds the same folder."""
    return f"{shared_dir(df.sparkSession)}/topicframe/consumers/{safe_name(consumer_id)}"


def identity(spark: SparkSession, checkpoint: str) -> str:
    """The identity Spark has given the stream of this checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def poll_folder(spark: SparkSession, root: str, checkpoint: str, number: int) -> str:
    return f"{root}/poll={identity(spark, checkpoint)}-{number}"


def write_once(df: Callable[[], DataFrame], path: str, spark: SparkSession, partition_by: Sequence[str] = ()) -> None:
    """Write a poll's folder unless it is there already."""
    if not complete(spark, path):
        df().write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def run(
    stream: DataFrame,
    pipeline: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    acks: str | None = None,
    acknowledge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    poll: str | None = None,
    timeout_seconds: float | None = None,
    dead_letters: str | None = None,
    receipts: str | None = None,
    metrics: Callable[[], list[Column]] = received,
) -> None:
    """Apply ``pipeline`` to each poll and write the result under ``sink``.

    With ``dead_letters`` the rows of the parse-failure route go to a table of their own.
    With ``receipts`` each poll notes there, in one row, the ``metrics`` of the bundles it wrote,
    observed while they are written.
    Acknowledgements are made of what was written and the poll's messages once the output is
    there; then the checkpoint moves on.

    Without ``poll`` the stream is drained and the call returns; with it (say ``2 seconds``)
    the stream is polled until ``timeout_seconds`` have passed, or for good.
    """

    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        out = poll_folder(spark, sink, checkpoint, number)
        seen = Observation() if receipts and not complete(spark, out) else None
        whole = (lambda: pipeline(batch).observe(seen, *metrics())) if seen else (lambda: pipeline(batch))
        if dead_letters and not complete(spark, out):
            rows = hold(whole(), "poll")
            failed = F.col("relationship") == C.PARSE_FAILURE
            dead_letter(rows.where(failed), poll_folder(spark, dead_letters, checkpoint, number), mode="overwrite")
            write_once(lambda: rows.where(~failed), out, spark, partition_by)
        write_once(whole, out, spark, partition_by)
        if receipts:
            _note(spark, seen, metrics(), [out, *([poll_folder(spark, dead_letters, checkpoint, number)] if dead_letters else [])], receipts, checkpoint, number)
        if acks and acknowledge:
            noted = poll_folder(spark, acks, checkpoint, number)
            write_once(lambda: acknowledge(spark.read.parquet(out), batch), noted, spark)

    drain(stream, commit, checkpoint, poll, timeout_seconds)


def _note(
    spark: SparkSession,
    seen: Observation | None,
    metrics: list[Column],
    written: list[str],
    receipts: str,
    checkpoint: str,
    number: int,
) -> None:
    """Write a poll's receipt: as observed, or if the poll's output stood before, from that output."""
    path = poll_folder(spark, receipts, checkpoint, number)
    if complete(spark, path):
        return
    kept = [spark.read.parquet(folder) for folder in written if exists(spark, folder)]
    whole = kept[0]
    for more in kept[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    totals = whole.agg(*metrics)
    if seen:
        totals = spark.createDataFrame([tuple(seen.get[c] for c in totals.columns)], totals.schema)
    write_once(lambda: totals.coalesce(1), path, spark)


def drain(
    stream: DataFrame,
    commit: Callable[[DataFrame, int], None],
    checkpoint: str,
    poll: str | None = None,
    timeout_seconds: float | None = None,
) -> None:
    """Hand each poll to ``commit``; the checkpoint moves on when it returns."""
    writer = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=poll) if poll else writer.trigger(availableNow=True)
    query = writer.start()
    try:
        query.awaitTermination(timeout_seconds) if timeout_seconds else query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()


def publish(
    bundles: DataFrame,
    publisher: Callable[[DataFrame, DataFrame], Published],
    table: str,
    state: str,
    checkpoint: str,
    failures: str,
    compression: str = "NONE",
    poll: str | None = None,
    timeout_seconds: float | None = None,
) -> None:
    """Publish a stream of bundles into a topic table.

    ``publisher`` gets a poll and the topics' ends and gives what to publish. Failed bundles go
    to ``failures``, before any message is written. All publishers into one table share one
    ``state``, the table of the topics' ends, and go on from each other's; they take turns, as a
    table of files gives no lock: do not run two at the same moment.
    """
    if not failures:
        raise ValueError("a streamed publisher needs a table for the bundles it cannot publish")

    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        noted = poll_folder(spark, state, checkpoint, number)
        if complete(spark, noted):
            return
        out = poll_folder(spark, table, checkpoint, number)
        ends = _ends(spark, state)
        if not complete(spark, out):
            published = publisher(batch, ends)
            failed = published.bundles.where(F.col("relationship") != C.SUCCESS)
            write_once(lambda: failed, poll_folder(spark, failures, checkpoint, number), spark)
            write_messages(published.messages, out, compression, mode="overwrite")
        written = spark.read.schema(MESSAGE_SCHEMA).parquet(out)
        reached = written.select("topic", (F.col("off") + 1).alias("next_off")).unionByName(ends)
        reached.groupBy("topic").agg(F.max("next_off").alias("next_off")).write.mode("overwrite").parquet(noted)

    drain(bundles, commit, checkpoint, poll, timeout_seconds)


def _ends(spark: SparkSession, state: str) -> DataFrame:
    """Where each topic's next message goes, as all publishers' polls so far have left it."""
    schema = "topic string, next_off bigint"
    if not exists(spark, state):
        return spark.createDataFrame([], schema)
    polls = spark.read.schema(schema).parquet(state)
    return hold(polls.groupBy("topic").agg(F.max("next_off").alias("next_off")), "ends")


def acknowledged(acks: DataFrame) -> DataFrame:
    """What all polls have acknowledged: cursors, or where messages were acknowledged singly, those."""
    if "position" in acks.columns:
        return acks.groupBy("consumer_id", "topic", "part").agg(F.max("position").alias("position"))
    return acks.select("consumer_id", "topic", "part", "off").distinct()
