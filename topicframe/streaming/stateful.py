"""Operators that remember between polls, by tables of what earlier polls have seen.

Nothing here goes by event time: a topic table is laid out by log, not by time, so a bounded poll
may bring one topic to its end before the next begins, and a limit on lateness would drop it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import chunking
from ..operators.delivery import MESSAGE
from ..workspace import complete, exists, hold
from .runner import drain, identity, poll_folder, write_once


def dedupe(
    stream: DataFrame,
    sink: str,
    ledger: str,
    checkpoint: str,
    poll: str | None = None,
    timeout_seconds: float | None = None,
) -> None:
    """Write each message of a stream to ``sink`` once, however often and late it comes again.

    ``ledger`` keeps the keys of all messages written, by log. A poll is held against the logs
    and the range of offsets it has itself.
    """

    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        out = poll_folder(spark, sink, checkpoint, number)
        write_once(lambda: _unseen(batch.dropDuplicates(MESSAGE), ledger), out, spark)
        noted = poll_folder(spark, ledger, checkpoint, number)
        write_once(lambda: spark.read.parquet(out).select(*MESSAGE), noted, spark, ("topic", "part"))

    drain(stream, commit, checkpoint, poll, timeout_seconds)


def _unseen(batch: DataFrame, ledger: str) -> DataFrame:
    spark = batch.sparkSession
    if not exists(spark, ledger):
        return batch
    # one row for each log of the poll
    logs = batch.groupBy("topic", "part").agg(F.min("off").alias("lo"), F.max("off").alias("hi")).collect()
    if not logs:
        return batch
    seen = spark.read.schema("off bigint, topic string, part int").parquet(ledger)
    seen = seen.where(F.col("topic").isin({r.topic for r in logs}) & F.col("part").isin({r.part for r in logs}))
    seen = seen.where(F.col("off").between(min(r.lo for r in logs), max(r.hi for r in logs)))
    return batch.join(seen.select(*MESSAGE), MESSAGE, "left_anti")


def assemble(
    chunks: DataFrame,
    sink: str,
    staged: str,
    checkpoint: str,
    carry: tuple[str, ...] = (),
    poll: str | None = None,
    timeout_seconds: float | None = None,
) -> None:
    """Write each chunked message to ``sink`` in the poll that brings its last chunk.

    ``staged`` keeps three tables. A chunk whose set stays open is staged once, with its payload;
    the keys of open chunks go from poll to poll, each with the folder that holds its payload; and
    the ids of sets that came out are noted. So a poll reads and writes payloads of its own chunks
    and of the sets it completes only. ``open_chunks`` shows what waits. A chunk that comes again,
    while its set is open or after it was written, is dropped.
    """

    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        out, data, keys, done = (
            poll_folder(spark, root, checkpoint, number)
            for root in (sink, f"{staged}/data", f"{staged}/open", f"{staged}/done")
        )
        own = f"{identity(spark, checkpoint)}-{number}"
        fresh = batch.select("chunk_set", "chunk_no", "chunk_count", "data", *carry).dropDuplicates(["chunk_set", "chunk_no"])
        if exists(spark, f"{staged}/done"):
            noted = spark.read.schema("chunk_set string, poll string").parquet(f"{staged}/done")
            fresh = fresh.join(noted.where(F.col("poll") != own).select("chunk_set"), "chunk_set", "left_anti")
        before = _open_keys(spark, staged, checkpoint, number - 1)
        if before is not None:
            fresh = fresh.join(before.select("chunk_set", "chunk_no"), ["chunk_set", "chunk_no"], "left_anti")
        fresh = hold(fresh, "fresh-chunks")
        known = fresh.select(*_KEY, F.lit(own).alias("held"))
        known = known if before is None else before.unionByName(known)
        sets = known.groupBy("chunk_set").agg(F.count("*").alias("n"), F.max("chunk_count").alias("chunk_count"))
        whole = hold(sets.where("n = chunk_count").select("chunk_set"), "whole-sets")
        ready = fresh
        if before is not None:
            ready = _payloads(spark, staged, before.join(whole, "chunk_set", "left_semi"), fresh)
        write_once(lambda: chunking.assemble(ready.join(whole, "chunk_set", "left_semi"), carry), out, spark)
        write_once(lambda: fresh.join(whole, "chunk_set", "left_anti"), data, spark)
        write_once(lambda: whole, done, spark)
        write_once(lambda: known.join(whole, "chunk_set", "left_anti"), keys, spark)

    chunks = chunks.withColumn("chunk_set", F.col("chunk_set").cast("string"))
    drain(chunks, commit, checkpoint, poll, timeout_seconds)


_KEY = ("chunk_set", "chunk_no", "chunk_count")


def _open_keys(spark: SparkSession, staged: str, checkpoint: str, number: int) -> DataFrame | None:
    path = poll_folder(spark, f"{staged}/open", checkpoint, number)
    return spark.read.parquet(path).select(*_KEY, "held") if number >= 0 and complete(spark, path) else None


def _payloads(spark: SparkSession, staged: str, wanted: DataFrame, fresh: DataFrame) -> DataFrame:
    """The staged chunks that are wanted, from the folders that hold them alone, and the fresh ones."""
    held = [r.held for r in wanted.select("held").distinct().collect()]
    if not held:
        return fresh
    schema = StructType([*fresh.schema]).add("poll", "string")
    rows = spark.read.schema(schema).parquet(f"{staged}/data").where(F.col("poll").isin(held))
    return rows.join(wanted.select("chunk_set", "chunk_no"), ["chunk_set", "chunk_no"], "left_semi").select(fresh.columns).unionByName(fresh)


def open_chunks(spark: SparkSession, staged: str, checkpoint: str, number: int) -> DataFrame | None:
    """The chunks that were waiting for others after a poll; None if there was no such poll."""
    keys = _open_keys(spark, staged, checkpoint, number)
    return None if keys is None else keys.select(*_KEY)


def delivered(ledger: str, spark: SparkSession) -> DataFrame:
    """The deliveries noted by ``runner.run`` over message keys and ``delivered_at``, each at its latest time.

    With the acknowledgements' ledger and the time of day this is what ``delivery.due_for_redelivery``
    asks for, so an idle topic's messages fall due as well. Payloads are in neither ledger.
    """
    notes = spark.read.parquet(ledger)
    return hold(notes.groupBy(*MESSAGE).agg(F.max("delivered_at").alias("delivered_at")), "delivered")
