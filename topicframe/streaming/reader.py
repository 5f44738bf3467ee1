"""Topic tables as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from ..schema import MESSAGE_SCHEMA, OUTGOING_SCHEMA
from ..sources.topics import read_topics, snapshot_once, start_position, subscribed
from ..workspace import safe_name, shared_dir


def stream_topics(
    spark: SparkSession,
    path: str,
    topics: str | None = None,
    pattern: str | None = None,
    start: str = "latest",
    at_subscribe: DataFrame | None = None,
    consumer_id: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Messages of the subscribed topics as they are added to the table.

    A trigger is one poll; ``max_files`` or ``max_bytes`` bound it. The folder is listed
    again at each trigger, so partitions and topics added later are picked up.

    ``latest`` begins behind the logs' ends when the subscription was made: those given in
    ``at_subscribe``, or else those noted under ``consumer_id`` when it first subscribed.
    """
    if start == "latest" and at_subscribe is None and consumer_id:
        noted = f"{shared_dir(spark)}/topicframe/subscribed/{safe_name(consumer_id)}"
        at_subscribe = snapshot_once(read_topics(spark, path, topics, pattern), noted)
    found = _bounded(spark, MESSAGE_SCHEMA, max_files, max_bytes).parquet(path)
    found = found.where(subscribed(topics, pattern)).select(*MESSAGE_SCHEMA.names)
    return start_position(found, at_subscribe, start)


def stream_bundles(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Bundles for a publisher as they are added to a table of them.

    Without a bound a poll takes all that is waiting, as the publishers being matched do.
    """
    return _bounded(spark, OUTGOING_SCHEMA, max_files, max_bytes).parquet(path).select(*OUTGOING_SCHEMA.names)


def _bounded(spark: SparkSession, schema: StructType, max_files: int | None, max_bytes: int | None) -> DataStreamReader:
    if max_files and max_bytes:
        raise ValueError("bound a poll by files or by bytes, not both")
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader
