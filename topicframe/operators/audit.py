"""What was received and sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def receipts(bundles: DataFrame, broker_url: str) -> DataFrame:
    """Receive events added up per consumer, log and receive batch."""
    return (
        bundles.groupBy("consumer_id", "topic", "part", "batch_no")
        .agg(
            F.count("*").alias("bundles"),
            F.sum("message_count").alias("messages"),
            F.min("first_off").alias("first_off"),
            F.max("last_off").alias("last_off"),
        )
        .withColumn("transit_uri", F.concat(F.lit(broker_url + "/"), F.col("topic")))
    )


def received() -> list[Column]:
    """What a poll's receipt adds up, as metrics of the bundles while they are written."""
    return [
        F.count("*").alias("bundles"),
        F.coalesce(F.sum("message_count"), F.lit(0)).cast("bigint").alias("messages"),
        F.coalesce(F.sum(F.octet_length("content")), F.lit(0)).cast("bigint").alias("bytes"),
        F.min("first_off").alias("first_off"),
        F.max("last_off").alias("last_off"),
    ]


def publish_counts(bundles: DataFrame, sent: Column) -> DataFrame:
    """Add ``sent_count`` and, on success, the count and topic attributes to each bundle.

    The count comes from the bundle's own row, so no join back from its messages is needed.
    """
    good = F.col("relationship") == C.SUCCESS
    counted = bundles.withColumn("sent_count", F.when(good, sent.cast("bigint")))
    noted = F.map_concat(
        F.map_filter(
            "attributes",
            lambda name, _: ~name.isin(C.PUBLISHED_COUNT_ATTRIBUTE, C.PUBLISHED_TOPIC_ATTRIBUTE),
        ),
        F.create_map(
            F.lit(C.PUBLISHED_COUNT_ATTRIBUTE),
            F.col("sent_count").cast("string"),
            F.lit(C.PUBLISHED_TOPIC_ATTRIBUTE),
            F.col("topic"),
        ),
    )
    return counted.withColumn("attributes", F.when(good, noted).otherwise(F.col("attributes")))


def sends(published: DataFrame, broker_url: str) -> DataFrame:
    """One send event per published bundle."""
    return published.where(F.col("relationship") == C.SUCCESS).select(
        "bundle_id",
        F.lit(broker_url).alias("transit_uri"),
        F.concat(F.lit("Sent "), F.col("sent_count").cast("string"), F.lit(" records")).alias("details"),
    )
