"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes the reduce side and splits hot partitions at run time, so the shuffle
# partition number is an upper bound chosen by the caller, not a tuned constant.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # parsing and splitting cost far more per byte than moving it, so small shuffles are not
    # packed into a few tasks
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    name: str = "topicframe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
