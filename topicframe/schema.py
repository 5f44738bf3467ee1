"""The envelopes operators read and write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ATTRIBUTES = T.MapType(T.StringType(), T.StringType())

# One row per message. ``off`` is unique inside (topic, part) and gives the log order.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("part", T.IntegerType(), False),
        T.StructField("off", T.LongType(), False),
        T.StructField("message_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("properties", _ATTRIBUTES),
        T.StructField("publish_time", T.TimestampType()),
        T.StructField("schema_type", T.StringType()),
        T.StructField("schema_def", T.StringType()),
        T.StructField("data", T.BinaryType()),
    ]
)

# One row per bundle a consumer emits.
BUNDLE_SCHEMA = T.StructType(
    [
        T.StructField("consumer_id", T.StringType(), False),
        T.StructField("topic", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("batch_no", T.LongType(), False),
        T.StructField("bundle_no", T.LongType(), False),
        T.StructField("attributes", _ATTRIBUTES),
        T.StructField("content", T.BinaryType()),
        T.StructField("message_count", T.LongType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("first_off", T.LongType()),
        T.StructField("last_off", T.LongType()),
        T.StructField("relationship", T.StringType()),
    ]
)

# One row per bundle a publisher takes. ``bundle_id`` is unique and gives the sending order.
OUTGOING_SCHEMA = T.StructType(
    [
        T.StructField("bundle_id", T.LongType(), False),
        T.StructField("attributes", _ATTRIBUTES),
        T.StructField("content", T.BinaryType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the envelope columns in order; columns ``df`` lacks become typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
