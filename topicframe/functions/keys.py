"""Message keys: hashing for routing, and text forms of record fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .codecs import serialize


def key_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a key, from the first 32 bits of its MD5: any engine can recompute it."""
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % buckets).cast("bigint")


def key_text(value: Column, data_type: T.DataType, fmt: str) -> Column:
    """A record field as a message key; null stays null."""
    if isinstance(data_type, T.BinaryType):
        return value.cast("string")
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.ByteType):
        # a byte array that the record model keeps as numbers
        hexes = F.transform(value, lambda b: F.lpad(F.hex(b.cast("int").bitwiseAND(F.lit(255))), 2, "0"))
        return F.unhex(F.array_join(hexes, "")).cast("string")
    if isinstance(data_type, T.StructType):
        return F.when(value.isNotNull(), serialize(value, fmt))
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")
