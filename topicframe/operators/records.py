"""Typed records inside messages: parsing, routing and rewriting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import codecs, schemas
from ..workspace import hold
from .lookup import left_lookup

Format = str | Callable[[Column], Column]


def parse(
    df: DataFrame,
    schema: T.StructType | str,
    fmt: Format = "csv",
    options: dict[str, str] | None = None,
    data: str = "data",
) -> DataFrame:
    """Add ``records``, all records of the payload, malformed ones marked in ``_corrupt``.

    The optimizer copies a column's expression into every filter it pushes below, and would
    parse again there. What a generator puts out is not copied, so the column is made by one.
    """
    read = codecs.read_records(F.col(data), schema, fmt, options)
    return df.select("*", F.inline(F.array(F.struct(read.alias("records")))))


def explode(df: DataFrame, records: str = "records") -> DataFrame:
    """One row per record with its ``pos`` in the message (from 0) and its fields as columns."""
    rest = [c for c in df.columns if c not in ("records", "kept")]
    return df.select(*rest, F.posexplode(records).alias("pos", "_record")).select(*rest, "pos", "_record.*")


def route(df: DataFrame) -> DataFrame:
    """Split each message at its first malformed record, within the row.

    ``kept`` are the records before it; ``failed`` says there is one, in which case the whole
    message also belongs to the parse failures. Records behind it are in neither.
    """
    return (
        df.withColumn("_bad", codecs.first_bad(F.col("records")))
        .withColumn("kept", codecs.good_prefix(F.col("records"), F.col("_bad")))
        .withColumn("failed", F.col("_bad") > 0)
        .drop("_bad")
    )


def with_own_fields(keyed: DataFrame, messages: DataFrame, schema: str = "schema_def") -> DataFrame:
    """Add ``_fields``, the fields of each message's own schema; null where its text is none.

    ``keyed`` has the schema's ``_schema_key``. Each distinct text of ``messages`` is read once, into
    a stored table, which is sent to the messages if it is small and met by salted keys if not.
    """
    texts = messages.where(F.col(schema).isNotNull()).groupBy(schema).agg(F.lit(1).alias("_"))
    known = texts.select(schemas.key_of(F.col(schema)).alias("_schema_key"), schemas.fields_of(F.col(schema)).alias("_fields"))
    return left_lookup(keyed, hold(known, "schemas"), ["_schema_key"])


def route_schema(df: DataFrame, schema: str = "schema_def", readable: bool = False) -> DataFrame:
    """Messages for which no schema is known go to the parse failures and begin no bundle.

    With ``readable`` a schema text must also be one that can be read.
    """
    found = F.col(schema).isNotNull()
    if readable:
        found = found & schemas.fields_of(F.col(schema)).isNotNull()
    return df.withColumn("relationship", F.when(found, C.SUCCESS).otherwise(C.PARSE_FAILURE))


def apply_policy(df: DataFrame, on_error: str) -> DataFrame:
    """What to do with a message that has an undecodable record.

    ``consume`` keeps the message with those records as nulls, ``discard`` drops it, ``fail``
    routes it to the failures.
    """
    undecodable = codecs.first_bad(F.col("records")) > 0
    if on_error == "consume":
        nulled = F.transform("records", lambda r: F.when(r[codecs.CORRUPT].isNull(), r))
        return df.withColumn("records", nulled).withColumn("relationship", F.lit(C.SUCCESS))
    if on_error == "discard":
        return df.where(~undecodable).withColumn("relationship", F.lit(C.SUCCESS))
    if on_error == "fail":
        return df.withColumn("relationship", F.when(undecodable, C.FAILURE).otherwise(C.SUCCESS))
    raise ValueError(f"unknown policy {on_error!r}; use consume, discard or fail")


def counts(df: DataFrame, records: str = "kept") -> DataFrame:
    """Add ``record_count``, the records a message contributes."""
    return df.withColumn("record_count", F.size(records).cast("bigint"))


def written(records: Column, fmt: Format, options: dict[str, str] | None = None) -> Column:
    """A message's records serialized one after another, as bytes; null when there are none."""
    lines = F.transform(records, lambda r: codecs.serialize(codecs.without_corrupt(r), fmt, options))
    return F.when(F.size(records) > 0, F.array_join(lines, "").cast("binary"))


def write(
    df: DataFrame,
    fmt: Format,
    within: Sequence[str],
    order: str = "off",
    records: str = "kept",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One row per ``within`` with the records of its messages serialized in order.

    Each message is serialized before the shuffle, so what moves is the output's own bytes.
    """
    return (
        df.withColumn("_written", written(F.col(records), fmt, options))
        .groupBy(*reversed(within))
        .agg(
            F.expr(f"listagg(_written, X'') within group (order by {order})").alias("content"),
            F.sum(F.size(records)).alias("record_count"),
        )
        .where("record_count > 0")
    )
