"""Publishing bundles whose contents are files.

A bundle is a row of ``bundle_id``, ``attributes`` and the ``path`` of a file below ``root``, as
``sources.files.listed`` names it. What one row holds elsewhere is spread here: tokens and records are
rows of their own from the start, and only counts per file meet. A file may be a third of all data, so
tokens find their bundle by a lookup that is broadcast or salted, never by a join on the path alone.

A bundle without a path, or with one that is no file there, fails like one without content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import codecs
from ..operators import audit, publish, records
from ..operators.lookup import left_lookup
from ..sources import files
from ..workspace import hold
from .publish import Published, Target, as_messages, with_id


def publish_files(
    bundles: DataFrame,
    root: str,
    target: Target,
    demarcator: str,
    key: str | None = None,
    ends: DataFrame | None = None,
) -> Published:
    """The raw publisher: each token of a bundle's file is a message. The demarcator is the same for all files."""
    if "${" in demarcator:
        raise ValueError("files are cut before their bundles are known; the demarcator cannot depend on attributes")
    cut = files.tokens(bundles.sparkSession, root, demarcator)
    counts = cut.groupBy("path").agg(F.count("*").alias("sent"))
    addressed = publish.with_properties(publish.with_key(publish.with_topic(with_id(bundles), target.topic), key), target.properties)
    routed = publish.route(_found(addressed, root, counts))
    sent = F.coalesce("sent", F.lit(0).cast("bigint"))
    placed = _numbered(routed.withColumn("sent", sent), ends, ["topic", "key", "properties"])
    messages = _met(cut, placed).select("topic", "key", "properties", "first_off", "pos", "data")
    return Published(as_messages(messages, target), _counted(routed, sent))


def publish_file_records(
    bundles: DataFrame,
    root: str,
    target: Target,
    schema: T.StructType | str,
    reader: records.Format = "csv",
    writer: records.Format = "csv",
    key_field: str | None = None,
    partial: str = "none",
    options: dict[str, str] | None = None,
    ends: DataFrame | None = None,
    writer_options: dict[str, str] | None = None,
) -> Published:
    """The record publisher: each line of a bundle's file is a record, and each record a message.

    As with contents in rows, a malformed record fails its bundle, of which nothing is sent, or with
    ``partial="prefix"`` the records before it. The first malformed one of a file is found in a first
    pass over the lines; the second sends what stands before it. Blank lines are skipped, with the
    ``header`` option of CSV the first line is too. A line that is not one whole record is malformed,
    a quoted field with a line break in it included.
    """
    if partial not in ("none", "prefix"):
        raise ValueError(f"unknown partial mode {partial!r}; use none or prefix")
    settings = dict(options or {})
    has_header = reader == "csv" and str(settings.pop("header", "false")).lower() == "true"
    filled = ~F.col("data").cast("string").rlike(r"^ *\r?$")
    lines = files.tokens(bundles.sparkSession, root, "\n", filled)
    if has_header:
        lines = lines.where("pos > 0").withColumn("pos", F.col("pos") - 1)
    parsed = records.parse(lines, schema, reader, settings)
    one = F.get("records", F.lit(0))
    bad = (F.size("records") != 1) | one[codecs.CORRUPT].isNotNull()
    if reader == "csv":
        quote = settings.get("quote", '"')
        text = F.col("data").cast("string")
        bad = bad | ((F.length(text) - F.length(F.replace(text, F.lit(quote), F.lit("")))) % 2 != 0)
    found = parsed.groupBy("path").agg(F.count("*").alias("n"), F.min(F.when(bad, F.col("pos"))).alias("bad"))
    found = hold(found, "first-malformed")
    addressed = publish.with_properties(publish.with_topic(with_id(bundles), target.topic), target.properties)
    routed = publish.route(_found(addressed, root, found))
    failed = F.col("bad").isNotNull()
    before = F.col("bad") if partial == "prefix" else F.lit(0).cast("bigint")
    usable = F.col("relationship") == C.SUCCESS
    sent = F.when(usable, F.when(failed, before).otherwise(F.coalesce("n", F.lit(0).cast("bigint")))).otherwise(F.lit(0).cast("bigint"))
    routed = routed.withColumn("sent", sent).withColumn("relationship", F.when(failed, C.FAILURE).otherwise(F.col("relationship"))).drop("bad", "n")
    placed = _numbered(routed, ends, ["topic", "properties", "sent"], any_route=True)
    sending = _met(parsed, placed).where("pos < sent")
    message = F.get(publish.record_messages(schema, writer, key_field, writer_options), F.lit(0))
    messages = sending.select("topic", "properties", "first_off", "pos", message.alias("_message")).select("topic", "properties", "first_off", "pos", "_message.*")
    return Published(as_messages(messages, target), _counted(routed, F.col("sent")))


def _found(bundles: DataFrame, root: str, counts: DataFrame) -> DataFrame:
    """Bundles with ``content``, the path if there is such a file, and what was counted in it."""
    known = files.listed(bundles.sparkSession, root).select("path", F.col("path").alias("content"))
    per_file = hold(known.join(counts, "path", "left"), "files")
    return left_lookup(bundles, per_file, ["path"], spread="bundle_id")


def _numbered(routed: DataFrame, ends: DataFrame | None, carried: list[str], any_route: bool = False) -> DataFrame:
    """(path, first_off, carried) of the bundles that send anything."""
    sending = routed.where("sent > 0") if any_route else routed.where((F.col("relationship") == C.SUCCESS) & (F.col("sent") > 0))
    narrow = sending.select(*dict.fromkeys(["bundle_id", "path", "topic", "sent", *carried]))
    return hold(publish.assign_offsets(narrow, F.col("sent"), ends=ends).select("path", "first_off", *carried), "file-offsets")


def _met(rows: DataFrame, placed: DataFrame) -> DataFrame:
    return left_lookup(rows, placed, ["path"], spread="pos").where(F.col("first_off").isNotNull())


def _counted(routed: DataFrame, sent: Column) -> DataFrame:
    return audit.publish_counts(routed.drop("content"), sent).drop("sent")
