"""Record readers and writers as Column expressions.

A reader turns one payload into an array of records, so parsing never leaves the row and
needs no shuffle. ``_corrupt`` in a record holds the offending text, null when it is fine.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro, to_avro

CORRUPT = "_corrupt"

# a quote inside a quoted field is doubled, and a quoted field may hold line breaks
_CSV_QUOTING = {"quote": '"', "escape": '"', "multiLine": "true"}
_CSV_OPTIONS = {**_CSV_QUOTING, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
_CSV_WRITING = {**_CSV_QUOTING, "quoteAll": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_LINE_END = "\n"


def as_struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_records(
    data: Column,
    schema: T.StructType | str,
    fmt: str | Callable[[Column], Column],
    options: dict[str, str] | None = None,
) -> Column:
    """All records of one payload, good and bad, in order. An empty payload has none.

    ``fmt`` is ``csv``, ``json``, ``avro``, or a function from the payload to an array of structs
    that end in ``_corrupt``.

    CSV has a record per line; line breaks inside quoted fields belong to the field. ``options``
    are the reader's; with ``header`` the first line is skipped, columns go by place. JSON has any
    number of objects, or arrays of them, one behind the other; text between or behind them, and
    what a cut-off array has after its last whole element, is a malformed record.
    """
    if callable(fmt):
        return fmt(data)
    fields = as_struct(schema)
    settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    text = data.cast("string")
    if fmt == "csv":
        has_header = str(settings.pop("header", "false")).lower() == "true"
        lines = csv_lines(text, settings)
        if has_header:
            lines = _bound(lines, lambda x: F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))))
        ddl = _ddl(_with_corrupt(fields))
        records = F.transform(lines, lambda line: F.from_csv(line, ddl, {**_CSV_OPTIONS, **settings}))
    elif fmt == "json":
        full = _with_corrupt(fields)
        records = F.transform(json_values(text), lambda value: F.from_json(value, full, settings))
    elif fmt == "avro":
        records = _read_avro(data, fields, options)
    else:
        raise ValueError(f"unknown record format {fmt!r}; use csv, json, avro or a function")
    return F.coalesce(records, F.array().cast(T.ArrayType(_with_corrupt(fields))))


def csv_lines(text: Column, settings: dict[str, str] | None = None) -> Column:
    """The lines of CSV text that are not blank; a quoted field may hold line breaks."""
    wanted = settings or {}
    mark = re.escape(wanted.get("sep", wanted.get("delimiter", ",")))
    quote = re.escape(wanted.get("quote", '"'))
    field = rf"(?:[ \t]*{quote}(?:[^{quote}]++|{quote}{quote})*+{quote}(?:(?!{mark})[^\r\n])*+|(?:(?!{mark})[^\r\n])*+)"
    quoted = F.regexp_extract_all(text, F.lit(rf"({field}(?:{mark}{field})*+)"), 1)
    plain = F.split(text, "\r?\n")
    cut = F.when(text.contains(wanted.get("quote", '"')), quoted).otherwise(plain)
    return F.filter(cut, lambda line: F.trim(line) != "")


def csv_parts(line: Column, settings: dict[str, str] | None = None) -> Column:
    """The fields of one CSV line as text: null where a field is empty, but not where it is quoted."""
    wanted = settings or {}
    sep, quote = wanted.get("sep", wanted.get("delimiter", ",")), wanted.get("quote", '"')
    mark, q = re.escape(sep), re.escape(quote)
    # each match begins with a mark, so that none is empty
    field = rf"(?s){mark}([ \t]*{q}(?:[^{q}]++|{q}{q})*+{q}(?:(?!{mark}).)*+|(?:(?!{mark}).)*+)"

    def plain(part: Column) -> Column:
        trimmed = F.trim(part)
        is_quoted = trimmed.startswith(quote) & trimmed.endswith(quote) & (F.length(trimmed) >= 2)
        inner = F.replace(F.substring(trimmed, F.lit(2), F.length(trimmed) - 2), F.lit(quote * 2), F.lit(quote))
        return F.when(is_quoted, inner).when(trimmed != "", trimmed)

    return F.transform(F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(field), 1), plain)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body).getItem(0)


_FLAT_OBJECT = r"(?s)\s*\{[^{}\[\]]*\}\s*"
_FLAT_ARRAY = r"(?s)\s*\[[^\[\]]*\]\s*"


#: brackets in brackets that JSON text may have; what is nested deeper counts as never closed
JSON_DEPTH = 64
_STRING = r'"(?:[^"\\]++|\\.)*+"'


def _nested(depth: int) -> str:
    """A pattern for a bracket with all that belongs to it. Nothing in it can backtrack, so it takes linear time."""
    pattern = ""
    for _ in range(depth):
        pattern = rf"[\[{{](?:[^\[\]{{}}\"]++|{_STRING}{'|' if pattern else ''}{pattern})*+[\]}}]"
    return pattern


_CLOSED = _nested(JSON_DEPTH)
# a closed bracket; one never closed, with all behind it; what stands between; a stray sign, with all behind it
_TOP = rf"(?s)({_CLOSED}|[\[{{].*+|(?:[^\[\]{{}}\"]++|{_STRING})++|.++)"
_ELEMENT = rf"(?s)((?:[^,\[\]{{}}\"]++|{_STRING}|{_CLOSED}|[\[{{\]}}\"].*+)++)"


def json_values(text: Column) -> Column:
    """The records in JSON text: top-level objects, and the elements of top-level arrays, in order.

    A payload of one object, of one array without arrays in it, or of one flat object per line is
    cut at once; any other by its brackets, in time proportional to its length.
    """
    lines = F.filter(F.split(text, "\r?\n"), lambda line: F.trim(line) != "")
    single = text.rlike(f"^{_FLAT_OBJECT}$")
    listed = F.when(text.rlike(f"^{_FLAT_ARRAY}$"), F.from_json(text, "array<string>"))
    by_line = _bound(lines, lambda x: F.when(F.forall(x, lambda line: line.rlike(f"^{_FLAT_OBJECT}$")), x))
    return F.when(F.trim(text) == "", F.array().cast("array<string>")).otherwise(
        F.when(single, F.array(text)).otherwise(F.coalesce(listed, by_line, _by_brackets(text)))
    )


def _by_brackets(text: Column) -> Column:
    """Top-level pieces, arrays among them cut into elements; a bracket that is never closed is an error behind them."""

    def cut(piece: Column) -> Column:
        inner = F.regexp_replace(piece, r"(?s)^\[(.*?)\]?$", "$1")
        return F.when(piece.startswith("["), F.regexp_extract_all(inner, F.lit(_ELEMENT), 1)).otherwise(F.array(piece))

    def values(pieces: Column) -> Column:
        last = F.element_at(pieces, -1)
        opened = last.rlike(r"^[\[{]") & ~last.rlike(rf"(?s)^{_CLOSED}$")
        found = F.flatten(F.transform(pieces, cut))
        return F.when(opened, F.array_append(found, F.lit("["))).otherwise(found)

    found = _bound(F.regexp_extract_all(text, F.lit(_TOP), 1), values)
    return F.filter(found, lambda piece: F.trim(F.regexp_replace(piece, r"\s+", " ")) != "")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _read_avro(data: Column, fields: T.StructType, options: dict[str, str] | None) -> Column:
    """One record per payload, by Spark's own Avro module; Spark says so if it is not loaded.

    ``options`` must hold the writer's ``schema`` as JSON text.
    """
    extra = dict(options or {})
    record = from_avro(data, extra.pop("schema"), {"mode": "PERMISSIVE", **extra})
    names = [record[f.name].cast(f.dataType).alias(f.name) for f in fields.fields]
    unread = F.when(record.isNull(), F.base64(data))
    return F.when(F.octet_length(data) > 0, F.array(F.struct(*names, unread.alias(CORRUPT))))


def first_bad(records: Column) -> Column:
    """Position of the first malformed record counting from 1; 0 when there is none."""
    return F.coalesce(F.array_position(F.transform(records, lambda r: r[CORRUPT].isNotNull()), True), F.lit(0))


def good_prefix(records: Column, bad: Column) -> Column:
    """The records before the first malformed one: what a reader hands over before it stops."""
    return F.when(bad > 0, F.slice(records, F.lit(1), (bad - 1).cast("int"))).otherwise(records)


def without_corrupt(record: Column) -> Column:
    return record.dropFields(CORRUPT)


def serialize(record: Column, fmt: str | Callable[[Column], Column], options: dict[str, str] | None = None) -> Column:
    """One record as the writer puts it into a payload: a JSON object, a CSV line, or Avro bytes.

    ``options`` are the writer's: delimiter (``sep``), quoting (``quoteAll``, ``quote``), the text
    for nulls (``nullValue``) and so on for CSV, ``schema`` for Avro. Without ``nullValue`` a null
    and an empty text are written alike in CSV.
    """
    wanted = dict(options or {})
    if callable(fmt):
        return fmt(record)
    if fmt == "json":
        return F.to_json(record, wanted)
    if fmt == "csv":
        return F.concat(F.to_csv(record, {**_CSV_WRITING, **wanted}), F.lit(_LINE_END))
    if fmt == "avro":
        return to_avro(record, wanted.get("schema", ""))
    raise ValueError(f"unknown record format {fmt!r}; use json, csv, avro or a function")


def csv_header(names: list[str], options: dict[str, str] | None = None) -> str:
    """The header line the CSV writer would put before records of these fields."""
    wanted = {**_CSV_WRITING, **(options or {})}
    quote = wanted["quote"]
    quoted = [f"{quote}{n.replace(quote, quote * 2)}{quote}" if wanted["quoteAll"] == "true" else n for n in names]
    return wanted.get("sep", wanted.get("delimiter", ",")).join(quoted) + _LINE_END
