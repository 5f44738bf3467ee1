"""Records by the schema that a message itself carries.

The schema is an Avro record schema as JSON text: named fields of a primitive type, an array, a map, a
record, an enumeration, or a union of one of them with null. It is parsed to a plain list of fields,
and a payload is then read by that list, field by field, so messages of one log may differ in schema.
Values are held as JSON tokens beside their plain text; a writer needs no more.

A schema text that is not JSON, no record, or has a field without a name or of an unknown type is no
schema. Nested values are checked for their shape (array, object) and carried whole. A field that
cannot be null must be there; fields that the schema does not name are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codecs
from .payload import bind

#: what a schema text becomes, for the columns of a lookup table
FIELDS = "array<struct<name:string,kind:string,nullable:boolean>>"

# fixed values: the primitive types of an Avro schema
_PRIMITIVES = ("null", "boolean", "int", "long", "float", "double", "bytes", "string")
_COMPLEX = {"array": "array", "map": "object", "record": "object", "enum": "string", "fixed": "bytes"}

_RECORD = "struct<entries:array<struct<name:string,value:string,token:string>>,_corrupt:string>"


def _one_kind(kind: Column) -> Column:
    """The kind of a type that is no union: a name, or an object that names it."""
    shape = F.schema_of_variant(kind)
    named = F.when(shape == "STRING", F.try_variant_get(kind, "$", "string")).when(shape.startswith("OBJECT"), F.try_variant_get(kind, "$.type", "string"))
    complex_kinds = F.create_map(*(F.lit(x) for pair in _COMPLEX.items() for x in pair))
    return bind(named, lambda n: F.when(n.isin(*_PRIMITIVES), n).when(shape != "STRING", complex_kinds[n]))


def _field(field: Column) -> Column:
    def known(kind: Column) -> Column:
        union = F.schema_of_variant(kind).startswith("ARRAY")
        branches = F.transform(F.try_variant_get(kind, "$", "array<variant>"), _one_kind)
        filled = F.filter(branches, lambda b: b.isNull() | (b != "null"))
        of_union = F.when(F.exists(branches, lambda b: b.isNull()) | (F.size(branches) == 0), None)
        of_union = of_union.when(F.size(filled) == 0, "null").when(F.size(filled) == 1, F.get(filled, F.lit(0))).otherwise("any")
        single = _one_kind(kind)
        return F.struct(
            F.try_variant_get(field, "$.name", "string").alias("name"),
            F.when(union, of_union).otherwise(single).alias("kind"),
            F.when(union, F.exists(branches, lambda b: b == "null")).otherwise(single == "null").alias("nullable"),
        )

    return bind(F.try_variant_get(field, "$.type", "variant"), known)


def fields_of(text: Column) -> Column:
    """The fields of a schema text in order, as FIELDS; null where it is no record schema."""

    def checked(fields: Column) -> Column:
        whole = F.forall(fields, lambda f: f["name"].isNotNull() & f["kind"].isNotNull())
        distinct = F.size(F.array_distinct(F.transform(fields, lambda f: f["name"]))) == F.size(fields)
        return F.when(whole & distinct, fields)

    def of(schema: Column) -> Column:
        listed = F.try_variant_get(schema, "$.fields", "array<variant>")
        is_record = F.try_variant_get(schema, "$.type", "string") == "record"
        return F.when(is_record, bind(F.transform(listed, _field), checked))

    return bind(F.try_parse_json(text), of).cast(FIELDS)


def key_of(text: Column) -> Column:
    """What a schema text is looked up by."""
    return F.unhex(F.sha2(text, 256))


_INT_LIMIT, _NUMBERS = 1 << 31, ("BIGINT", "DOUBLE", "FLOAT")


def _fits(kind: Column, value: Column, shape: Column) -> Column:
    """Whether a JSON value is one of the kind."""
    whole = shape == "BIGINT"
    number = shape.isin(*_NUMBERS) | shape.startswith("DECIMAL")
    as_long = F.try_variant_get(value, "$", "bigint")
    return (
        F.when(kind == "any", True)
        .when(kind.isin("string", "bytes"), shape == "STRING")
        .when(kind == "boolean", shape == "BOOLEAN")
        .when(kind == "int", whole & (as_long >= -_INT_LIMIT) & (as_long < _INT_LIMIT))
        .when(kind == "long", whole)
        .when(kind.isin("float", "double"), number)
        .when(kind == "array", shape.startswith("ARRAY"))
        .when(kind == "object", shape.startswith("OBJECT"))
        .otherwise(False)
    )


def quoted(text: Column) -> Column:
    """Text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _entry(field: Column, there: Column, fits: Column, value: Column, token: Column) -> Column:
    """(name, value, token, ok) of a field; a null has neither value nor token."""
    return F.struct(
        field["name"].alias("name"),
        F.when(there, value).alias("value"),
        F.when(there, token).alias("token"),
        F.when(there, fits).otherwise(field["nullable"]).alias("ok"),
    )


def _of_json(field: Column, members: Column) -> Column:
    def read(value: Column) -> Column:
        shape = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
        token = F.to_json(value)
        text = F.when(shape == "STRING", F.try_variant_get(value, "$", "string")).otherwise(token)
        return _entry(field, shape != "VOID", _fits(field["kind"], value, shape), text, token)

    return bind(F.try_element_at(members, field["name"]), read)


def _of_text(field: Column, part: Column) -> Column:
    kind = field["kind"]
    number = F.when(kind == "int", part.try_cast("int").cast("string")).when(kind == "long", part.try_cast("bigint").cast("string"))
    number = number.when(kind.isin("float", "double"), part.try_cast("double").cast("string"))
    number = number.when(kind == "boolean", F.when(F.lower(part).isin("true", "false"), F.lower(part)))
    is_text = kind.isin("string", "bytes", "any")

    def read(plain: Column) -> Column:
        token = F.when(is_text, quoted(part)).otherwise(plain)
        return _entry(field, part.isNotNull(), is_text | plain.isNotNull(), F.when(is_text, part).otherwise(plain), token)

    return bind(number, read)


def _record(text: Column, entries: Column, whole: Column) -> Column:
    """The record read from text; corrupt unless it is whole and all entries are well."""

    def made(found: Column) -> Column:
        well = F.coalesce(whole & F.forall(found, lambda e: F.coalesce(e["ok"], F.lit(False))), F.lit(False))
        return F.struct(
            F.transform(found, lambda e: F.struct(e["name"].alias("name"), e["value"].alias("value"), e["token"].alias("token"))).alias("entries"),
            F.when(~well, text).alias(codecs.CORRUPT),
        )

    return bind(entries, made)


def reader(fmt: str, options: dict[str, str] | None = None, fields: str = "_fields") -> Callable[[Column], Column]:
    """A record format that reads each payload by the fields in a column beside it; none where that is null."""
    settings = dict(options or {})
    of = F.col(fields)

    def of_json(text: Column) -> Column:
        def one(members: Column) -> Column:
            return _record(text, F.transform(of, lambda f: _of_json(f, members)), members.isNotNull())

        return bind(F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>"), one)

    def of_csv(line: Column) -> Column:
        def one(parts: Column) -> Column:
            entries = F.transform(of, lambda f, i: _of_text(f, F.get(parts, i)))
            return _record(line, entries, F.size(parts) == F.size(of))

        return bind(codecs.csv_parts(line, settings), one)

    def read(data: Column) -> Column:
        text = data.cast("string")
        if fmt == "json":
            records = F.transform(codecs.json_values(text), of_json)
        elif fmt == "csv":
            lines = codecs.csv_lines(text, settings)
            if str(settings.get("header", "false")).lower() == "true":
                lines = bind(lines, lambda x: F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))))
            records = F.transform(lines, of_csv)
        else:
            raise ValueError(f"messages with schemas of their own are read as csv or json, not {fmt!r}")
        return F.coalesce(F.when(of.isNotNull(), records), F.array()).cast(f"array<{_RECORD}>")

    return read


def writer(fmt: str, options: dict[str, str] | None = None) -> Callable[[Column], Column]:
    """The format's counterpart: nulls are left out of JSON, and are empty in CSV."""
    wanted = options or {}

    def of_json(record: Column) -> Column:
        filled = F.filter(record["entries"], lambda e: e["token"].isNotNull())
        return F.concat(F.lit("{"), F.array_join(F.transform(filled, lambda e: F.concat(quoted(e["name"]), F.lit(":"), e["token"])), ","), F.lit("}"))

    def of_csv(record: Column) -> Column:
        quote = wanted.get("quote", '"')
        cell = lambda e: F.concat(F.lit(quote), F.replace(F.coalesce(e["value"], F.lit("")), F.lit(quote), F.lit(quote * 2)), F.lit(quote))
        return F.concat(F.array_join(F.transform(record["entries"], cell), wanted.get("sep", ",")), F.lit("\n"))

    if fmt not in ("json", "csv"):
        raise ValueError(f"messages with schemas of their own are written as csv or json, not {fmt!r}")
    return of_json if fmt == "json" else of_csv
