"""Attributes a consumer gives to its bundles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .mapping import empty_map, map_of, mapped_columns


def message_lookup(source: str) -> Column:
    """A mapping source on a message: the key for the reserved name, else a property."""
    return F.col("key") if source == C.KEY_SOURCE else F.col("properties").getItem(source)


def mapped_values(spec: str | None) -> dict[str, Column]:
    """The mapped attributes as plain columns; cheaper than a map where only equality counts."""
    return mapped_columns(spec, message_lookup)


def mapped(spec: str | None) -> Column:
    """The attributes a mapping spec asks for, from message key and properties."""
    return map_of(mapped_values(spec))


def message_id(value: Column | str = "message_id") -> Column:
    return map_of({C.MESSAGE_ID_ATTRIBUTE: F.col(value) if isinstance(value, str) else value})


def prefixed_properties(properties: Column | str = "properties") -> Column:
    """Every message property under the automatic prefix; no properties, no entries."""
    renamed = F.transform_keys(properties, lambda name, _: F.concat(F.lit(C.PROPERTY_PREFIX), name))
    return F.coalesce(renamed, empty_map())


def topic() -> Column:
    return map_of({C.TOPIC_ATTRIBUTE: F.col("topic")})


def schema_text() -> Column:
    """The schema text where the topic's schema type carries one, else null."""
    return F.when(F.col("schema_type") == C.SELF_DESCRIBING_SCHEMA_TYPE, F.col("schema_def"))


def schema() -> Column:
    return map_of({C.SCHEMA_ATTRIBUTE: schema_text()})


def merge(*maps: Column) -> Column:
    """Union of maps in which a later map's value replaces an earlier one's."""
    result = None
    for each in maps:
        whole = F.coalesce(each, empty_map())
        result = (
            whole
            if result is None
            else F.map_zip_with(result, whole, lambda _, old, new: F.coalesce(new, old))
        )
    return empty_map() if result is None else result


def automatic(spec: str | None, records: bool = False) -> Column:
    """All attributes of a message in precedence order.

    The record consumer adds topic and schema to what the raw consumer has.
    """
    parts = [mapped(spec), message_id(), prefixed_properties()]
    if records:
        parts += [topic(), schema()]
    return merge(*parts)


def entries(attributes: Column) -> Column:
    """A map in a comparable form; maps themselves have no equality."""
    return F.array_sort(F.map_entries(attributes))


def as_text(attributes: Column) -> Column:
    """``name=value`` pairs in name order, joined by ``;``, for reports."""
    return F.array_join(
        F.transform(entries(attributes), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))),
        ";",
    )
