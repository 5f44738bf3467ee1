"""Mapping specs: ``dest[=src],...`` compiled to Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

STRING_MAP = "map<string,string>"


def empty_map() -> Column:
    return F.create_map().cast(STRING_MAP)


def parse_mapping(spec: str | None) -> dict[str, list[str]]:
    """Destination -> sources, in spec order.

    Names keep their blanks, only the first ``=`` separates, a blank source means the
    destination's own name and a blank destination is skipped. A destination listed more
    than once keeps all of its sources, since a later one counts only if it has a value.
    """
    targets: dict[str, list[str]] = {}
    if spec is None or not spec.strip():
        return targets
    for entry in spec.split(","):
        dest, _, source = entry.partition("=")
        if dest.strip():
            targets.setdefault(dest, []).append(source if source.strip() else dest)
    return targets


def mapped_columns(spec: str | None, lookup: Callable[[str], Column]) -> dict[str, Column]:
    """One nullable Column per destination; the last source that has a value wins."""
    return {
        dest: F.coalesce(*[lookup(source) for source in reversed(sources)])
        for dest, sources in parse_mapping(spec).items()
    }


def map_of(columns: dict[str, Column]) -> Column:
    """A string map of the columns, leaving out those that are null."""
    if not columns:
        return empty_map()
    built = F.map_from_arrays(
        F.array(*[F.lit(name) for name in columns]),
        F.array(*[value.cast("string") for value in columns.values()]),
    )
    return F.map_filter(built, lambda _, value: value.isNotNull())
