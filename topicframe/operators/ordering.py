"""Running totals over a log of any length without a task per log.

A window over a whole (topic, part) would sort it in one task. Here the offsets are cut into
spans, and the row-level window runs inside one span. What was reached before a span comes from
totals of spans, of groups of 65 536 spans, of groups of those, and so on over all bits an offset
can have. So no window holds more than 65 536 totals or ``span`` rows of a log, whether offsets
are dense or as sparse as hashes. Nothing depends on how rows happen to be partitioned, so a lost
executor recomputes the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# three levels of 65 536 above it reach over all bits of an offset
DEFAULT_SPAN = 32768
_FAN = 65536


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    value: Column,
    name: str,
    ties: Sequence[str] = (),
    span: int = DEFAULT_SPAN,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one, per ``by``.

    ``order`` is a non-negative whole number; a row without one raises, as it has no place in
    the order. ``ties`` order rows that share it. With ``order`` unique per ``by`` a span holds
    at most ``span`` rows. A row without a value in ``by`` raises too.
    """
    return _running(df, by, order, value.cast("bigint"), name, ties, span, _SUM)


def running_max(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    value: Column,
    name: str,
    ties: Sequence[str] = (),
    span: int = DEFAULT_SPAN,
) -> DataFrame:
    """Add ``name``: the greatest ``value`` of the rows before this one, per ``by``; null if there is none."""
    return _running(df, by, order, value, name, ties, span, _MAX)


class _How(NamedTuple):
    """How values of earlier rows come together, and how two such results do."""

    of: Callable[[str], Column]
    both: Callable[[Column, Column], Column]


_SUM = _How(F.sum, lambda a, b: a + F.coalesce(b, F.lit(0)))
_MAX = _How(F.max, F.greatest)


def _running(df: DataFrame, by: Sequence[str], order: str, value: Column, name: str, ties: Sequence[str], span: int, how: _How) -> DataFrame:
    # rows are sorted by these columns in turn; a topic's name is slowest to compare
    keys = list(reversed(by))

    def missing(name: str) -> Column:
        return F.raise_error(F.lit(f"a row without {name} cannot be put in order")).cast(df.schema[name].dataType)

    # the keys themselves raise: the join below would drop a null before anything else could see it
    df = df.withColumns({k: F.coalesce(F.col(k), missing(k)) for k in keys if df.schema[k].nullable})
    place = F.when(F.col(order).isNull(), missing(order).cast("bigint")).otherwise(F.expr(f"`{order}` div {span}"))
    cut = df.withColumn("_value", value).withColumn("_span", place)
    in_span = Window.partitionBy("_span", *keys).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.join(_span_starts(cut, keys, span, how), ["_span", *keys])
        .withColumn(name, how.both(F.col("_start"), how.of("_value").over(in_span)))
        .drop("_value", "_span", "_start")
    )


def ordinal(
    df: DataFrame,
    by: Sequence[str],
    order: str = "off",
    name: str = "ordinal",
    ties: Sequence[str] = (),
    span: int = DEFAULT_SPAN,
) -> DataFrame:
    """Add ``name``: the row's position per ``by``, counting from 0 without gaps."""
    return running_total(df, by, order, F.lit(1), name, ties, span)


def _levels(span: int) -> list[str]:
    """Names of the groupings: spans, groups of spans, groups of groups, up to the whole log."""
    rest, names = (1 << 63) // span, ["_span"]
    while rest > _FAN:
        rest //= _FAN
        names.append(f"_group{len(names)}")
    return names


def _span_starts(cut: DataFrame, keys: list[str], span: int, how: _How) -> DataFrame:
    """What was reached before each span, as (keys, _span, _start)."""
    names = _levels(span)
    grouped = cut
    for i, name in enumerate(names[1:], 1):
        grouped = grouped.withColumn(name, F.expr(f"_span div {_FAN**i}"))
    # the joins below drop null groups; saying so here keeps the uses of each level identical,
    # so its scan and shuffle are done once and reused
    grouped = grouped.where(" and ".join(f"{n} is not null" for n in names))
    level = grouped.groupBy(*names, *keys).agg(how.of("_value").alias("_total"))
    levels = [level]
    for i in range(1, len(names)):
        levels.append(levels[-1].groupBy(*names[i:], *keys).agg(how.of("_total").alias("_total")))
    starts = None
    for i in reversed(range(len(names))):
        within = Window.partitionBy(*names[i + 1 : i + 2], *keys).orderBy(names[i])
        before = how.of("_total").over(within.rowsBetween(Window.unboundedPreceding, -1))
        before = F.coalesce(before, F.lit(0)) if how is _SUM else before
        inner = levels[i].select(*names[i : i + 2], *keys, before.alias("_inner"))
        if starts is None:
            starts = inner.withColumnRenamed("_inner", "_start")
        else:
            joined = inner.join(starts.select(names[i + 1], *keys, F.col("_start").alias("_outer")), [names[i + 1], *keys])
            starts = joined.select(names[i], *keys, how.both(F.col("_outer"), F.col("_inner")).alias("_start"))
    return starts
