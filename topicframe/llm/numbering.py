"""Rows in one global order: written range by range, and what stands before each range.

Rows are dealt out by ranges of their keys, sorted inside a range and written once with the range's
number and the place in it. What is before a range follows from one total a range. The totals are
summed in two levels, so no window holds more than ``FAN`` of them or one range. Keys should be all
columns of a row: then rows that cannot be told apart are equal, and a task that runs again after a
lost executor writes the same rows. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import hold

#: ranges that share a group of the two-level sums
FAN = 1024
_PLACE_BITS = (1 << 33) - 1


def laid_out(rows: DataFrame, keys: Sequence[str], number: int, label: str) -> DataFrame:
    """Rows stored in ascending order of keys, nulls first, with ``range_no`` and ``place`` (from 0 in its range)."""
    ordered = rows.repartitionByRange(number, *keys).sortWithinPartitions(*keys)
    # the low 33 bits of this id count a partition's rows
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS))
    return hold(ordered.select("*", F.spark_partition_id().alias("range_no"), place.alias("place")), label)


def before_ranges(laid: DataFrame, **sums: str) -> DataFrame:
    """(range_no, before_x, all_x) for each x = SQL expression: its sum over earlier ranges and over all rows."""
    totals = laid.groupBy("range_no").agg(*(F.sum(F.expr(e)).cast("bigint").alias(x) for x, e in sums.items()))
    totals = totals.withColumn("fan", F.expr(f"range_no div {FAN}"))
    earlier = lambda order, *by: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().orderBy("fan").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    groups = totals.groupBy("fan").agg(*(F.sum(x).alias(x) for x in sums))
    groups = groups.select(
        "fan",
        *(F.coalesce(F.sum(x).over(earlier("fan")), F.lit(0)).alias(f"outer_{x}") for x in sums),
        *(F.sum(x).over(whole).alias(f"all_{x}") for x in sums),
    )
    inner = totals.select("fan", "range_no", *(F.coalesce(F.sum(x).over(earlier("range_no", "fan")), F.lit(0)).alias(f"inner_{x}") for x in sums))
    return inner.join(groups, "fan").select(
        "range_no",
        *((F.col(f"outer_{x}") + F.col(f"inner_{x}")).alias(f"before_{x}") for x in sums),
        *(f"all_{x}" for x in sums),
    )
