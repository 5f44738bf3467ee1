"""How many parts a job is cut into, from the input's size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of stored input for one part; text files compress, so a part holds two to four times that in text.
PART_BYTES = 3 << 20
LEAST_PARTS = 48
_UNKNOWN = 1 << 55


def stored_bytes(df: DataFrame) -> int:
    """The size of the tables that df reads, as the planner knows it; else the size of its string columns.

    The plan's own estimate is not used: it guesses 20 bytes for a text.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    known = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if known < _UNKNOWN:
        return known
    total = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"), F.lit(16))
    return int(df.agg(F.sum(total).alias("n")).first()["n"] or 0)


def parts(df: DataFrame, part_bytes: int = PART_BYTES) -> int:
    return max(LEAST_PARTS, -(-stored_bytes(df) // part_bytes))


def dealt(number: int, *columns: str) -> Column:
    """The part a row belongs to, by the columns' hash alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(number)).cast("int")
