"""Joining a log to a table of per-partition state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
_SALTS = 64


def left_lookup(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread: str = "off",
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = _SALTS,
) -> DataFrame:
    """Left join to a table with one row per ``on``, whatever share of rows one key holds.

    The table is counted up to ``broadcast_rows``; within that bound it is broadcast and the
    log stays where it is. Beyond it, each table row is repeated once per salt and the rows
    of a key spread over as many tasks.
    """
    if table.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return df.join(F.broadcast(table), list(on), "left")
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return salted.join(repeated, [*on, "_salt"], "left").drop("_salt")
