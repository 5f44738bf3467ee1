"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import hold


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    around = _both_ways(edges)
    least = hold(around.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m")), "least")
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = hold(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(u, root) for every vertex of edges (u, v) that is not the least of its component.

    Each round is written to the shared folder, so lineage stays short and a lost executor costs
    one round. A vertex with very many links only ever meets a minimum and a join.
    """
    edges = hold(edges.select("u", "v").where("u <> v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = hold(_small_star(hold(_large_star(edges), "large")), "small")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select("u", F.col("v").alias("root"))
