"""Connected components of a large edge table by alternating stars.

Each round points all neighbours of a node to the smallest one (large star),
then all smaller neighbours (small star); edges end as one star per component.
Minima are pre-aggregated and joined back, so no neighbour list is gathered.
Every round is a written table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b): every node that is not the smallest of its component, with the
    smallest. ``edges`` has the long columns a and b in any direction."""
    now, seen = written(edges.where("a <> b"), "edges"), None
    for _ in range(rounds):
        now = written(_small_star(_large_star(now)), "stars")
        mark = tuple(now.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            return now
        seen = mark
    raise RuntimeError("components did not settle")
