"""Connected components by alternating large-star and small-star.

Both steps are one minimum per node and one join back, so a node with very many
neighbours is reduced before the shuffle and its join side can be split at
runtime. Every round is checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.session import cut_lineage


#: Edges that one task works on: small graphs don't pay for many partitions.
EDGES_PER_TASK = 200_000


def _relink(sides: DataFrame, lowest: DataFrame) -> DataFrame:
    """Point the larger neighbours ``v`` of ``u`` to the lowest node around ``u``."""
    return sides.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def large_star(edges: DataFrame) -> DataFrame:
    """May repeat edges; ``small_star`` removes the copies."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _relink(both.where("v > u"), lowest)


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    near = _relink(down, lowest)
    return near.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> tuple[int, bool]:
    """Number of edges, and whether they are stars: every node either has one
    edge to a smaller node and none from larger ones, or only the latter."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    row = nodes.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()
    return row[0], row[1] == 0


def _sized(edges: DataFrame, count: int) -> DataFrame:
    return edges.coalesce(max(1, -(-count // EDGES_PER_TASK)))


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for every node of
    ``edges`` other than roots themselves. Nulls and loops are no edges."""
    now = (edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
           .select("u", "v").distinct())
    now = cut_lineage(now)
    for _ in range(max_rounds):
        count, settled = _settled(now)
        if settled:
            return _sized(now, count).select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = cut_lineage(_sized(small_star(_sized(large_star(_sized(now, count)), count)), count))
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
