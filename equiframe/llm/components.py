"""Connected components by alternating large-star and small-star rounds.

Each round rewires edges toward smaller nodes and ends in a written table;
rounds go on until the edge set no longer changes, when every edge points from
a node to the smallest node of its component.  Minima are aggregated before
the shuffle, so a node with very many neighbours is no hot task there; its
edges are spread over (node, salt) in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiframe.llm.shared import stored

SALTS = 8


def _with_least(pairs: DataFrame, own: bool) -> DataFrame:
    """(u, v, m): every pair with the least neighbour of u, or u if less."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    if own:
        least = least.withColumn("m", F.least("u", "m"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least, ["u", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, own=True).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    near = _with_least(edges, own=False)  # u > v in every edge
    moved = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(near.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that is not the least
    of its component; root is.  Loops, NULLs and repeated edges don't matter."""
    tidy = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = stored(tidy, "edges"), None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        now = stored(_small_star(stored(_large_star(now).distinct(), "edges")).distinct(), "edges")
