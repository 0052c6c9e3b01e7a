"""Connected components of a link table by alternating large-star and small-star steps.

Each step is one aggregate and one join on the node; a node with very many
neighbours is pre-aggregated and its join partition split.  Every step is a
written table, so a lost executor repeats one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("u", "m"))


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not its component's smallest."""
    edges = materialise(links.where("a <> b").select("a", "b").distinct(), name)
    seen = None
    for _ in range(rounds):
        edges = materialise(_small_star(_large_star(edges).distinct()).where("a <> b").distinct(), name)
        now = _print(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
