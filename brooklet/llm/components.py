"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
    least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "star")
    return both.join(least, "u").filter("v > u").selectExpr("v AS u", "m AS v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v")
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "star")
    moved = down.join(least, "u").filter("v > m").selectExpr("v AS u", "m AS v")
    return moved.unionByName(least.selectExpr("u", "m AS v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root, its component's smallest node, for every node of ``links`` (a, b).

    Each round two stars, each written: a lost executor costs a stage, not the rounds
    before. The rounds grow with the logarithm of the longest chain. A node with very
    many links meets its minimum in a join both of whose sides come from files, so
    Spark can split it.
    """
    edges = written(links.selectExpr("a AS u", "b AS v").filter("u <> v").distinct(), "edges")
    state = None
    while True:
        tally = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if tally == state or not tally[0]:
            return edges.selectExpr("u AS node", "v AS root").unionByName(
                edges.selectExpr("v AS node", "v AS root")
            ).distinct()
        state = tally
        edges = written(_large_star(edges), "edges")
        edges = written(_small_star(edges), "edges")
