"""Connected components by hooking and pointer jumping, each round cut in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut


def jumped(parents: DataFrame) -> DataFrame:
    """Pointer jumping: (node, root) in which roots may themselves be nodes -> the same with each root final."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("above")).where("root <> above")
        parents = cut(parents.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        if parents.where("moved").isEmpty():
            return parents.select("node", "root")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of ``edges`` (u, v): root is the component's smallest node. Null ends are ignored; an edge
    from a node to itself only names the node.

    Each round replaces the edges by edges between roots, hooks every root to its smallest neighbour and jumps pointers, so
    that long chains need few rounds. A star's hub is spread by aggregation with map-side combine.
    """
    edges = edges.select("u", "v").where("u is not null and v is not null")
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    live = cut(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    parents = cut(nodes.select("node", F.col("node").alias("root")))
    while not live.isEmpty():
        # Every root points at its smallest neighbour if that is smaller, so no cycles arise.
        hook = live.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root"))
        tops = live.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        moves = jumped(tops.join(hook, "node", "left").select("node", F.coalesce("root", "node").alias("root")))
        parents = cut(parents.join(moves.select(F.col("node").alias("root"), F.col("root").alias("above")), "root", "left").select("node", F.coalesce("above", "root").alias("root")))
        to = moves.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        live = live.join(to, "u").join(to.select(F.col("u").alias("v"), F.col("ru").alias("rv")), "v").where("ru <> rv")
        live = cut(live.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct())
    return parents
