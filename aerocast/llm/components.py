"""Connected components of a link table, as distributed joins.

Each round hooks every node to its smallest neighbour where that is smaller,
follows the hooks to their roots and replaces nodes by roots; links inside a root
vanish. Every root that keeps a link has swallowed at least one node, so the
nodes left at least halve each round, and the last root of a component is its smallest node.
Tables are written to the shared folder between rounds: joins then read plain tables,
which lets Spark split the links of a node that has very many, and a lost
executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for each node that has a link.

    Links are undirected; self links, repeated links and links with a null end change nothing.
    An empty table gives an empty result.
    """
    edges = stage_table(links.where(F.col(a) != F.col(b))
                        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
    found = None
    while True:
        ends = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                 F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")
        hook = edges.select(ends).select(F.col("e.u").alias("node"), "e.v").groupBy("node").agg(F.min("v").alias("v"))
        roots = _roots(stage_table(hook.select("node", F.least("node", "v").alias("root")), "hooks"))
        if found is None:
            found = roots
        else:
            nxt = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = stage_table(found.join(nxt, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stage_table(edges.join(ra, "a").join(rb, "b").where("ra != rb")
                            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return found.select("node", F.col("root").alias("component"))


def _roots(hooks: DataFrame) -> DataFrame:
    """Follow node -> root until every root is its own; each pass doubles the distance followed."""
    while True:
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
        step = stage_table(hooks.join(up, "root").select("node", "root", "up"), "hooks")
        hooks = step.select("node", F.col("up").alias("root"))
        if step.where("up != root").isEmpty():
            return hooks
