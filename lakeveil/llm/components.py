"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeveil.sources.workspace import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes in ``edges`` (a, b); a component is named by its smallest node.

    Every round takes the smallest name among the neighbours and then the name's own name, so
    chains shrink geometrically. Rounds are stored tables. Sums over a node's edges combine before the
    shuffle, and joins on a node with many edges are split by adaptive execution.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "edges")
    names = both.groupBy("a").agg(F.min("b").alias("least"))
    names = stored(names.select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "names")
    while True:
        near = both.join(names.hint("merge"), F.col("b") == F.col("node"))
        near = near.groupBy("a").agg(F.min("component").alias("near"))
        new = names.join(near.hint("merge"), F.col("node") == F.col("a"))
        new = new.select("node", F.col("component").alias("old"), F.least("component", "near").alias("next"))
        jump = names.select(F.col("node").alias("n"), F.col("component").alias("jumped"))
        new = new.join(jump.hint("merge"), F.col("next") == F.col("n"))
        new = new.select("node", "old", F.least("next", "jumped").alias("component"))
        new = stored(new, "names")
        names = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return names
