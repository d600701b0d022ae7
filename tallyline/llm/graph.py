"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import stored


def _ends(edges: DataFrame) -> DataFrame:
    """Every edge from both of its ends."""
    return edges.union(edges.select("b", "a"))


def _least_ends(edges: DataFrame) -> DataFrame:
    """``a``, the least (``m``) of it and its neighbours, and its part in a star.

    ``down``: its lesser neighbours, 2 for more than one; ``up``: 1 if it has a greater one. Edges may repeat.
    """
    lesser = F.when(F.col("b") < F.col("a"), F.col("b"))
    ends = _ends(edges).groupBy("a").agg(
        F.min("b").alias("m"), F.min(lesser).alias("first"), F.max(lesser).alias("last"), F.max(F.col("b")).alias("top")
    )
    down = F.when(F.col("first").isNull(), 0).when(F.col("first") == F.col("last"), 1).otherwise(2)
    return ends.select("a", F.least("a", "m").alias("m"), down.alias("down"), F.when(F.col("top") > F.col("a"), 1).otherwise(0).alias("up"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component_id`` (the least id reachable) of every node that ``a`` and ``b`` name.

    Alternating large-star and small-star steps, each a join with the least neighbour of every
    node, until the edges are stars around the least node; edges that are stars already take no
    step. A node with very many edges is aggregated before the shuffle, and its join with the stored
    result can be split. Edges may repeat; those with a null end and loops are left out. Each step is
    a table in the shared folder, so a lost executor costs one step, and so is the result. The edges
    given are read twice, so they should be stored too.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        # The edges to the least neighbours: in stars, all that there are.
        least = stored(_least_ends(edges), "edges")
        # Stars: each node with a lesser neighbour has only that, and it has none.
        most = least.agg(F.max(F.when(F.col("down") > 0, F.col("down") + F.col("up"))).alias("most")).first()["most"]
        if most in (None, 1):
            return least.select(F.col("a").alias("id"), F.col("m").alias("component_id"))
        least = least.select("a", "m")
        large = _ends(edges).where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large, "edges")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least).distinct(), "edges")
