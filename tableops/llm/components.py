"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: each hangs the neighbours of a node under the
smallest of them, until every node hangs under the smallest node of its component. All steps are
joins and grouped minima over edges; labels are minima that combine before the shuffle, and a
node with very many edges is only a skewed join, which adaptive execution splits. Each round is
written to the shared folder, so lineage stays short and lost executors repeat one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, written


def _hung(pairs: DataFrame, under: str) -> DataFrame:
    """Each `v` of the pairs (u, v) on `under` side of u, and u, under the least of u's group."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m")
    )
    joined = pairs.join(least, F.col("u") == F.col("w"))
    if under == "larger":
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select(F.col("w").alias("u"), F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node it is linked to.

    Nodes are longs. Null ends and loops are ignored; repeated edges and no edges are fine.
    """
    down = edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    state = written(down.distinct(), "edges")
    for _ in range(max_rounds):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hung(both, "larger").where("u <> v").distinct()
        small = _hung(large, "smaller").where("u <> v").distinct()
        after = written(small, "edges")
        forget(state)
        state = after
        # done when each hangs under one root: no node is both child and parent, or child of two
        parents = state.select(F.col("v").alias("p")).distinct()
        if state.join(parents, F.col("u") == F.col("p"), "left_semi").take(1):
            continue
        ends = state.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"))
        if not ends.where("least <> most").take(1):
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
