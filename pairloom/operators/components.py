"""Connected components of a graph given as edges, and splits that keep components whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import store
from .joins import attach


def _pointed(edges: DataFrame, *, all_neighbours: bool) -> DataFrame:
    """One round: every neighbour v of a node u is tied to the least of u and its neighbours.

    With ``all_neighbours`` the larger neighbours of u are tied, which shortens long paths; without, the
    smaller ones and u itself, which joins what is left. A node with many neighbours is served by broadcast of its least.
    """
    if all_neighbours:
        sides = edges.select(F.col("u"), F.col("v")).unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    tied = attach(sides, least, ["u"], weight="n", spread=["v"], how="inner")
    if all_neighbours:
        out = tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, *, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its least node.

    Rounds of tying neighbours to the least node around them, until nothing changes; their number grows with
    the logarithm of the longest path. Every round is written, so a lost executor repeats one round at most. Edges with a
    null end are left out; an edge from a node to itself makes it a node.
    """
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    nodes = store(ends.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "graph-nodes")
    state = store(ends.filter("u <> v").distinct(), "graph-edges")
    mark = None
    for _ in range(max_rounds):
        tied = store(_pointed(state, all_neighbours=True), "graph-round")
        state = store(_pointed(tied, all_neighbours=False), "graph-round")
        now = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    found = nodes.join(state.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left")
    return found.select("node", F.coalesce("component", "node").alias("component"))


def component_split(pairs: DataFrame, *, a: str, b: str, every: int = 10, last: int = 9) -> DataFrame:
    """``pairs`` with the component of their ends and a split: ``valid1`` for components whose name leaves ``last`` modulo ``every``, else ``train``.

    Pairs that share an end, directly or through others, are on one side, so no document is seen on both. A pair with a
    null end has no component and goes to ``train``.
    """
    named = components(pairs, a=a, b=b).select(F.col("node").alias(a), "component")
    sizes = pairs.groupBy(a).agg(F.count(F.lit(1)).alias("__n"))
    weighed = named.join(sizes, a, "left").na.fill(0, ["__n"])
    out = attach(pairs, weighed, [a], weight="__n", spread=[b])
    return out.withColumn("split", F.when(F.pmod("component", F.lit(every)) == last, "valid1").otherwise("train"))
