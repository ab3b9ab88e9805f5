"""Connected components, and links found through shared keys without listing all pairs of a key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import release, store

#: Keys with more members than this are compared in blocks inside tasks.
FEW = 32
BLOCK = 384


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame, *, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); root is the component's smallest node.

    Alternating large-star and small-star steps: each replaces edges by edges to
    the smallest neighbour, so the edge count never grows, and the rounds grow
    with the logarithm of the longest path. Each round is a written table.
    A neighbourhood is only ever reduced to a minimum and joined back, so a
    node with very many edges is not gathered anywhere. Self loops and repeated
    edges are allowed; no edges give an empty table.
    """
    edges = edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).filter("u <> v")
    edges = store(edges.select("u", "v").distinct(), "edges")
    seen = _checksum(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # edges (u, v) with v < u: the larger end of each keeps its smallest neighbour
        large = store(large.distinct(), "large-star")
        release(edges)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(low)
        edges = store(small.distinct(), "small-star")
        release(large)
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def labelled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Add ``label`` to ``nodes`` (column node): the component's smallest node, or the node itself."""
    return nodes.join(components(edges), "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")


def linked_by_keys(
    postings: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    sets: Callable[[DataFrame], DataFrame],
    linked: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    payload: DataFrame | None = None,
    alike: Callable[[np.ndarray, list[np.ndarray]], np.ndarray] | None = None,
) -> DataFrame:
    """Links (a, b) that join up all nodes which share a key and are confirmed by ``verify``.

    ``postings`` is (key, node), distinct; ``verify`` takes pairs (a, b) and keeps the
    true links. ``sets`` takes nodes and gives their full sets (node, members array<bigint>);
    ``linked(shared, x, y)`` is the exact test on sizes of intersections and sets. With ``payload`` (node, sketch array<bigint>), ``alike(x, ys)`` says which
    of the sketches ys are close enough to x for their pair to be worth verifying.

    First every member of a key is compared with the key's smallest member.
    Groups of near copies collapse into one component by that. Then only
    members of one key that are still in different components are compared:
    in short keys by a join. Long keys with members in common form a cluster, and all
    pairs of a cluster are compared on their full sets, block against block inside tasks,
    which give out only links that join up what was apart. Every pair that
    shares a key is either compared or already connected, so components are whole.
    """
    sized = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lead")).filter("n > 1")
    shared = store(postings.join(sized, "key"), "shared-keys")
    star = shared.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    links = store(verify(_close(star, payload, alike)), "star-links")

    labels = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    marked = (
        shared.join(labels, "node", "left")
        .select("key", "node", "lead", F.coalesce("root", "node").alias("label"))
    )
    mixed = (
        marked.groupBy("key")
        .agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.when(F.col("node") != F.col("lead"), 1)).alias("rest"))
        .filter("x <> y and rest > 1")
        .select("key", "rest")
    )
    # the lead has met every member already
    left = store(marked.join(mixed, "key").filter("node <> lead").select("key", "node", "label", "rest"), "open-keys")
    few = left.filter(F.col("rest") <= FEW)
    pairs = (
        few.select("key", F.col("node").alias("a"), F.col("label").alias("la"))
        .join(few.select("key", F.col("node").alias("b"), F.col("label").alias("lb")), "key")
        .filter("a < b and la <> lb")
        .select("a", "b")
        .distinct()
    )
    more = _close(pairs, payload, alike)
    many = left.filter(F.col("rest") > FEW)
    found = links.union(store(verify(more), "other-links"))
    if many.limit(1).count():
        found = found.union(store(_block_links(many, sets, linked), "block-links"))
    return found


def _close(pairs: DataFrame, payload: DataFrame | None, alike: Callable | None) -> DataFrame:
    """Pairs whose sketches are close enough."""
    if payload is None:
        return pairs
    left = payload.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = payload.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            ok = [bool(alike(np.asarray(x), [np.asarray(y)])[0]) for x, y in zip(rows["sa"], rows["sb"])]
            yield rows.loc[ok, ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").mapInPandas(keep, "a bigint, b bigint")


def _block_links(
    members: DataFrame,
    sets: Callable[[DataFrame], DataFrame],
    linked: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
) -> DataFrame:
    """Links among all nodes of each cluster of keys, as forests of the blocks compared.

    Nodes that share a key with others in different components form clusters; a cluster of m nodes is dealt into about
    m / BLOCK blocks, and every pair of blocks is one group, so no group holds more than about two blocks
    and gives out fewer rows than it has.
    """
    low = members.groupBy("key").agg(F.min("node").alias("v"))
    cluster = components(members.join(low, "key").select(F.col("node").alias("u"), "v"))
    sized = cluster.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = cluster.join(sized, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("root", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        own, node = rows["members"].tolist(), rows["node"].to_numpy()
        size = np.array([len(x) for x in own])
        value, at, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        several = (times > 1)[at]
        row, column = np.repeat(np.arange(len(own)), size)[several], (np.cumsum(times > 1) - 1)[at[several]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        shared = np.zeros((len(own), len(own)), np.float32)
        for c in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
            a, b = np.searchsorted(column, [c, c + 2048])
            part = np.zeros((len(own), 2048), np.float32)
            part[row[a:b], column[a:b] - c] = 1
            shared += part @ part.T
        alike = linked(shared.astype(np.int64), size[:, None], size[None, :])
        # a spanning forest: each newly reached node with the node that reached it
        left, a, b = np.ones(len(own), bool), [], []
        for start in range(len(own)):
            if not left[start]:
                continue
            left[start] = False
            front = [start]
            while front:
                k = front.pop()
                new = np.flatnonzero(alike[k] & left)
                left[new] = False
                front += new.tolist()
                a += [node[k]] * len(new)
                b += node[new].tolist()
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    full = sets(store(cluster.select("node"), "cluster-nodes"))
    return dealt.join(full, "node").groupBy("root", "i", "j").applyInPandas(compare, "a bigint, b bigint")
