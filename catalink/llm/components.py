"""Pairwise links to groups: connected components over any number of links.

Union-find runs inside bounded edge partitions and each keeps only a spanning
forest, written as stars (node, root). Forests are merged by re-partitioning
them on their nodes: all edges of a node meet in one bounded partition, where
its roots are united again. Roots that were united elsewhere are followed by
one join a round, so chains of roots halve each time. A hub of very many links
keeps one edge for each edge partition, since stars are keyed by their leaves.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.sources.tables import staged


def union_find(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and, for each, the smallest node linked to it.

    Hooks roots onto smaller roots and halves the paths until nothing moves.
    """
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return nodes, nodes[root]


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stars (node, root) of one partition's edges; memory holds its forest only.

    ``moved`` marks nodes that came in as roots and got a smaller one.
    """
    u, v, roots = (np.empty(0, np.int64) for _ in range(3))
    more: list[pd.DataFrame] = []
    waiting = 0
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            more.append(batch)
            waiting += len(batch)
            # as many new edges as the forest has, so all uniting together is n log n
            if waiting < max(100_000, len(u)):
                continue
        if not waiting:
            continue
        new = pd.concat(more)
        more, waiting = [], 0
        roots = np.union1d(roots, new["root"].to_numpy(np.int64))
        nodes, found = union_find(np.concatenate([u, new["node"].to_numpy(np.int64)]), np.concatenate([v, new["root"].to_numpy(np.int64)]))
        keep = nodes != found
        u, v = nodes[keep], found[keep]
    for k in range(0, len(u), 100_000):
        part = u[k : k + 100_000]
        yield pd.DataFrame({"node": part, "root": v[k : k + 100_000], "moved": np.isin(part, roots)})


STAR = "node long, root long, moved boolean"


def components(edges: DataFrame, src: str, dst: str, max_edges: int = 1_000_000, max_rounds: int = 60) -> DataFrame:
    """``node``, ``component``: the smallest node linked to it, directly or not.

    One row per node that stands in an edge between two different nodes or in
    a loop. Edges with a null end are no links, repeated edges count once, an
    empty table gives no rows, other columns are ignored. ``max_edges`` bounds
    the edges of one partition; the number of partitions follows from it.
    """
    links = edges.select(F.col(src).cast("long").alias("node"), F.col(dst).cast("long").alias("root")).where("node is not null and root is not null")
    loops = staged(links.where("node = root").select("node").distinct(), "loops")
    stars = staged(links.where("node <> root").mapInPandas(_forest, STAR), "forest")
    for _ in range(max_rounds):
        parts = max(1, -(-stars.count() // max_edges))
        stars = staged(stars.select("node", "root").repartition(parts, "node").mapInPandas(_forest, STAR), "forest")
        if parts == 1:
            break
        # roots that point on themselves: follow them; nodes united away from
        # their own partition stand twice and meet there next round
        roots = stars.select("root").distinct()
        on = staged(stars.join(roots.withColumnRenamed("root", "node"), "node", "left_semi").groupBy("node").agg(F.min("root").alias("_next")), "roots")
        if on.isEmpty() and stars.where("moved").isEmpty():
            break
        stars = staged(stars.join(on.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("_next", "root").alias("root")), "followed")
    else:
        raise RuntimeError("the components did not settle")
    member = stars.select("node", F.col("root").alias("component"))
    tops = member.select(F.col("component").alias("node")).distinct().union(loops.join(member, "node", "left_anti")).distinct()
    return member.unionByName(tops.select("node", F.col("node").alias("component")))


def encoded(kind: int, key: Column) -> Column:
    """One number space for several tables: keys below 2**60, kind 0 smallest."""
    return F.lit(kind << 60).cast("long") + key.cast("long")
