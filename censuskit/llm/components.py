"""Connected components of link tables, on DataFrames.

Links are contracted where they arise (``contract``, in numpy inside a task),
then large-star and small-star rounds join every node to the smallest node it
reaches. Each round is written to the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between values: each linked value and the smallest value of
    its component, without the smallest themselves."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, before[u], low)
        np.minimum.at(root, before[v], low)
        root = root[root]
        if (root == before).all():
            break
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (node, root), root < node."""
    both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    low = both.groupBy("node").agg(F.min("root").alias("low")).select("node", F.least("low", "node").alias("low"))
    large = both.where("root > node").join(low, "node").select(F.col("root").alias("node"), F.col("low").alias("root")).distinct()
    low = large.groupBy("node").agg(F.min("root").alias("low"))
    moved = large.join(low, "node").where("root != low").select(F.col("root").alias("node"), F.col("low").alias("root"))
    return moved.unionByName(low.select("node", F.col("low").alias("root"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches, itself excluded
    from the rows) of links ``(node, root)``, any direction. Links that are
    null or join a node with itself say nothing; no links, no rows."""
    edges = links.where("node is not null and root is not null and node != root").select(
        F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root")
    )
    edges = cut(edges.distinct(), "links")
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
    seen = mark(edges)
    while True:
        edges = cut(_stars(edges), "stars")
        now = mark(edges)
        if now == seen:
            return edges
        seen = now
