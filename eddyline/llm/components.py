"""Connected components of a graph given as an edge table: union-find inside each partition, then large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.session import cut


def _local_roots(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the edges of one partition, whose size Spark bounds: every node with the smallest node it reaches here."""
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for part in parts:
        for u, v in zip(part["u"], part["v"], strict=True):
            a, b = root(bytes(u)), root(bytes(v))
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    yield pd.DataFrame({"u": nodes, "v": [root(x) for x in nodes]})


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with v < u. Large: link larger neighbours to the smallest; small: link smaller ones.

    A node's smallest neighbour is a map-side aggregate that joins back, so a node with any number of neighbours is split like
    any skewed join.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    linked = both.join(least, "u")
    if large:
        moved = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        moved = linked.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(linked.select("u", F.col("least").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v: binary, u <> v): the smallest node of its component.

    Every step is written, so lineage stays short; the number of steps grows with the logarithm of the longest path.
    """
    found = cut(edges.mapInPandas(_local_roots, "u binary, v binary").distinct(), "roots")
    mark = None
    while True:
        new = found.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
        if not new[0]:
            break
        found = cut(_stars(cut(_stars(found, large=True), "large"), large=False), "small")
    inner = found.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return inner.unionByName(found.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
