"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.session import shared_dir


def connected(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``u, v``: long); the label is the component's least node.

    Large-star and small-star rounds (public MapReduce algorithm) replace each
    edge by one to a smaller neighbour until all are stars.  Every round is
    checkpointed; joins on a star's centre are left to AQE's skew handling.
    """
    shared_dir(edges.sparkSession)
    now = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))).distinct().checkpoint())
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each of ``n`` nodes' component under the edges (a[i], b[i])."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            up = new[new]
            if (up == new).all():
                break
            new = up
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which edges (a[i], b[i]) join parts of ``n`` nodes that those before them leave apart: a forest."""
    root, out = list(range(n)), []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(i)
    return np.array(out, np.int64)
