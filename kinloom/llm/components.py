"""Connected components by randomised contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.session import staged


def local_labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 of one task the smallest node each can reach over edges u-v."""
    labels = np.arange(n)
    while len(u):
        low = np.minimum(labels[u], labels[v])
        np.minimum.at(labels, labels[u], low)
        np.minimum.at(labels, labels[v], low)
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up
        open_ = labels[u] != labels[v]
        u, v = u[open_], v[open_]
    return labels


def connected(edges: DataFrame) -> DataFrame:
    """``node, label`` for every end of ``edges (a long, b long)``; one label per component.

    In each round every node joins the neighbour with the least hash (or stays, if its
    own is the least) and the edges are contracted, which removes a constant share of the
    nodes whatever their shape. Minima are combined before they are shuffled, parallel
    edges are merged, and each round is written to the shared folder, so that nothing is
    recomputed from the start when an executor is lost. Nothing reaches the driver but
    whether edges are left.
    """
    left = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds = []
    while not left.isEmpty():
        seed = F.lit(len(rounds))
        both = left.union(left.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", seed).alias("h"), F.col("b").alias("n"))).alias("m"))
        own = F.struct(F.xxhash64("a", seed).alias("h"), F.col("a").alias("n"))
        merged = staged(nearest.select(F.col("a").alias("node"), F.least(F.col("m"), own)["n"].alias("label")), "merged")
        rounds.append(merged)
        left = staged(
            left.join(merged.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
            .join(merged.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "edges",
        )
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = rounds.pop()
    while rounds:
        after = labels.select(F.col("node").alias("label"), F.col("label").alias("last"))
        labels = rounds.pop().join(after, "label", "left").select("node", F.coalesce("last", "label").alias("label"))
    return labels
