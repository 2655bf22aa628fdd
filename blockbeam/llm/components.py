"""Connected components of a graph given as edges, in DataFrame joins.

Alternating large-star and small-star steps: every node links its larger neighbours to its smallest
one, then its smaller ones to the smallest, until the graph is one star around each component's
smallest node. Each step is an aggregate and an equi-join, so a hub is split by the skew join; the edges
never grow in number, and each round is staged in the shared folder.
"""

from __future__ import annotations

import pyarrow as pa
import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import stage


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the smallest node."""
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = stage(e, name)
    now = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), name)
        before, now = now, _state(e)
        if now == before:
            break
    own = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)


class Sets:
    """Disjoint sets of 0..n-1, the smallest member in front."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, x: int, y: int) -> None:
        a, b = self.of[x], self.of[y]
        if a != b:
            self.of[self.of == max(a, b)] = min(a, b)


def star(sets: Sets, names: np.ndarray) -> pa.RecordBatch:
    """Edges (a, b) from each member to its set's front."""
    far = np.flatnonzero(sets.of != np.arange(len(sets.of)))
    return pa.RecordBatch.from_arrays([pa.array(names[far], pa.int64()), pa.array(names[sets.of[far]], pa.int64())], names=["a", "b"])
