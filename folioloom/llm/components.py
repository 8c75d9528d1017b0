"""Connected components of a graph that may have any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, parts


EDGES = 500_000  # edges that one task contracts


def contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same components as a task's edges, with an edge from each node to its smallest node there."""
    held = [f for f in frames if len(f)]
    if not held:
        return
    nodes, ends = np.unique(pd.concat(held)[["a", "b"]].to_numpy(), return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    yield pd.DataFrame({"a": nodes[other], "b": nodes[label[other]]})


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for every node that has an edge.

    Tasks of a bounded number of edges each contract theirs. Over what is left of more than one task, large-star and
    small-star steps alternate; no step gathers a node's neighbours, so a hub costs no more than its edges. Each round
    is checkpointed. Stops when a round leaves the edges as they were.
    """
    edges = cut(edges.where("a is not null and b is not null and a <> b").select("a", "b"))
    tasks = parts(edges.count(), EDGES)
    now = cut(edges.repartition(tasks).mapInPandas(contract, "a long, b long").distinct())
    before = None
    while tasks > 1:  # one task alone has found all there is
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.union(now.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, both.a == low.u).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low"))
        small = down.join(low, down.a == low.u).select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("u", "low")).where("a <> b")
        now = cut(small.distinct())
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        now.select(F.col("b").alias("node")).distinct().join(now.select(F.col("a").alias("node")), "node", "left_anti").select("node", F.col("node").alias("component"))
    )
