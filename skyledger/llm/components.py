"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.shared import materialize

JUMPS = 2

# Links of a task that are contracted together.
CHUNK = 1 << 20

EDGES = "a long, b long"


def smallest_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of some links and the smallest node that each of them reaches by these."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    top = np.arange(len(nodes))
    while len(x):
        np.minimum.at(top, np.maximum(x, y), np.minimum(x, y))
        while (top[top] != top).any():
            top = top[top]
        x, y = top[x], top[y]
        x, y = x[x != y], y[x != y]
    return nodes, nodes[top]


def _stars(edges: DataFrame) -> DataFrame:
    """Links ``a < b`` that connect what ``edges`` do: within a chunk each node with the smallest that it reaches there.

    Tasks are sized by what they hold, so a small table is one chunk.
    """

    def contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            if size >= CHUNK:
                yield star(held)
                held, size = [], 0
        if held:
            yield star(held)

    def star(held: list[pd.DataFrame]) -> pd.DataFrame:
        whole = pd.concat(held, ignore_index=True)
        nodes, top = smallest_reachable(whole["a"].to_numpy(np.int64), whole["b"].to_numpy(np.int64))
        return pd.DataFrame({"a": top[top < nodes], "b": nodes[top < nodes]})

    return edges.select("a", "b").hint("rebalance").mapInPandas(contract, EDGES)


def _nearest(stars: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself, and the largest that could be meant: node, parent, largest."""
    tops = stars.select(F.col("b").alias("node"), F.col("a").alias("top")).union(stars.select("a", "a"))
    return tops.groupBy("node").agg(F.min("top").alias("parent"), F.max("top").alias("largest"))


def _followed(parents: DataFrame) -> DataFrame:
    """Parents followed a few steps further: node, parent."""
    for _ in range(JUMPS):
        step = parents.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        parents = parents.join(step, "parent", "left").select("node", F.coalesce("next", "parent").alias("parent"))
    return parents


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges`` (``a, b``, not equal).

    Each round first contracts the edges task by task. Where no node is left with two smaller ones, these are the
    components, so a table that fits one task takes one round. Else the round hooks every node to its smallest
    neighbour and replaces the nodes of the edges by what they hang on; edges within a component vanish.
    Parents are never larger than their nodes, so there are no cycles, and every component that has an edge
    left loses at least half of its nodes. The rounds are at most about the logarithm of the longest path.
    Tables of a round are written to the shared folder.
    """
    result: DataFrame | None = None
    while True:
        stars = materialize(_stars(edges), "edges")
        nearest = materialize(_nearest(stars), "nearest")
        whole = nearest.filter("parent <> largest").isEmpty()
        parents = nearest.select("node", "parent") if whole else materialize(_followed(nearest.select("node", "parent")), "parents")
        if result is None:
            result = parents.select("node", F.col("parent").alias("component"))
        else:
            step = parents.select(F.col("node").alias("component"), F.col("parent").alias("next"))
            result = result.join(step, "component", "left")
            result = materialize(result.select("node", F.coalesce("next", "component").alias("component")), "components")
        if whole:
            return result
        to_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        to_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = stars.join(to_a, "a").join(to_b, "b").filter(F.col("pa") != F.col("pb"))
        edges = moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()


def united(labels: DataFrame, later: DataFrame) -> DataFrame:
    """``labels`` carried on by ``later``, the components of labels and of nodes without one; written."""
    step = later.select(F.col("node").alias("component"), F.col("component").alias("up"))
    moved = labels.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
    return materialize(moved.union(later.join(labels, "node", "left_anti")), "labels")
