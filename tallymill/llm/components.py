"""Connected components over links, as joins and aggregates that never gather a component in one place."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallymill.session import written_table


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each component of ``0..n-1`` under the links (a[i], b[i])."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(root, before) and np.array_equal(root[a], root[b]):
            return root


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is the smallest node it reaches.

    Alternates large-star and small-star steps until nothing changes. A step replaces the
    links of a node by links to its smallest neighbour, so no step makes more links than there
    were. Minima are aggregated before they are joined back, and a node with very many links
    is a skewed join key, which adaptive execution splits. Every round is written to the
    shared folder: a lost executor costs one round at most.
    """
    now = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = written_table(now, name)
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written_table(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written_table(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(now.select(F.col("u").alias("node"), F.col("v").alias("root")))
