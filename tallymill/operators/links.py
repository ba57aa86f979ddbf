"""Degrees and neighbours in a directed graph given as an edge table (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _degree(edges: DataFrame, node: str, neighbour: str) -> DataFrame:
    """Distinct neighbours per node, highest first.

    Edges are made distinct on both ends before they are counted per node, so a hub is
    spread over all tasks until only partial counts of it are left.
    """
    pairs = edges.select(node, neighbour).where(F.col(neighbour).isNotNull()).distinct()
    return pairs.groupBy(node).agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), node)


def out_degree(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(src, degree): distinct targets; nodes without out-links are absent."""
    return _degree(edges, src, dst)


def in_degree(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(dst, degree): distinct sources; nodes without in-links are absent."""
    return _degree(edges, dst, src)


def node_links(edges: DataFrame, node, src: str = "src", dst: str = "dst") -> DataFrame:
    """(direction, neighbour) of one node from a single scan, repeated links kept.

    A link of the node to itself is both an out-link and an in-link.
    """
    out = F.when(F.col(src) == node, F.struct(F.lit("out").alias("direction"), F.col(dst).alias("neighbour")))
    into = F.when(F.col(dst) == node, F.struct(F.lit("in").alias("direction"), F.col(src).alias("neighbour")))
    touching = edges.where((F.col(src) == node) | (F.col(dst) == node))
    return touching.select(F.inline(F.array_compact(F.array(out, into))))


def graph_nodes(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node): every id that occurs at either end of an edge, from a single scan."""
    return edges.select(F.explode(F.array(src, dst)).alias("node")).distinct()
