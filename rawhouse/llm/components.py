"""Distributed connected components by alternating large-star and small-star steps.

An edge list shrinks to stars whose centre is the smallest node of each
component (Kiveris et al., "Connected Components in MapReduce and Beyond").
Every step is a minimum per node (combined before the shuffle) and a join of
the edges to it, so no neighbour list is ever gathered; a hub's edges are split
by the skew join.  Each round is written to the shared checkpoint folder and
read back, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawhouse.session import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (a, b) with a > b; returns the same shape.

    large: every larger neighbour of a node is linked to the smallest node the
    node knows.  small: every smaller neighbour, and the node itself.
    """
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return out.where("a <> b").distinct()
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    spread = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return spread.union(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge list of longs; ``component``
    is the smallest node reachable.  Loops and repeated edges do no harm; edges
    with a null end are ignored; no edges give no rows."""
    now = materialize(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
        .where("x IS NOT NULL AND y IS NOT NULL AND a <> b")
        .select("a", "b")
        .distinct(),
        "components",
    )
    mark = None
    while True:
        # Stars are unchanged by both steps, so an equal count and hash sum ends it.
        got = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()
        if tuple(got) == mark:
            break
        mark = tuple(got)
        shrunk = materialize(_star(_star(now, large=True), large=False), "components")
        discard(now)
        now = shrunk
    centres = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (index of the smallest member) after joining i and j.

    Labels are followed to their roots before each round and only roots are
    hooked, so no earlier join is undone; a pair is done once its roots are equal.
    """
    while True:
        while not np.array_equal(label, up := label[label]):
            label = up
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j = i[apart], j[apart]
        label = label.copy()
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])


__all__ = ["connected_components", "merge_labels"]
