"""Co-occurrence graph statistics without materialising pairs.

The co-occurrence graph links every two nodes that share a group (artists on
the same track), self-loops included, one edge per shared group.  Its edge
list is quadratic in the group size, so it is never built.  Everything the
toolkit reports about the graph is a sum over a node's edges, and a sum over
the edges of node ``x`` equals a sum over the groups ``g`` containing ``x``
of a per-group total:

    sum over edges (x, y) of f(y)  =  sum over g containing x of  sum over y in g of f(y)

So each statistic costs two linear passes: a per-group aggregate (partial
aggregation, so a hot group costs one row per map task) and a join of the
bridge rows to their group's aggregate, then a per-node aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cooccurrence_degree(bridge: DataFrame, group: str = "track_id", node: str = "artist_id") -> DataFrame:
    """Per node: ``n_edges`` (co-occurrence edges with multiplicity,
    self-loops included) and ``n_groups`` (bridge rows of the node)."""
    b = bridge.select(group, node).where(F.col(group).isNotNull())
    sizes = b.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    j = b.join(sizes, group)
    return j.groupBy(node).agg(
        F.sum("_size").alias("n_edges"),
        F.count(F.lit(1)).alias("n_groups"),
    )


def smooth_features(
    bridge: DataFrame,
    features: DataFrame,
    feature_key: str,
    columns: Mapping[str, str],
    group: str = "track_id",
    node: str = "artist_id",
    out_key: str = "node",
) -> DataFrame:
    """Mean of each feature over a node's co-occurrence neighbours (itself
    included, weighted by the number of shared groups).

    Neighbours without a feature row are not counted; NULL feature values
    are skipped per feature.  A node with no other neighbour keeps its own
    features.  ``columns`` maps output name -> feature column.
    """
    b = bridge.select(group, node).where(F.col(group).isNotNull())
    f = features.select(
        F.col(feature_key).alias("_fk"), *[F.col(c).alias(f"_x{i}") for i, c in enumerate(columns.values())]
    )
    members = b.join(f, b[node] == f["_fk"])
    n = len(columns)
    per_group = members.groupBy(group).agg(
        *[F.sum(f"_x{i}").alias(f"_s{i}") for i in range(n)],
        *[F.count(f"_x{i}").alias(f"_c{i}") for i in range(n)],
    )
    j = b.join(per_group, group)
    return j.groupBy(F.col(node).alias(out_key)).agg(
        *[F.try_divide(F.sum(f"_s{i}"), F.sum(f"_c{i}")).alias(name) for i, name in enumerate(columns)]
    )
