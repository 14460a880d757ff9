"""Frequency boards and top-k rankings.

All top-k results use a total order (value, then a key) so that LIMIT keeps
the same rows on every run; Spark plans ``ORDER BY ... LIMIT k`` as a
per-partition top-k followed by a merge of k rows per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawhouse.functions.labels import PITCH_CLASSES, decode_code
from rawhouse.operators.percentile import percentiles
from rawhouse.session import materialize


def label_frequency(
    df: DataFrame,
    code: str,
    labels: Sequence[str] = PITCH_CLASSES,
    count_name: str = "track_number",
    label_name: str = "key",
) -> DataFrame:
    """Row count per raw code, decoded.  Codes outside the label list (and
    NULL) each keep their own 'Unknown' row, as grouping is on the code."""
    g = df.groupBy(code).agg(F.count(F.lit(1)).alias(count_name))
    return g.select(count_name, decode_code(code, labels).alias(label_name))


def tag_frequency(
    df: DataFrame,
    tags: str,
    k: int = 20,
    count_name: str = "artist_number",
    tag_name: str = "genre",
) -> DataFrame:
    """Entities per tag over non-empty tag lists, top ``k`` (ties by tag)."""
    exploded = df.where(F.col(tags).isNotNull() & (F.size(tags) > 0)).select(F.explode(tags).alias(tag_name))
    g = exploded.groupBy(tag_name).agg(F.count(F.lit(1)).alias(count_name))
    return g.orderBy(F.col(count_name).desc(), F.col(tag_name)).limit(k).select(count_name, tag_name)


def percentile_board(
    df: DataFrame,
    by: str,
    value: str,
    ps: dict[str, float] | None = None,
    k: int = 20,
    max_name: str = "popularity",
    method: str = "exact",
) -> DataFrame:
    """Max and exact percentiles of ``value`` per ``by``, top ``k`` by max
    (ties by ``by``).

    The ranking only needs the max, so the top ``k`` groups are chosen first
    and the percentiles are computed for the rows of those ``k`` groups only
    (a ``k``-row broadcast: its size is bounded by ``k``).  The two columns are
    written once, so the joins behind ``df`` run once.
    """
    ps = ps or {"popularity90": 0.9, "popularity50": 0.5}
    rows = materialize(df.select(F.col(by), F.col(value)), "board-input")
    mx = rows.groupBy(by).agg(F.max(value).alias(max_name))
    top = materialize(mx.orderBy(F.col(max_name).desc_nulls_last(), F.col(by)).limit(k), "board-top")
    chosen = F.broadcast(top.select(F.col(by).alias("_top")))
    mine = rows.join(chosen, rows[by].eqNullSafe(chosen["_top"])).drop("_top")
    pc = percentiles(mine, [by], [(name, value, p) for name, p in ps.items()], method, stored=True)
    board = top.join(pc, top[by].eqNullSafe(pc[by])).select(top[by], max_name, *[pc[n] for n in ps])
    return board.select(max_name, *ps, by)
