"""Single-entity lookups and per-entity facts in a fact - bridge - dimension star.

Target lookups filter the dimension to the target first; the filtered side
is tiny, and Spark turns the join into a broadcast join only after it has
measured it (AQE runtime statistics), falling back to a shuffle join if the
"target" matches more rows than the broadcast threshold allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawhouse.functions.labels import decode_code, flag_label
from rawhouse.operators.percentile import percentiles
from rawhouse.session import materialize


def entity_card(
    entities: DataFrame,
    categories: DataFrame,
    key: str,
    target,
    cat_fk: str,
    cat_key: str,
    columns: Sequence[Column | str],
) -> DataFrame:
    """The target entity's row joined to its category row."""
    me = entities.where(F.col(key) == F.lit(target))
    return me.join(categories, me[cat_fk] == categories[cat_key]).select(*columns)


def attribute_peers(
    df: DataFrame,
    key: str,
    attr: str,
    target,
    exclude: Sequence[str] = ("None",),
    extra: Sequence[str] = (),
) -> DataFrame:
    """Other entities sharing ``attr`` with the target: (me, peer, attr, extra...).

    NULL and sentinel values (``exclude``) of the attribute never match.
    """
    valid = F.col(attr).isNotNull()
    if exclude:
        valid = valid & ~F.col(attr).cast("string").isin(*exclude)
    me = df.where(valid & (F.col(key) == F.lit(target))).select(
        F.col(key).alias("me"), F.col(attr).alias("_attr")
    )
    others = df.where(valid & (F.col(key) != F.lit(target))).select(
        F.col(key).alias("peer"), F.col(attr), *extra
    )
    return me.join(others, me["_attr"] == others[attr]).select("me", "peer", attr, *extra)


def entity_facts(
    facts: DataFrame,
    bridge: DataFrame,
    dim: DataFrame,
    fact_key: str = "t_id",
    bridge_fact: str = "track_id",
    bridge_dim: str = "artist_id",
    dim_key: str = "a_id",
) -> DataFrame:
    """``facts JOIN bridge JOIN dim`` (all inner): one row per (fact, entity)."""
    fb = bridge.join(facts, bridge[bridge_fact] == facts[fact_key])
    return fb.join(dim, fb[bridge_dim] == dim[dim_key])


def target_facts(
    facts: DataFrame,
    bridge: DataFrame,
    dim: DataFrame,
    name_col: str,
    target: str,
    **keys,
) -> DataFrame:
    """Facts of the entity named ``target`` (the dimension is filtered first)."""
    return entity_facts(facts, bridge, dim.where(F.col(name_col) == F.lit(target)), **keys)


def entity_stats(tf: DataFrame, approx: bool = False) -> DataFrame:
    """Count, distinct albums, first/last release and mean popularity
    (``approx``: HyperLogLog++ distinct count instead of the exact one)."""
    distinct = F.approx_count_distinct("t_album_id") if approx else F.count_distinct("t_album_id")
    return tf.agg(
        F.count(F.lit(1)).alias("track_number"),
        distinct.alias("album_number"),
        F.min("t_release_date").alias("first_release"),
        F.max("t_release_date").alias("last_release"),
        F.avg("t_popularity").alias("avg_popularity"),
    )


def top_items(tf: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` facts by popularity (ties by id) with decoded labels."""
    top = tf.orderBy(F.col("t_popularity").desc(), F.col("t_id")).limit(k)
    return top.select(
        F.col("t_name").alias("name"),
        decode_code("t_key").alias("key"),
        flag_label("t_mode").alias("music_mode"),
        F.col("t_year").alias("year"),
        F.col("t_release_date").alias("release_date"),
        F.col("t_album").alias("album"),
        F.col("t_track_number").alias("track_number"),
        F.col("t_disc_number").alias("disc_number"),
        (F.col("t_duration_ms") / F.lit(1000)).alias("duration_seconds"),
    )


def group_sums(df: DataFrame, by: str, cols: dict[str, str], out_by: str | None = None) -> DataFrame:
    """Sum of each column per group; ``cols`` maps output name -> input column."""
    return df.groupBy(F.col(by).alias(out_by or by)).agg(
        *[F.sum(c).alias(name) for name, c in cols.items()]
    )


# The measure columns of an entity and their input columns.
MEASURES = {
    "a_acousticness": "t_acousticness",
    "a_danceability": "t_danceability",
    "a_energy": "t_energy",
    "a_loudness": "t_loudness",
    "a_speechiness": "t_speechiness",
    "a_instrumentalness": "t_instrumentalness",
    "a_liveness": "t_liveness",
    "a_valence": "t_valence",
    "a_tempo": "t_tempo",
}


def entity_measures(
    ef: DataFrame,
    key: str = "a_id",
    item: str = "t_id",
    flag: str = "t_mode",
    measures: dict[str, str] = MEASURES,
    method: str = "exact",
) -> DataFrame:
    """Per entity: item count, share of flagged items (NULL counts as not
    flagged) and the exact median of each measure (``method='approx'``: the
    mergeable ``percentile_approx`` sketch in a single aggregation).

    The needed columns of ``ef`` are written once (the star joins behind them
    run once); counts and medians read those files, so a hot entity is combined
    on the map side in every pass.
    """
    base = [
        F.count(item).alias("a_track_number"),
        F.avg(F.when(F.col(flag), 1).otherwise(0)).alias("a_mode"),
    ]
    if method == "approx":
        return ef.groupBy(key).agg(*base, *[
            F.percentile_approx(F.col(c).cast("double"), 0.5).alias(o) for o, c in measures.items()
        ])
    rows = materialize(ef.select(key, item, flag, *dict.fromkeys(measures.values())), "entity-facts")
    counts = rows.groupBy(key).agg(*base)
    meds = percentiles(rows, [key], [(o, c, 0.5) for o, c in measures.items()], method, stored=True)
    return counts.join(meds, counts[key].eqNullSafe(meds[key])).select(
        counts[key], "a_track_number", "a_mode", *[meds[o] for o in measures]
    )


def cluster_peers(
    dim: DataFrame,
    clusters: DataFrame,
    name_col: str,
    target: str,
    key: str = "a_id",
    tags: str = "genres",
) -> DataFrame:
    """Entities in the target's cluster (target excluded) sharing at least one
    tag with the target: ``(key)``.  The target side is one row."""
    tgt = dim.where(F.col(name_col) == F.lit(target)).select(
        F.col(key).alias("_tid"), F.col(tags).alias("_ttags")
    )
    tcl = tgt.join(clusters, tgt["_tid"] == clusters[key]).select(
        "_tid", "_ttags", F.col("prediction").alias("_pred")
    )
    peers = clusters.join(tcl, (clusters["prediction"] == tcl["_pred"]) & (clusters[key] != tcl["_tid"])).select(
        F.col(key).alias("_cand"), "_ttags"
    )
    cand = peers.join(dim, peers["_cand"] == dim[key]).where(F.arrays_overlap(F.col(tags), F.col("_ttags")))
    return cand.select(F.col("_cand").alias(key))


def similar_entities(
    dim: DataFrame,
    peers: DataFrame,
    measures: DataFrame,
    name_col: str,
    k: int = 10,
    key: str = "a_id",
    tags: str = "genres",
) -> DataFrame:
    """The peers (keys, as :func:`cluster_peers` gives them) with their measures,
    top ``k`` by item count (ties by name)."""
    out = dim.join(peers, key, "left_semi").join(measures, key)
    return out.orderBy(F.col("a_track_number").desc(), F.col(name_col)).limit(k).select(
        F.col(name_col).alias("artist_name"),
        F.col(tags).alias("genres"),
        F.col("a_track_number").alias("track_number"),
        F.col("a_mode").alias("modality"),
        *[F.col(m).alias(m[2:]) for m in MEASURES],
    )
