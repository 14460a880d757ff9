"""End-to-end build jobs: raw folders -> warehouse tables.

``build_equity_warehouse`` reads ``profile/`` (one key,value text file per
entity), ``history/`` (one price CSV per entity, named ``CODE_*.csv``) and a
``Tweet.csv`` of post lines; it writes ``industry``, ``profile``, ``history``
(partitioned by year) and ``tweets``.  ``build_music_warehouse`` reads two
overlapping track CSVs and an artist-genre CSV; it writes ``artist``,
``track_artists`` and ``track``.  ``build_artist_measures`` derives
``artist_measure``, ``build_artist_clusters`` the two cluster tables.  Every step is one of the library's operators; bad input
rows go to ``<table>_quarantine`` tables instead of being dropped or kept.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawhouse.functions.text import ISO_TS_FORMAT, POST_TS_FORMAT, reciprocal_fill
from rawhouse.operators import entity as ent
from rawhouse.operators import graph as gr
from rawhouse.operators import ml
from rawhouse.operators import model as mdl
from rawhouse.operators import parse as prs
from rawhouse.session import materialize
from rawhouse.sources import files, sinks

# Zero-based line of each field in a raw profile file.
PROFILE_FIELDS = {
    "code": 1, "company_name": 9, "currency": 10, "country": 21, "state": 26, "city": 25,
    "sector": 20, "industry": 16, "exchange": 14, "exchange_code": 15, "description": 18,
    "ceo": 19, "address": 24, "ipo_date": 31,
}

# Columns of a raw price file, by position.
PRICE_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()), T.StructField("volume", T.DoubleType()),
    T.StructField("dividends", T.DoubleType()), T.StructField("stock splits", T.DoubleType()),
])

_D, _I, _S, _B = T.DoubleType(), T.IntegerType(), T.StringType(), T.BooleanType()

# Header columns of the larger track file.
TRACKS_A_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("id", _S), ("name", _S), ("album", _S), ("album_id", _S), ("artists", _S), ("artist_ids", _S),
    ("track_number", _I), ("disc_number", _I), ("explicit", _B), ("danceability", _D), ("energy", _D),
    ("key", _I), ("loudness", _D), ("mode", _I), ("speechiness", _D), ("acousticness", _D),
    ("instrumentalness", _D), ("liveness", _D), ("valence", _D), ("tempo", _D), ("duration_ms", _I),
    ("time_signature", _D), ("year", _I), ("release_date", T.DateType()),
]])

# Header columns of the smaller track file.
TRACKS_B_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("acousticness", _D), ("artists", _S), ("danceability", _D), ("duration_ms", _I), ("energy", _D),
    ("explicit", _I), ("id", _S), ("instrumentalness", _D), ("key", _I), ("liveness", _D),
    ("loudness", _D), ("mode", _I), ("name", _S), ("popularity", _I), ("release_date", T.DateType()),
    ("speechiness", _D), ("tempo", _D), ("valence", _D), ("year", _I),
]])


def _save(spark: SparkSession, df: DataFrame, name: str, database: str | None, mode: str, fmt: str,
          partition_by: tuple[str, ...] = ()) -> str:
    full = f"{database}.{name}" if database else name
    sinks.save_table(df, full, fmt=fmt, mode=mode, partition_by=partition_by)
    return full


def build_equity_warehouse(
    spark: SparkSession,
    data_dir: str,
    database: str | None = None,
    mode: str = "error",
    fmt: str = "parquet",
) -> dict[str, str]:
    """Raw equity folders -> ``industry``, ``profile``, ``history``, ``tweets``
    (+ quarantine tables).  Returns the written table names."""
    if database:
        sinks.ensure_schema(spark, database)
    raw = files.read_whole_files(spark, os.path.join(data_dir, "profile"))
    prof = prs.clean_profile(prs.parse_kv_profile(raw, PROFILE_FIELDS))
    sector, industry = reciprocal_fill("sector", "industry")
    prof = materialize(prof.withColumns({"sector": sector, "industry": industry}))
    industries = mdl.build_dictionary(prof, "sector", "industry", index_col="id")
    normalized = mdl.normalize(prof, industries, ["sector", "industry"], "id")
    profile = normalized.select(
        *[F.col(c).alias(f"p_{c}") for c in (
            "code", "company_name", "currency", "description", "ceo", "address", "ipo_date",
            "exchange", "exchange_code", "country", "state", "city")],
        F.col("id").alias("p_industry_id"),
    )
    history = files.read_entity_csvs(
        spark, os.path.join(data_dir, "history"), PRICE_SCHEMA, key_col="h_code", prefix="h_"
    )
    tweets = prs.parse_posts(
        files.read_lines(spark, os.path.join(data_dir, "Tweet.csv")), ts_formats=(POST_TS_FORMAT, ISO_TS_FORMAT)
    )
    out = {
        "industry": _save(spark, industries.select("sector", "industry", "id"), "industry", database, mode, fmt),
        "profile": _save(spark, profile, "profile", database, mode, fmt),
        "history": _save(spark, history.good.withColumn("h_year", F.year("h_date")), "history",
                         database, mode, fmt, ("h_year",)),
        "history_quarantine": _save(spark, history.quarantine, "history_quarantine", database, mode, fmt),
        "tweets": _save(spark, tweets, "tweets", database, mode, fmt),
    }
    return out


def build_music_warehouse(
    spark: SparkSession,
    data_dir: str,
    database: str | None = None,
    mode: str = "error",
    fmt: str = "parquet",
) -> dict[str, str]:
    """Raw track and genre CSVs -> ``artist``, ``track_artists``, ``track``
    (+ quarantine tables).  Returns the written table names."""
    if database:
        sinks.ensure_schema(spark, database)
    small = files.read_csv_audited(spark, os.path.join(data_dir, "data.csv"), TRACKS_B_SCHEMA,
                                   bool_flags=("mode", "explicit"))
    large = files.read_csv_audited(spark, os.path.join(data_dir, "tracks_features.csv"), TRACKS_A_SCHEMA,
                                   bool_flags=("mode",))
    tracks = materialize(mdl.merge_sources(small.good, large.good, "id", ["name"]))
    genres = files.read_csv_strings(spark, os.path.join(data_dir, "data_w_genres.csv"))
    artist, bridge = mdl.build_dimension_from_texts(tracks, genres)
    track = mdl.prefixed(tracks.drop("artists", "artist_ids"), "t_")
    return {
        "artist": _save(spark, artist, "artist", database, mode, fmt),
        "track_artists": _save(spark, bridge, "track_artists", database, mode, fmt),
        "track": _save(spark, track, "track", database, mode, fmt),
        "track_quarantine": _save(spark, small.quarantine.unionByName(large.quarantine, allowMissingColumns=True),
                                  "track_quarantine", database, mode, fmt),
    }


def build_artist_measures(
    spark: SparkSession,
    database: str | None = None,
    rebuild: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """``artist_measure`` from the music tables, built once (``rebuild`` to redo)."""
    name = f"{database}.artist_measure" if database else "artist_measure"

    def build() -> DataFrame:
        t = (lambda n: spark.table(f"{database}.{n}" if database else n))
        return ent.entity_measures(ent.entity_facts(t("track"), t("track_artists"), t("artist")))

    return sinks.ensure_table(spark, name, build, fmt=fmt, rebuild=rebuild)


def build_artist_clusters(
    spark: SparkSession,
    database: str | None = None,
    k: int = 100,
    seed: int = 1,
    rebuild: bool = False,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """``artist_cluster_features`` (clusters of the artists' measures) and
    ``artist_cluster_features_smoothed`` (of the measures averaged over
    collaborators), each built once (``rebuild`` to redo)."""
    t = (lambda n: f"{database}.{n}" if database else n)
    measures = build_artist_measures(spark, database, fmt=fmt)
    columns = {c: c for c in measures.columns if c != "a_id"}

    def plain() -> DataFrame:
        return ml.cluster(measures, "a_id", k=k, seed=seed)

    def smoothed() -> DataFrame:
        bridge = spark.table(t("track_artists"))
        return ml.cluster(gr.smooth_features(bridge, measures, "a_id", columns, out_key="a_id"), "a_id", k=k, seed=seed)

    return {
        name: sinks.ensure_table(spark, t(name), build, fmt=fmt, rebuild=rebuild)
        for name, build in (("artist_cluster_features", plain), ("artist_cluster_features_smoothed", smoothed))
    }


def main(argv: list[str] | None = None) -> None:
    """``spark-submit rawhouse/plans/warehouse.py {equity,music,measures,clusters} [DATA_DIR] [--database DB]``"""
    import argparse

    from rawhouse.session import build_session

    ap = argparse.ArgumentParser(description="Build warehouse tables from raw folders.")
    ap.add_argument("job", choices=["equity", "music", "measures", "clusters"])
    ap.add_argument("data_dir", nargs="?", help="raw folder (equity / music jobs)")
    ap.add_argument("--database", default=None)
    ap.add_argument("--mode", default="error", help="error | overwrite | ignore | append")
    ap.add_argument("--format", default="parquet")
    args = ap.parse_args(argv)
    spark = build_session(app_name=f"rawhouse-{args.job}")
    if args.job == "measures":
        build_artist_measures(spark, args.database, rebuild=args.mode == "overwrite", fmt=args.format)
        return
    if args.job == "clusters":
        build_artist_clusters(spark, args.database, rebuild=args.mode == "overwrite", fmt=args.format)
        return
    if not args.data_dir:
        ap.error("data_dir is required for this job")
    build = build_equity_warehouse if args.job == "equity" else build_music_warehouse
    for name in build(spark, args.data_dir, args.database, args.mode, args.format).values():
        print(name)


if __name__ == "__main__":
    main()
