"""The analysis statements over warehouse tables, by name.

One function per analysis statement of the two demo warehouses, reading the
tables :mod:`rawhouse.plans.warehouse` writes (``profile``, ``industry``,
``history``, ``tweets``; ``track``, ``artist``, ``track_artists``,
``artist_measure``).  Each only wires tables into the operators; parameters
are typed arguments, never spliced into SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawhouse.operators import entity as ent
from rawhouse.operators import ranking as rk
from rawhouse.operators import timeseries as ts


def _t(spark: SparkSession, database: str | None, name: str) -> DataFrame:
    return spark.table(f"{database}.{name}" if database else name)


def _history(spark: SparkSession, database: str | None, first: int, last: int) -> DataFrame:
    """Prices of some years.  The table is partitioned by year, so the other years'
    folders are not even listed for the scan."""
    return _t(spark, database, "history").where(F.col("h_year").between(first, last) & ts.year_range("h_date", first, last))


# ------------------------------------------------------------------ equity

def stock_info(spark: SparkSession, code: str, database: str | None = None) -> DataFrame:
    """Profile row of one entity with its sector and industry."""
    return ent.entity_card(
        _t(spark, database, "profile"), _t(spark, database, "industry"), "p_code", code, "p_industry_id", "id",
        [F.col("p_code").alias("stock"), F.col("p_company_name").alias("name"),
         F.col("p_currency").alias("currency"), F.col("p_ceo").alias("ceo"),
         F.col("p_ipo_date").alias("ipo_date"), F.col("p_exchange_code").alias("exchange"),
         F.col("p_country").alias("country"), "sector", "industry"],
    )


def close_vs_moving_average(spark: SparkSession, code: str, year: int, period: int,
                            database: str | None = None) -> DataFrame:
    """Close and its ``ROWS period PRECEDING`` mean for one entity in one year."""
    h = _history(spark, database, year, year).where(F.col("h_code") == code)
    return ts.moving_average(h, "h_code", "h_date", "h_close", period).select("h_date", "h_close", "moving_average")


def same_ceo(spark: SparkSession, code: str, database: str | None = None) -> DataFrame:
    """Other entities with the same CEO ('None' never matches)."""
    p = _t(spark, database, "profile")
    peers = ent.attribute_peers(p, "p_code", "p_ceo", code, extra=["p_ipo_date"])
    return peers.select("me", "peer", F.col("p_ceo").alias("ceo"), F.col("p_ipo_date").alias("peer_ipo_date"))


def top_volume(spark: SparkSession, year: int, k: int = 100, database: str | None = None) -> DataFrame:
    """Top ``k`` entities by mean daily volume in ``year``, with industry."""
    return ts.top_k_mean(_history(spark, database, year, year), _t(spark, database, "profile"),
                         _t(spark, database, "industry"), year, k)


def posts_correlation(spark: SparkSession, col_a: str = "volume", col_b: str = "n_posts",
                      database: str | None = None) -> DataFrame:
    """Correlation of two daily metrics per entity over days with posts."""
    daily = ts.daily_metrics(_t(spark, database, "history"), _t(spark, database, "tweets"))
    return ts.grouped_corr(daily, "stock", col_a, col_b)


def trend_report(spark: SparkSession, year: int, period: int, database: str | None = None) -> DataFrame:
    """Up/down runs per entity over the last three years."""
    return ts.trend_runs(_history(spark, database, year - 3, year), "h_code", "h_date", "h_close", period, year,
                         out_key="stock")


def industry_trend_report(spark: SparkSession, year: int, period: int, database: str | None = None) -> DataFrame:
    """Up/down runs of each industry's mean close, labelled."""
    ind = _t(spark, database, "industry")
    series = ts.category_series(_history(spark, database, year - 3, year), _t(spark, database, "profile"),
                                "h_code", "p_code", "p_industry_id", "h_date", "h_close")
    runs = ts.trend_runs(series, "p_industry_id", "h_date", "avg_close", period, year)
    return runs.join(ind, runs.p_industry_id == ind.id).select(
        "sector", "industry", "trend", "period", "period_start_date", "period_end_date")


def sector_trend_report(spark: SparkSession, year: int, period: int, database: str | None = None) -> DataFrame:
    """Up/down runs of each sector's mean close with start and end prices."""
    prof, ind = _t(spark, database, "profile"), _t(spark, database, "industry")
    dim = prof.join(ind, prof.p_industry_id == ind.id).select("p_code", "sector")
    series = ts.category_series(_history(spark, database, year - 3, year), dim, "h_code", "p_code", "sector",
                                "h_date", "h_close", with_sum=False)
    return ts.trend_runs(series, "sector", "h_date", "avg_close", period, year, anchor="lead", price_lag=period)


# ------------------------------------------------------------------ music

def _artist_tracks(spark: SparkSession, name: str, database: str | None) -> DataFrame:
    return ent.target_facts(_t(spark, database, "track"), _t(spark, database, "track_artists"),
                            _t(spark, database, "artist"), "a_name", name)


def artist_stats(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return ent.entity_stats(_artist_tracks(spark, name, database))


def artist_top_tracks(spark: SparkSession, name: str, k: int = 10, database: str | None = None) -> DataFrame:
    return ent.top_items(_artist_tracks(spark, name, database), k)


def artist_albums(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return ent.group_sums(_artist_tracks(spark, name, database), "t_album",
                          {"acousticness": "t_acousticness", "danceability": "t_danceability",
                           "energy": "t_energy"}, out_by="album")


def artist_features(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    a = _t(spark, database, "artist").where(F.col("a_name") == name)
    am = _t(spark, database, "artist_measure")
    return a.join(am, a.a_id == am.a_id).select(
        F.col("a_name").alias("name"), "genres", F.col("a_mode").alias("modality"),
        *[F.col(m).alias(m[2:]) for m in ent.MEASURES])


def similar_artists(spark: SparkSession, name: str, cluster_table: str = "artist_cluster_features", k: int = 10,
                    database: str | None = None) -> DataFrame:
    artist = _t(spark, database, "artist")
    peers = ent.cluster_peers(artist, _t(spark, database, cluster_table), "a_name", name)
    return ent.similar_entities(artist, peers, _t(spark, database, "artist_measure"), "a_name", k)


def key_frequency(spark: SparkSession, database: str | None = None) -> DataFrame:
    return rk.label_frequency(_t(spark, database, "track"), "t_key")


def mainstream_genres(spark: SparkSession, k: int = 20, database: str | None = None) -> DataFrame:
    return rk.tag_frequency(_t(spark, database, "artist"), "genres", k)


def popular_artists(spark: SparkSession, k: int = 20, database: str | None = None) -> DataFrame:
    ef = ent.entity_facts(_t(spark, database, "track"), _t(spark, database, "track_artists"),
                          _t(spark, database, "artist"))
    return rk.percentile_board(ef, "a_name", "t_popularity", k=k)
