"""Warehouse tables of the two demo domains, derived from the driver tables.

The reference analyses an equity warehouse (profile, industry, history,
posts) and a music warehouse (track, track_artists, artist).  The driver
ships TPC-H-like parquet tables instead; these functions derive tables of the
same shape from them with plain DataFrame code, so every query's work grows
with the input.  :mod:`rawhouse.plans.oracle` holds the same definitions as
DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------- equity domain

def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily close and volume per supplier: (h_code, h_date, h_close, h_volume).

    The close is the day's highest unit price; a per-row quotient and a max
    give the same double in every engine (a quotient of sums would not).
    """
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.col("l_suppkey").alias("h_code"), F.to_date("l_shipdate").alias("h_date")
    ).agg(
        F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("h_close"),
        F.sum("l_quantity").alias("h_volume"),
    )


def industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level category: (id, industry, sector) = (nation, nation name, region name)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("industry"),
        F.col("r_name").alias("sector"),
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity dimension: (p_code, p_company_name, p_industry_id, p_acctbal)."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("p_code"),
        F.col("s_name").alias("p_company_name"),
        F.col("s_nationkey").alias("p_industry_id"),
        F.col("s_acctbal").alias("p_acctbal"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars per user from the event stream (value = price)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("h_code"), F.to_date("ts").alias("h_date")).agg(
        F.min_by("value", "event_id").alias("h_open"),
        F.max("value").alias("h_high"),
        F.min("value").alias("h_low"),
        F.max_by("value", "event_id").alias("h_close"),
        F.sum("value").alias("h_volume"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts about an entity: the events (t_code, t_date, t_author, t_content)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("t_code"),
        F.col("ts").alias("t_date"),
        F.col("event_type").alias("t_author"),
        F.col("props").alias("t_content"),
    )


# ---------------------------------------------------------------- music domain

def track(spark: SparkSession, sf_dir: str, wanted: DataFrame | None = None) -> DataFrame:
    """One row per order with 9 audio-like measures from its line items.

    ``wanted`` (a ``track_id`` column) keeps these orders only; the lines are
    filtered by it before they are aggregated."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    if wanted is not None:
        ids = wanted.select("track_id").distinct()
        li = li.join(ids, li.l_orderkey == ids.track_id, "left_semi")
        o = o.join(ids, o.o_orderkey == ids.track_id, "left_semi")
    per_order = li.groupBy("l_orderkey").agg(
        F.avg("l_discount").alias("t_acousticness"),
        F.avg("l_tax").alias("t_danceability"),
        F.avg("l_quantity").alias("t_energy"),
        (F.max("l_extendedprice") / F.lit(1000.0)).alias("t_loudness"),
        F.min("l_discount").alias("t_speechiness"),
        F.max("l_tax").alias("t_instrumentalness"),
        F.min("l_quantity").alias("t_liveness"),
        F.count("*").cast("int").alias("t_track_number"),
    )
    return o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left").select(
        F.col("o_orderkey").alias("t_id"),
        F.concat(F.lit("track-"), F.col("o_orderkey").cast("string")).alias("t_name"),
        F.concat(F.lit("album-"), F.col("o_custkey").cast("string")).alias("t_album"),
        F.col("o_custkey").alias("t_album_id"),
        F.to_date("o_orderdate").alias("t_release_date"),
        F.year("o_orderdate").alias("t_year"),
        F.floor(F.col("o_totalprice") / F.lit(5000.0)).cast("int").alias("t_popularity"),
        ((F.col("o_custkey") % 13).cast("int") - 1).alias("t_key"),
        (F.col("o_orderstatus") == "F").alias("t_mode"),
        (F.col("o_orderpriority") == "1-URGENT").alias("t_explicit"),
        F.floor(F.col("o_totalprice")).cast("int").alias("t_duration_ms"),
        F.col("t_track_number"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("t_disc_number"),
        "t_acousticness", "t_danceability", "t_energy", "t_loudness", "t_speechiness",
        "t_instrumentalness", "t_liveness",
        (F.col("o_totalprice") / F.lit(500000.0)).alias("t_valence"),
        (F.col("o_totalprice") % F.lit(200.0)).alias("t_tempo"),
    )


def track_artists(spark: SparkSession, sf_dir: str, artists: DataFrame | None = None) -> DataFrame:
    """Bridge: one row per (order, supplier) pair.  ``artists`` (an ``a_id``
    column) keeps their pairs only, before the pairs are made distinct."""
    li = table(spark, sf_dir, "lineitem")
    if artists is not None:
        keys = artists.select("a_id")
        li = li.join(keys, li.l_suppkey == keys.a_id, "left_semi")
    return li.select(F.col("l_orderkey").alias("track_id"), F.col("l_suppkey").alias("artist_id")).distinct()


def artist_genres(spark: SparkSession, sf_dir: str, artists: DataFrame | None = None) -> DataFrame:
    """Genre list per supplier name: the part names of which it sells at least
    1.2 times its mean quantity per name (part names are a small fixed set, so
    the list is bounded).  ``artists`` (an ``a_id`` column) as in
    :func:`track_artists`."""
    li = table(spark, sf_dir, "lineitem")
    if artists is not None:
        keys = artists.select("a_id")
        li = li.join(keys, li.l_suppkey == keys.a_id, "left_semi")
    p = table(spark, sf_dir, "part")
    s = table(spark, sf_dir, "supplier")
    sold = li.join(p, li.l_partkey == p.p_partkey).groupBy("l_suppkey", "p_name").agg(F.sum("l_quantity").alias("q"))
    per = sold.groupBy("l_suppkey").agg(
        F.collect_list(F.struct("p_name", "q")).alias("names"), F.sum("q").alias("all_q"), F.count("*").alias("n")
    )
    much = F.filter("names", lambda x: x["q"] * F.col("n") * 10 >= F.col("all_q") * 12)
    g = per.select("l_suppkey", F.array_sort(F.transform(much, lambda x: x["p_name"])).alias("genres"))
    return g.join(s, g.l_suppkey == s.s_suppkey).select(F.col("s_name").alias("artists"), "genres")


def artist_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The artist dimension without its genre lists (a_id, a_name): the same
    rows as :func:`artist`, for queries that do not read genres (Spark cannot
    drop the genre left join on its own)."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("a_id"), F.col("s_name").alias("a_name"))


def artist(spark: SparkSession, sf_dir: str, artists: DataFrame | None = None) -> DataFrame:
    """Artist dimension (a_id, a_ext_id, a_name, genres), of ``artists`` (an
    ``a_id`` column) only where given."""
    s = table(spark, sf_dir, "supplier")
    if artists is not None:
        keys = artists.select("a_id")
        s = s.join(keys, s.s_suppkey == keys.a_id, "left_semi")
    g = artist_genres(spark, sf_dir, artists)
    return s.join(g, s.s_name == g.artists, "left").select(
        F.col("s_suppkey").alias("a_id"),
        F.concat(F.lit("sp-"), F.col("s_suppkey").cast("string")).alias("a_ext_id"),
        F.col("s_name").alias("a_name"),
        F.col("genres"),
    )


def _list_text(arr: Column) -> Column:
    """Render an array of strings as a Python list literal: ['a', 'b']."""
    return F.concat(F.lit("['"), F.array_join(arr, "', '"), F.lit("']"))


def track_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw track rows carrying their artists as list texts: every line item is a
    raw row that credits its supplier and its part's brand
    (id, artists "['Supplier#..', 'Brand#..']", artist_ids "['sp-..', 'br-..']")."""
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    p = table(spark, sf_dir, "part")
    rows = li.join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)
    return rows.select(
        F.col("l_orderkey").alias("id"),
        _list_text(F.array("s_name", "p_brand")).alias("artists"),
        _list_text(
            F.array(F.concat(F.lit("sp-"), F.col("l_suppkey").cast("string")), F.concat(F.lit("br-"), F.col("p_brand")))
        ).alias("artist_ids"),
    )


def genre_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw genre source: (artists, genres as a list text)."""
    g = artist_genres(spark, sf_dir)
    return g.select("artists", _list_text(F.col("genres")).alias("genres"))


def source_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First track source (id, name, release_date, status): the orders, and a
    second record of those that are open (exported again under another name)."""
    o = table(spark, sf_dir, "orders")
    again = F.explode(F.when(F.col("o_orderstatus") == "O", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return o.select("*", again.alias("again")).select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("again") == 1, F.concat(F.lit("0-"), F.col("o_orderpriority")))
        .otherwise(F.col("o_orderpriority")).alias("name"),
        F.date_add(F.to_date("o_orderdate"), F.col("again")).alias("release_date"),
        F.when(F.col("again") == 1, "again").otherwise(F.col("o_orderstatus")).alias("status"),
    )


def source_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second track source: line-item roll-ups, one record per order and return
    flag (id, name, release_date, n_lines, quantity)."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("id"), "l_returnflag").agg(
        F.max("l_linestatus").alias("status"),
        F.max(F.to_date("l_shipdate")).alias("release_date"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("quantity"),
    ).select(
        "id", F.concat("l_returnflag", "status").alias("name"), "release_date", "n_lines", "quantity"
    )
