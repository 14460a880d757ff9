"""Registered queries over stored tables and files: bucketed star joins, prices
by year, build steps that run when their input changed, a saved model, ordered
reports, one file an entity.

Each writes tables derived from the driver tables to new folders below the
session's checkpoint folder and reads them back as a warehouse would.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawhouse.operators import entity as ent
from rawhouse.operators import ml
from rawhouse.operators import parse as prs
from rawhouse.operators import timeseries as ts
from rawhouse.plans import params as P
from rawhouse.plans import queries as Q
from rawhouse.plans import sql_forms
from rawhouse.plans import standins as S
from rawhouse.plans.registry import register, rounded
from rawhouse.session import materialize, scratch_path
from rawhouse.sources import files, sinks

BUCKETS = 16


def _scratch_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def star_tables(spark: SparkSession, sf_dir: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Track and bridge as tables bucketed by the track's id."""
    made = []
    for label, df, key in (("track", S.track(spark, sf_dir), "t_id"), ("track_artists", S.track_artists(spark, sf_dir), "track_id")):
        name = _scratch_name(label)
        sinks.save_bucketed(df, name, key, buckets, path=scratch_path(spark, name))
        made.append(spark.table(name))
    return made[0], made[1]


@register("bucketed_star")
def bucketed_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every credited track with its artist, over bucketed tables: neither track
    nor bridge is shuffled for their join."""
    track, bridge = star_tables(spark, sf_dir)
    star = ent.entity_facts(track, bridge, S.artist_keys(spark, sf_dir))
    return rounded(star.select("t_id", "a_name", "t_album", "t_year", "t_popularity", "t_valence"))


# years of the second load
CORRECTED = (P.TARGET_YEAR - 1, P.TARGET_YEAR)


def price_folder(spark: SparkSession, sf_dir: str) -> str:
    """Prices by year, loaded twice: all years, then corrected figures of two."""
    path = scratch_path(spark, "prices")
    prices = materialize(S.history(spark, sf_dir).withColumn("h_year", F.year("h_date")), "prices")
    sinks.replace_partitions(prices, path, "h_year", "h_code")
    late = prices.where(F.col("h_year").isin(*CORRECTED)).withColumn("h_close", F.col("h_close") * 2)
    sinks.replace_partitions(late, path, "h_year", "h_code")
    return path


@register("price_years")
def price_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of three years after an incremental load; other years are not read."""
    prices = spark.read.parquet(price_folder(spark, sf_dir))
    wanted = prices.where(F.col("h_year").between(P.TARGET_YEAR - 2, P.TARGET_YEAR))
    return rounded(wanted.select("h_code", "h_date", "h_close", "h_volume", F.col("h_year").cast("int").alias("h_year")))


@register("fresh_build")
def fresh_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals by customer, asked for three times: first built, then kept (the
    same rows in other files), then built again after orders were added."""
    orders = S.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    name, built = _scratch_name("order_totals"), []

    def ask(rows: DataFrame) -> DataFrame:
        table, new = sinks.ensure_fresh(spark, name, lambda: totals(rows), [rows])
        built.append(new)
        return table

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("total"))

    ask(orders)
    ask(materialize(orders.repartition(7), "orders-again"))
    more = orders.where("o_orderkey % 2 = 0").withColumn("o_orderkey", -F.col("o_orderkey"))
    out = ask(orders.unionByName(more))
    # the result is read from files of its own, so the table need not outlive the call
    out = materialize(out.withColumn("builds", F.lit("".join("B" if b else "-" for b in built))), "order-totals")
    spark.sql("DROP TABLE IDENTIFIER(:n)", args={"n": name})
    return rounded(out)


def _audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of an artist that set the regions far apart: (a_id, f0, f1, ...)."""
    s, n = S.table(spark, sf_dir, "supplier"), S.table(spark, sf_dir, "nation")
    own = s.join(n, s.s_nationkey == n.n_nationkey)
    at_home = [F.when(F.col("n_regionkey") == i, 100.0).otherwise(0.0) + F.col("s_acctbal") / 1e5 for i in range(5)]
    return own.select(F.col("s_suppkey").alias("a_id"), "n_regionkey", *[f.alias(f"f{i}") for i, f in enumerate(at_home)])


def stored_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means fitted on the artists with odd keys and saved; all artists, the new
    ones too, are assigned by the loaded model and stored: (a_id, prediction)."""
    features = materialize(_audience(spark, sf_dir), "audience")
    known = features.where("a_id % 2 = 1")
    k = known.select("n_regionkey").distinct().count()
    found = ml.fit_clusters(known.drop("n_regionkey"), "a_id", k=k, seed=P.KMEANS_SEED)
    path = scratch_path(spark, "kmeans-model")
    ml.save_model(found.model, path)
    return materialize(ml.assign(ml.load_model(path), features, "a_id").select("a_id", "prediction"), "artist-clusters")


@register("similar_entities_kmeans")
def similar_entities_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target's most similar artists among its cluster of a stored k-means model."""
    dim = materialize(S.artist(spark, sf_dir), "artists")
    found = ent.cluster_peers(dim, stored_clusters(spark, sf_dir), "a_name", P.TARGET_ARTIST)
    peers = materialize(found.join(dim.select("a_id", "a_name"), "a_id"), "peers")
    am = ent.entity_measures(Q._star(spark, sf_dir, peers))
    return rounded(ent.similar_entities(dim, peers, am, "a_name", P.TOP_ITEMS))


REPORT_ORDER = ("stock", "period_start_date")


@register("ordered_report")
def ordered_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend report written in order and read back with every row's place."""
    hist = S.history(spark, sf_dir)
    runs = ts.trend_runs(hist, "h_code", "h_date", "h_close", P.PERIOD, P.TARGET_YEAR, out_key="stock")
    path = scratch_path(spark, "trend-report")
    sinks.write_files(runs, path, order_by=REPORT_ORDER)
    return sinks.read_ordered(spark, path, REPORT_ORDER)


@register("profile_files")
def profile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles from one small file an entity, many files a task."""
    path = scratch_path(spark, "profile-files")
    # one record a file: as many small files as entities
    sinks.write_file_per_row(Q.profile_texts(spark, sf_dir), path)
    parsed = prs.parse_kv_profile(files.read_whole_files(spark, path), Q.PROFILE_FIELDS)
    cleaned = prs.clean_profile(parsed)
    return cleaned.withColumn("acctbal", F.col("acctbal").try_cast("double"))


@register("correlation_sql")
def correlation_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of two daily figures per entity, columns and table given by name."""
    name = _scratch_name("daily")
    sinks.named_view(ts.daily_metrics(S.bars(spark, sf_dir), S.posts(spark, sf_dir)), name)
    return rounded(sql_forms.grouped_corr_sql(spark, name, "stock", "price_fluctuation_percent", "n_posts"))
