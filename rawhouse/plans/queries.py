"""Registered queries: one per public operator, over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables (or
tables Spark derives from them).  Floating outputs are rounded to
``params.DIGITS`` places at the very end so results compare across engines;
the operators themselves return full precision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawhouse.operators import entity as ent
from rawhouse.operators import graph as gr
from rawhouse.operators import ml
from rawhouse.operators import model as mdl
from rawhouse.operators import parse as prs
from rawhouse.operators import ranking as rk
from rawhouse.operators import timeseries as ts
from rawhouse.plans import params as P
from rawhouse.plans import standins as S
from rawhouse.plans.registry import REGISTRY, register, rounded
from rawhouse.functions.mapping import EXCHANGE_NAMES, country_codes, map_or_keep
from rawhouse.session import materialize, scratch_path
from rawhouse.sources import files, sinks

# --------------------------------------------------------------- equity domain

@register("trend_runs")
def trend_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = S.history(spark, sf_dir)
    return ts.trend_runs(hist, "h_code", "h_date", "h_close", P.PERIOD, P.TARGET_YEAR, out_key="stock")


@register("industry_trend_runs")
def industry_trend_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = S.history(spark, sf_dir)
    ind = S.industry(spark, sf_dir)
    series = ts.category_series(hist, S.profile(spark, sf_dir), "h_code", "p_code", "p_industry_id", "h_date", "h_close")
    runs = ts.trend_runs(series, "p_industry_id", "h_date", "avg_close", P.CATEGORY_PERIOD, P.TARGET_YEAR)
    return runs.join(ind, runs.p_industry_id == ind.id).select(
        "sector", "industry", "trend", "period", "period_start_date", "period_end_date"
    )


@register("sector_trend_runs")
def sector_trend_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = S.history(spark, sf_dir)
    ind = S.industry(spark, sf_dir)
    prof = S.profile(spark, sf_dir)
    dim = prof.join(ind, prof.p_industry_id == ind.id).select("p_code", "sector")
    series = ts.category_series(hist, dim, "h_code", "p_code", "sector", "h_date", "h_close", with_sum=False)
    runs = ts.trend_runs(
        series, "sector", "h_date", "avg_close", P.CATEGORY_PERIOD, P.TARGET_YEAR,
        anchor="lead", price_lag=P.CATEGORY_PERIOD,
    )
    return rounded(runs)


@register("moving_average")
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = S.history(spark, sf_dir).where(
        (F.col("h_code") == P.TARGET_ENTITY) & ts.year_range("h_date", P.TARGET_YEAR, P.TARGET_YEAR)
    )
    out = ts.moving_average(hist, "h_code", "h_date", "h_close", 50)
    return rounded(out.select("h_date", "h_close", "moving_average"))


@register("top_volume")
def top_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ts.top_k_mean(
        S.history(spark, sf_dir), S.profile(spark, sf_dir), S.industry(spark, sf_dir),
        P.TARGET_YEAR, P.TOP_K,
    )
    return rounded(out)


@register("daily_metrics")
def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ts.daily_metrics(S.bars(spark, sf_dir), S.posts(spark, sf_dir)))


@register("pairwise_correlation")
def pairwise_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = ts.daily_metrics(S.bars(spark, sf_dir), S.posts(spark, sf_dir))
    return rounded(ts.grouped_corr(daily, "stock", "volume", "n_posts"))


@register("entity_card")
def entity_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.entity_card(
        S.profile(spark, sf_dir), S.industry(spark, sf_dir), "p_code", P.TARGET_ENTITY,
        "p_industry_id", "id",
        [F.col("p_code").alias("stock"), F.col("p_company_name").alias("name"),
         F.col("p_acctbal").alias("acctbal"), "sector", "industry"],
    )


@register("attribute_peers")
def attribute_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = S.profile(spark, sf_dir)
    ind = S.industry(spark, sf_dir)
    with_sector = prof.join(ind, prof.p_industry_id == ind.id).select("p_code", "sector", "p_acctbal")
    return ent.attribute_peers(with_sector, "p_code", "sector", P.TARGET_ENTITY, extra=["p_acctbal"])


# ---------------------------------------------------------------- music domain

def _star(spark: SparkSession, sf_dir: str, artists: DataFrame | None = None) -> DataFrame:
    """Facts joined to the bridge and the artist keys.  With ``artists`` the key
    filter sits below every distinct and aggregate: the few pairs of these
    artists are written once, and lines and orders are semi-joined to them."""
    if artists is None:
        return ent.entity_facts(S.track(spark, sf_dir), S.track_artists(spark, sf_dir), S.artist_keys(spark, sf_dir))
    bridge = materialize(S.track_artists(spark, sf_dir, artists), "bridge")
    return ent.entity_facts(S.track(spark, sf_dir, bridge), bridge, artists)


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.artist_keys(spark, sf_dir).where(F.col("a_name") == F.lit(P.TARGET_ARTIST))


def _target_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir, _target(spark, sf_dir))


def _artist_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.entity_measures(_star(spark, sf_dir))


@register("entity_stats")
def entity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ent.entity_stats(_target_tracks(spark, sf_dir)))


@register("top_items")
def top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ent.top_items(_target_tracks(spark, sf_dir), P.TOP_ITEMS))


@register("group_sums")
def group_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    tf = _target_tracks(spark, sf_dir)
    out = ent.group_sums(
        tf, "t_album",
        {"acousticness": "t_acousticness", "danceability": "t_danceability", "energy": "t_energy"},
        out_by="album",
    )
    return rounded(out)


@register("entity_measures")
def entity_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_artist_measures(spark, sf_dir))


@register("entity_features")
def entity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    me = _target(spark, sf_dir)
    a, am = S.artist(spark, sf_dir, me), ent.entity_measures(_star(spark, sf_dir, me))
    out = a.join(am, a.a_id == am.a_id).select(
        F.col("a_name").alias("name"), "genres", F.col("a_mode").alias("modality"),
        *[F.col(m).alias(m[2:]) for m in ent.MEASURES],
    )
    return rounded(out)


def _cluster_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic cluster labels (region of the supplier) so the peer
    query can be checked exactly; :func:`cluster_entities` gives k-means ones."""
    s = S.table(spark, sf_dir, "supplier")
    n = S.table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("a_id"), F.col("n_regionkey").alias("prediction")
    )


@register("similar_entities")
def similar_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = materialize(S.artist(spark, sf_dir), "artists")
    # the peers are found once; measures are computed for them only
    found = ent.cluster_peers(dim, _cluster_standin(spark, sf_dir), "a_name", P.TARGET_ARTIST)
    peers = materialize(found.join(dim.select("a_id", "a_name"), "a_id"), "peers")
    am = ent.entity_measures(_star(spark, sf_dir, peers))
    return rounded(ent.similar_entities(dim, peers, am, "a_name", P.TOP_ITEMS))


@register("label_frequency")
def label_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rk.label_frequency(S.track(spark, sf_dir), "t_key")


@register("tag_frequency")
def tag_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rk.tag_frequency(S.artist(spark, sf_dir), "genres", P.TOP_TAGS)


@register("popularity_percentiles")
def popularity_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rk.percentile_board(_star(spark, sf_dir), "a_name", "t_popularity", k=P.TOP_NAMES))


# ------------------------------------------------------------------ modelling

def _pair_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = S.table(spark, sf_dir, "lineitem")
    return mdl.build_dictionary(li, "l_partkey", "l_suppkey", index_col="pair_id")


@register("dictionary_encode")
def dictionary_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pair_dictionary(spark, sf_dir)


@register("normalize_fk")
def normalize_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return mdl.normalize(li, _pair_dictionary(spark, sf_dir), ["l_partkey", "l_suppkey"], "pair_id")


@register("merge_sources")
def merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mdl.merge_sources(S.source_a(spark, sf_dir), S.source_b(spark, sf_dir), "id", ["name"]))


@register("bridge_explode")
def bridge_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mdl.explode_zipped(
        S.track_lists(spark, sf_dir), "id", {"a_name": "artists", "a_ext_id": "artist_ids"}
    )


def _dimension(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mdl.build_dimension_from_texts(S.track_lists(spark, sf_dir), S.genre_texts(spark, sf_dir))


@register("enrich_dimension")
def enrich_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir)[0]


@register("dimension_bridge")
def dimension_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir)[1]


@register("distinct_profile")
def distinct_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mdl.distinct_profile(S.table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


# ------------------------------------------------------------------ ingestion
# These queries write text derived from the driver tables to a fresh folder
# below the session's checkpoint folder and read it back with the readers.

@register("load_csv_audited")
def load_csv_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.table(spark, sf_dir, "orders")
    raw = o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("album_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        # a second export system writes day/month/year dates for pending orders
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "d/M/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("release_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("explicit"),
    )
    path = scratch_path(spark, "orders-csv")
    sinks.write_csv(raw, path)
    schema = T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("album_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("release_date", T.DateType()),
        T.StructField("explicit", T.IntegerType()),
    ])
    return files.read_csv_audited(spark, path, schema, bool_flags=("explicit",)).rows


@register("load_keyed_files")
def load_keyed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = S.profile(spark, sf_dir)
    h = S.history(spark, sf_dir).join(prof, F.col("h_code") == prof.p_code)
    hist = h.select(
        # one office writes day/month/year dates
        F.when(F.col("p_industry_id") == 3, F.date_format("h_date", "d/M/yyyy"))
        .otherwise(F.date_format("h_date", "yyyy-MM-dd")).alias("date"),
        F.col("h_code").alias("code"), F.col("h_close").alias("close"), F.col("h_volume").alias("volume"),
        F.col("p_industry_id").alias("office"),
    )
    path = scratch_path(spark, "history-csv")
    # the files are keyed by office (a nation): their number does not grow with the entities
    sinks.write_csv(hist, path, partition_by=["office"])
    schema = T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("code", T.LongType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ])
    return files.read_entity_csvs(
        spark, path, schema, key_col="office", key_pattern=r"office=([^/]+)/",
        key_from="file_path", prefix="h_", recursive=True,
    ).rows


@register("parse_posts")
def parse_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.table(spark, sf_dir, "events")
    lines = e.select(F.concat_ws(
        ",",
        F.col("user_id").cast("string"),
        F.date_format("ts", "d/M/yyyy H:mm"),
        F.concat(F.col("event_type"), F.lit(",\n"), F.col("props")),
        F.concat(F.lit('"user'), F.col("user_id").cast("string"), F.lit('"')),
    ).alias("value"))
    path = scratch_path(spark, "posts-txt")
    lines.write.option("lineSep", "\r\n").text(path)
    return prs.parse_posts(files.read_lines(spark, path, "\r\n"))


# line number of each field in a profile text
PROFILE_FIELDS = {
    "code": 1, "company_name": 2, "address": 3, "country": 4, "sector": 5,
    "industry": 6, "acctbal": 7, "ipo_date": 8, "ceo": 12,
}


def profile_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, value): a key,value text per supplier, one field a line."""
    s = S.table(spark, sf_dir, "supplier")
    n = S.table(spark, sf_dir, "nation")
    r = S.table(spark, sf_dir, "region")
    first = S.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.min(F.to_date("l_shipdate")).alias("first_ship")
    )
    src = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey")).join(
        first, s.s_suppkey == first.l_suppkey, "left"
    )
    text = F.concat_ws(
        "\n",
        F.lit("Profile,"),
        F.concat(F.lit("code,"), F.col("s_suppkey").cast("string")),
        F.concat(F.lit("company_name,"), F.col("s_name")),
        F.concat(F.lit("address,"), F.col("s_name"), F.lit(", Suite "), F.col("s_nationkey").cast("string")),
        F.concat(F.lit("country,"), F.col("n_name")),
        F.concat(F.lit("sector,"), F.lower("r_name")),
        F.concat(F.lit("industry,"), F.lower("n_name")),
        F.concat(F.lit("acctbal,"), F.when(F.col("s_acctbal") < 0, F.lit("N/A")).otherwise(F.col("s_acctbal").cast("string"))),
        F.concat(F.lit("ipo_date,"), F.coalesce(F.col("first_ship").cast("string"), F.lit(""))),
    )
    return src.select("s_suppkey", text.alias("value"))


@register("parse_profiles")
def parse_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "profiles-txt")
    profile_texts(spark, sf_dir).select("value").write.option("lineSep", "\x1e").text(path)
    parsed = prs.parse_kv_profile(files.read_records(spark, path, "\x1e"), PROFILE_FIELDS)
    cleaned = prs.clean_profile(parsed)
    return cleaned.withColumn("acctbal", F.col("acctbal").try_cast("double"))


@register("map_names")
def map_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country and exchange names unified.  A customer's country is written as its
    nation's name (unknown to the table, so it stays) or as one of the table's
    spellings, some with blanks around them; every known spelling occurs."""
    codes = country_codes(spark)
    spelled, exchanges = sorted(codes), [*sorted(EXCHANGE_NAMES), "Moon Exchange"]
    c, n = S.table(spark, sf_dir, "customer"), S.table(spark, sf_dir, "nation")

    def pick(names: list[str], at: Column) -> Column:
        return F.get(F.array(*[F.lit(x) for x in names]), F.pmod(at, F.lit(len(names))).cast("int"))

    name = pick(spelled, F.col("c_custkey"))
    country = (
        F.when(F.col("c_acctbal") < 0, F.col("n_name"))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit(" "), name, F.lit("  ")))
        .otherwise(name)
    )
    raw = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", country.alias("country"), pick(exchanges, F.col("n_regionkey") + F.col("c_custkey")).alias("exchange")
    )
    return raw.select(
        "c_custkey",
        map_or_keep("country", codes).alias("country"),
        map_or_keep("exchange", EXCHANGE_NAMES).alias("exchange"),
    )


def _page_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prs.html_cell_pairs(S.table(spark, sf_dir, "pages"), "html", ["page_id"], tag="li")


@register("extract_cells")
def extract_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_pairs(spark, sf_dir)


@register("post_search")
def post_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = S.table(spark, sf_dir, "documents")
    return prs.match_posts(
        docs, _page_pairs(spark, sf_dir), "text", ["doc_id"], prefix="", lang_col="lang", lang="en"
    )


# ------------------------------------------------------------------ graph / ml

def _bridge_and_measures(spark: SparkSession, sf_dir: str):
    return S.track_artists(spark, sf_dir), _artist_measures(spark, sf_dir)


@register("cooccurrence_edges")
def cooccurrence_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.cooccurrence_degree(S.track_artists(spark, sf_dir))


SMOOTHED = {"track_number": "a_track_number", "modality": "a_mode", **{m[2:]: m for m in ent.MEASURES}}


@register("neighbor_smoothing")
def neighbor_smoothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge, am = _bridge_and_measures(spark, sf_dir)
    return rounded(gr.smooth_features(bridge, am, "a_id", SMOOTHED))


def _audited_clusters(features: DataFrame) -> DataFrame:
    """Scaled features per entity, whether it sits at a nearest centre, and the
    number of clusters (cluster numbers themselves are arbitrary)."""
    found = ml.fit_clusters(features, "a_id", k=P.KMEANS_K, seed=P.KMEANS_SEED)
    names = [c for c in features.columns if c != "a_id"]
    out = found.assigned.select(
        "a_id",
        *[F.get("scaled", i).alias(f"scaled_{n}") for i, n in enumerate(names)],
        ml.at_nearest_centre(found).alias("at_nearest_centre"),
        F.lit(len(found.centres)).cast("long").alias("n_clusters"),
    )
    return rounded(out)


@register("cluster_entities")
def cluster_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audited_clusters(_artist_measures(spark, sf_dir))


@register("cluster_smoothed_entities")
def cluster_smoothed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge, am = _bridge_and_measures(spark, sf_dir)
    smoothed = gr.smooth_features(bridge, am, "a_id", SMOOTHED, out_key="a_id")
    # means of equal values differ in their last bits; scaling would blow that up
    return _audited_clusters(smoothed.select("a_id", *[F.round(c, 9).alias(c) for c in SMOOTHED]))


# the queries over stored tables and files register themselves in the same place
from rawhouse.plans import stored_queries  # noqa: E402, F401
