"""DuckDB SQL for the stand-in tables of :mod:`rawhouse.plans.standins`.

Written independently in plain SQL so the oracle does not share code paths
with the Spark side.  Each constant is a ``name AS (...)`` CTE body.
"""

HISTORY = """history AS (
  SELECT l_suppkey AS h_code, CAST(l_shipdate AS DATE) AS h_date,
         max(l_extendedprice / l_quantity) AS h_close,
         sum(l_quantity) AS h_volume
  FROM lineitem GROUP BY 1, 2)"""

INDUSTRY = """industry AS (
  SELECT n_nationkey AS id, n_name AS industry, r_name AS sector
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

PROFILE = """profile AS (
  SELECT s_suppkey AS p_code, s_name AS p_company_name, s_nationkey AS p_industry_id,
         s_acctbal AS p_acctbal
  FROM supplier)"""

BARS = """bars AS (
  SELECT user_id AS h_code, CAST(ts AS DATE) AS h_date,
         arg_min(value, event_id) AS h_open, max(value) AS h_high, min(value) AS h_low,
         arg_max(value, event_id) AS h_close, sum(value) AS h_volume
  FROM events GROUP BY 1, 2)"""

POSTS = """posts AS (
  SELECT user_id AS t_code, ts AS t_date, event_type AS t_author, props AS t_content
  FROM events)"""

TRACK = """track AS (
  SELECT o_orderkey AS t_id, 'track-' || CAST(o_orderkey AS VARCHAR) AS t_name,
         'album-' || CAST(o_custkey AS VARCHAR) AS t_album, o_custkey AS t_album_id,
         CAST(o_orderdate AS DATE) AS t_release_date, CAST(year(o_orderdate) AS INTEGER) AS t_year,
         CAST(floor(o_totalprice / 5000.0) AS INTEGER) AS t_popularity,
         CAST(o_custkey % 13 AS INTEGER) - 1 AS t_key,
         o_orderstatus = 'F' AS t_mode, o_orderpriority = '1-URGENT' AS t_explicit,
         CAST(floor(o_totalprice) AS INTEGER) AS t_duration_ms,
         lt.t_track_number,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS t_disc_number,
         lt.t_acousticness, lt.t_danceability, lt.t_energy, lt.t_loudness, lt.t_speechiness,
         lt.t_instrumentalness, lt.t_liveness,
         o_totalprice / 500000.0 AS t_valence, fmod(o_totalprice, 200.0) AS t_tempo
  FROM orders LEFT JOIN (
    SELECT l_orderkey, avg(l_discount) AS t_acousticness, avg(l_tax) AS t_danceability,
           avg(l_quantity) AS t_energy, max(l_extendedprice) / 1000.0 AS t_loudness,
           min(l_discount) AS t_speechiness, max(l_tax) AS t_instrumentalness,
           min(l_quantity) AS t_liveness, CAST(count(*) AS INTEGER) AS t_track_number
    FROM lineitem GROUP BY l_orderkey) lt ON o_orderkey = lt.l_orderkey)"""

TRACK_ARTISTS = """track_artists AS (
  SELECT DISTINCT l_orderkey AS track_id, l_suppkey AS artist_id FROM lineitem)"""

ARTIST_GENRES = """artist_genres AS (
  SELECT s_name AS artists, g.genres
  FROM (SELECT l_suppkey, coalesce(list(p_name ORDER BY p_name) FILTER (WHERE q * names * 10 >= total * 12), []) AS genres
        FROM (SELECT l_suppkey, p_name, sum(l_quantity) AS q,
                     count(*) OVER (PARTITION BY l_suppkey) AS names,
                     sum(sum(l_quantity)) OVER (PARTITION BY l_suppkey) AS total
              FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_name) sold
        GROUP BY l_suppkey) g
  JOIN supplier ON g.l_suppkey = s_suppkey)"""

ARTIST = """artist AS (
  SELECT s_suppkey AS a_id, 'sp-' || CAST(s_suppkey AS VARCHAR) AS a_ext_id,
         s_name AS a_name, ag.genres
  FROM supplier LEFT JOIN artist_genres ag ON s_name = ag.artists)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
