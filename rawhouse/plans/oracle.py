"""DuckDB oracle SQL, one statement per registered query.

The statements are written from the operators' specifications, in shapes of
their own (runs as islands of equal state, built-in correlation, brute-force
pairs), so they check the Spark plans against an independent formulation.
"""

from __future__ import annotations

from rawhouse.functions.labels import PITCH_CLASSES
from rawhouse.functions.mapping import EXCHANGE_NAMES, country_codes
from rawhouse.operators.entity import MEASURES
from rawhouse.plans import oracle_ctes as C
from rawhouse.plans import params as P

D = P.DIGITS
Y = P.TARGET_YEAR
SQL: dict[str, str] = {}


def _runs(series: str, key: str, value: str, n: int, shift: int = 0) -> str:
    """CTEs up to ``inner_runs``: maximal spells of one state (short mean above
    the long one or not) per key, without the first and the last spell.

    Spells are islands: the difference of a day's number among all days and
    among the days of its state is constant within a spell.  ``shift`` reports
    the value that many days earlier.
    """
    span = f"OVER (PARTITION BY {key} ORDER BY h_date ROWS BETWEEN {{}} PRECEDING AND CURRENT ROW)"
    shown = f"lag({value}, {shift}) OVER (PARTITION BY {key} ORDER BY h_date)" if shift else value
    return f"""
means AS (
  SELECT {key} AS k, h_date AS d, {shown} AS price,
         round(avg({value}) {span.format(n)}, 9) > round(avg({value}) {span.format(2 * n)}, 9) AS rising
  FROM {series} WHERE h_date >= DATE '{Y - 3}-01-01' AND h_date < DATE '{Y + 1}-01-01'),
days AS (
  SELECT k, d, price, rising, row_number() OVER (PARTITION BY k ORDER BY d)
         - row_number() OVER (PARTITION BY k, rising ORDER BY d) AS island
  FROM means WHERE d >= DATE '{Y - 2}-01-01'),
spells AS (
  SELECT k, rising, min(d) AS d1, max(d) AS d2, arg_min(price, d) AS price1, arg_max(price, d) AS price2
  FROM days GROUP BY k, rising, island),
inner_runs AS (
  SELECT * FROM spells
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY d1) > 1
      AND row_number() OVER (PARTITION BY k ORDER BY d1 DESC) > 1)"""


_RUN = """CAST(d2 - d1 AS INTEGER) AS period, d1 AS period_start_date, d2 AS period_end_date,
       CASE WHEN rising THEN 'up' ELSE 'down' END AS trend"""

SQL["trend_runs"] = C.with_ctes(C.HISTORY) + "," + _runs("history", "h_code", "h_close", P.PERIOD) + f"""
SELECT k AS stock, {_RUN} FROM inner_runs"""

SQL["industry_trend_runs"] = C.with_ctes(C.HISTORY, C.PROFILE, C.INDUSTRY) + """,
per_industry AS (
  SELECT p_industry_id, h_date, avg(h_close) AS mean_close
  FROM history JOIN profile ON h_code = p_code WHERE p_industry_id IS NOT NULL GROUP BY ALL),""" + _runs(
    "per_industry", "p_industry_id", "mean_close", P.CATEGORY_PERIOD) + f"""
SELECT sector, industry, {_RUN} FROM inner_runs JOIN industry ON id = k"""

SQL["sector_trend_runs"] = C.with_ctes(C.HISTORY, C.PROFILE, C.INDUSTRY) + """,
per_sector AS (
  SELECT sector, h_date, avg(h_close) AS mean_close
  FROM history JOIN profile ON h_code = p_code JOIN industry ON p_industry_id = id GROUP BY ALL),""" + _runs(
    "per_sector", "sector", "mean_close", P.CATEGORY_PERIOD, P.CATEGORY_PERIOD) + f"""
SELECT k AS sector, {_RUN}, round(price1, {D}) AS period_start_closing_price,
       round(price2, {D}) AS period_end_closing_price
FROM inner_runs"""

SQL["moving_average"] = C.with_ctes(C.HISTORY) + f"""
SELECT h_date, round(h_close, {D}) AS h_close,
  round(avg(h_close) OVER (PARTITION BY h_code ORDER BY h_date ROWS BETWEEN 50 PRECEDING AND CURRENT ROW), {D}) AS moving_average
FROM history
WHERE h_code = {P.TARGET_ENTITY} AND date_part('year', h_date) = {Y}"""

SQL["top_volume"] = C.with_ctes(C.HISTORY, C.PROFILE, C.INDUSTRY) + f"""
SELECT p_code, round(avg(h_volume), {D}) AS avg_volume, industry.industry
FROM history, profile, industry
WHERE industry.id = p_industry_id AND h_code = p_code AND date_part('year', h_date) = {Y}
GROUP BY p_code, industry.industry
ORDER BY avg(h_volume) DESC, p_code
LIMIT {P.TOP_K}"""

_DAILY = """posted AS (
  SELECT t_code, t_date::DATE AS post_day, count(t_content) AS n_posts FROM posts GROUP BY ALL),
day_figures AS (
  SELECT b.h_code AS stock, b.h_date AS trading_date, b.h_volume AS volume, n_posts,
         CASE WHEN b.h_open <> 0 THEN 100 * (b.h_close - b.h_open) / b.h_open END AS price_difference_percent,
         CASE WHEN b.h_close <> 0 THEN 100 * (b.h_high - b.h_low) / b.h_close END AS price_fluctuation_percent
  FROM bars b JOIN posted ON t_code = b.h_code AND post_day = b.h_date)"""

SQL["daily_metrics"] = C.with_ctes(C.BARS, C.POSTS, _DAILY) + f"""
SELECT stock, trading_date, n_posts, round(volume, {D}) AS volume,
       round(price_difference_percent, {D}) AS price_difference_percent,
       round(price_fluctuation_percent, {D}) AS price_fluctuation_percent
FROM day_figures"""

SQL["pairwise_correlation"] = C.with_ctes(C.BARS, C.POSTS, _DAILY) + f"""
SELECT stock,
  round(CASE WHEN min(volume) < max(volume) AND min(n_posts) < max(n_posts) THEN corr(volume, n_posts) END, {D})
    AS correlation_volume_n_posts
FROM day_figures WHERE volume IS NOT NULL AND n_posts IS NOT NULL
GROUP BY stock"""

SQL["entity_card"] = C.with_ctes(C.PROFILE, C.INDUSTRY) + f"""
SELECT p_code AS stock, p_company_name AS name, p_acctbal AS acctbal, sector, industry
FROM profile, industry
WHERE p_industry_id = industry.id AND p_code = {P.TARGET_ENTITY}"""

SQL["attribute_peers"] = C.with_ctes(C.PROFILE, C.INDUSTRY) + f""",
ps AS (SELECT p_code, sector, p_acctbal FROM profile JOIN industry ON p_industry_id = id)
SELECT self.p_code AS me, other.p_code AS peer, other.sector, other.p_acctbal
FROM ps other, ps self
WHERE self.sector != 'None' AND other.sector != 'None'
  AND self.p_code = {P.TARGET_ENTITY} AND self.sector = other.sector
  AND other.p_code <> {P.TARGET_ENTITY}"""

_MUSIC = (C.TRACK, C.TRACK_ARTISTS, C.ARTIST_GENRES, C.ARTIST)
_LABELS = "[" + ", ".join(f"'{label}'" for label in PITCH_CLASSES) + "]"
_PITCH = f"coalesce(CASE WHEN t_key >= 0 THEN {_LABELS}[t_key + 1] END, 'Unknown')"
_SELF = f"(SELECT s_suppkey FROM supplier WHERE s_name = '{P.TARGET_ARTIST}')"
# The target's tracks; every credited track with its artist's key.
_MINE = f"mine AS (SELECT * FROM track WHERE t_id IN (SELECT track_id FROM track_artists WHERE artist_id IN {_SELF}))"
_PLAYED = "played AS (SELECT * FROM track_artists SEMI JOIN supplier ON s_suppkey = artist_id JOIN track ON t_id = track_id)"
_AM = _PLAYED + """,
am AS (
  SELECT artist_id AS a_id, count(*) AS a_track_number, count(*) FILTER (WHERE t_mode) / count(*) AS a_mode,
         """ + ", ".join(f"median({c}) AS {o}" for o, c in MEASURES.items()) + " FROM played GROUP BY artist_id)"

SQL["entity_stats"] = C.with_ctes(C.TRACK, C.TRACK_ARTISTS, _MINE) + f"""
SELECT len(list(t_id)) AS track_number, len(list_distinct(list(t_album_id))) AS album_number,
       list_min(list(t_release_date)) AS first_release, list_max(list(t_release_date)) AS last_release,
       round(sum(t_popularity) / count(t_popularity), {D}) AS avg_popularity
FROM mine"""

SQL["top_items"] = C.with_ctes(C.TRACK, C.TRACK_ARTISTS, _MINE) + f"""
SELECT t_name AS name, {_PITCH} AS "key", CASE t_mode WHEN true THEN 'Major' ELSE 'Minor' END AS music_mode,
       t_year AS year, t_release_date AS release_date, t_album AS album, t_track_number AS track_number,
       t_disc_number AS disc_number, round(t_duration_ms / 1000, {D}) AS duration_seconds
FROM mine QUALIFY row_number() OVER (ORDER BY t_popularity DESC, t_id) <= {P.TOP_ITEMS}"""

SQL["group_sums"] = C.with_ctes(C.TRACK, C.TRACK_ARTISTS, _MINE) + f"""
SELECT album, round(list_sum(a), {D}) AS acousticness, round(list_sum(d), {D}) AS danceability, round(list_sum(e), {D}) AS energy
FROM (SELECT t_album AS album, list(t_acousticness) AS a, list(t_danceability) AS d, list(t_energy) AS e
      FROM mine GROUP BY ALL)"""

SQL["entity_measures"] = C.with_ctes(C.TRACK, C.TRACK_ARTISTS, _AM) + "SELECT a_id, a_track_number, " + ", ".join(
    f"round({c}, {D}) AS {c}" for c in ["a_mode", *MEASURES]
) + " FROM am"

_SHOWN = f"round(a_mode, {D}) AS modality, " + ", ".join(f"round({o}, {D}) AS {o[2:]}" for o in MEASURES)
SQL["entity_features"] = C.with_ctes(*_MUSIC, _AM) + f"""
SELECT a_name AS name, genres, {_SHOWN}
FROM artist JOIN am USING (a_id) WHERE a_id IN {_SELF}"""

# Peers: the suppliers of the target's region that share a genre with it.
_NEAR = f"""region_of AS (SELECT s_suppkey, n_regionkey FROM supplier JOIN nation ON n_nationkey = s_nationkey),
near AS (
  SELECT s_suppkey FROM region_of
  WHERE n_regionkey IN (SELECT n_regionkey FROM region_of WHERE s_suppkey IN {_SELF}) AND s_suppkey NOT IN {_SELF})"""
SQL["similar_entities"] = C.with_ctes(*_MUSIC, _AM, _NEAR) + f"""
SELECT a_name AS artist_name, genres, a_track_number AS track_number, {_SHOWN}
FROM artist JOIN am USING (a_id)
WHERE a_id IN (SELECT s_suppkey FROM near) AND list_has_any(genres, (SELECT genres FROM artist WHERE a_id IN {_SELF}))
QUALIFY row_number() OVER (ORDER BY a_track_number DESC, a_name) <= {P.TOP_ITEMS}"""

SQL["label_frequency"] = C.with_ctes(C.TRACK) + f"""
SELECT count(*) AS track_number, {_PITCH} AS "key"
FROM track GROUP BY t_key"""

SQL["tag_frequency"] = C.with_ctes(C.ARTIST_GENRES, C.ARTIST) + f"""
SELECT len(fans) AS artist_number, genre
FROM (SELECT genre, list(a_id) AS fans FROM (SELECT a_id, unnest(genres) AS genre FROM artist) GROUP BY genre)
QUALIFY row_number() OVER (ORDER BY len(fans) DESC, genre) <= {P.TOP_TAGS}"""

SQL["popularity_percentiles"] = C.with_ctes(C.TRACK, C.TRACK_ARTISTS, _PLAYED) + f"""
SELECT top AS popularity, round(q[1], {D}) AS popularity90, round(q[2], {D}) AS popularity50, s_name AS a_name
FROM (SELECT artist_id, max(t_popularity) AS top, quantile_cont(t_popularity, [0.9, 0.5]) AS q FROM played GROUP BY artist_id)
JOIN supplier ON s_suppkey = artist_id
QUALIFY row_number() OVER (ORDER BY top DESC, s_name) <= {P.TOP_NAMES}"""

_PAIRS = """dic AS (
  SELECT l_partkey, l_suppkey, row_number() OVER (ORDER BY l_partkey, l_suppkey) AS pair_id
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem
        WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL) d)"""

SQL["dictionary_encode"] = C.with_ctes(_PAIRS) + "SELECT l_partkey, l_suppkey, pair_id FROM dic"

SQL["normalize_fk"] = C.with_ctes(_PAIRS) + """
SELECT l_orderkey, l_linenumber, dic.pair_id
FROM lineitem LEFT JOIN dic
  ON lineitem.l_partkey = dic.l_partkey AND lineitem.l_suppkey = dic.l_suppkey"""

SQL["merge_sources"] = f"""
WITH a AS (
  SELECT o_orderkey AS id, o_orderpriority AS name, CAST(o_orderdate AS DATE) AS release_date, o_orderstatus AS status
  FROM orders
  UNION ALL
  SELECT o_orderkey, '0-' || o_orderpriority, CAST(o_orderdate AS DATE) + 1, 'again' FROM orders WHERE o_orderstatus = 'O'),
b AS (
  SELECT l_orderkey AS id, l_returnflag || max(l_linestatus) AS name, max(CAST(l_shipdate AS DATE)) AS release_date,
         count(*) AS n_lines, sum(l_quantity) AS quantity
  FROM lineitem GROUP BY l_orderkey, l_returnflag),
a1 AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY name, release_date, status) = 1),
b1 AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY id ORDER BY name, release_date, n_lines, quantity) = 1)
SELECT coalesce(a1.id, b1.id) AS id,
       CASE WHEN b1.id IS NULL OR a1.name <= b1.name THEN a1.name ELSE b1.name END AS name,
       CASE WHEN b1.id IS NULL OR a1.name <= b1.name THEN a1.release_date ELSE b1.release_date END AS release_date,
       status, n_lines, round(quantity, {D}) AS quantity
FROM a1 FULL JOIN b1 ON a1.id = b1.id"""

_CREDITS = """credits AS (
  SELECT l_orderkey AS id, 0 AS pos, s_name AS a_name, 'sp-' || CAST(l_suppkey AS VARCHAR) AS a_ext_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  UNION ALL
  SELECT l_orderkey, 1, p_brand, 'br-' || p_brand
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
dic AS (
  SELECT a_ext_id, a_name, row_number() OVER (ORDER BY a_ext_id NULLS FIRST, a_name NULLS FIRST) AS a_id
  FROM (SELECT DISTINCT a_ext_id, a_name FROM credits))"""

SQL["bridge_explode"] = C.with_ctes(_CREDITS) + "SELECT id, pos, a_name, a_ext_id FROM credits"

SQL["enrich_dimension"] = C.with_ctes(C.ARTIST_GENRES, _CREDITS) + """
SELECT a_id, a_ext_id, a_name, ag.genres
FROM dic LEFT JOIN artist_genres ag ON a_name = ag.artists"""

SQL["dimension_bridge"] = C.with_ctes(_CREDITS) + """
SELECT id AS track_id, a_id AS artist_id FROM credits JOIN dic USING (a_ext_id, a_name)"""

SQL["distinct_profile"] = """
SELECT o_orderstatus, o_orderpriority, count(*) AS n_rows
FROM orders GROUP BY o_orderstatus, o_orderpriority"""

SQL["load_csv_audited"] = """
SELECT o_orderkey AS id, o_custkey AS album_id, o_orderstatus AS status, o_totalprice AS price,
       CASE WHEN o_orderstatus IS DISTINCT FROM 'P' THEN CAST(o_orderdate AS DATE) END AS release_date,
       o_orderpriority = '1-URGENT' AS explicit,
       CASE WHEN o_orderstatus IS DISTINCT FROM 'P' THEN 'good' ELSE 'quarantined' END AS row_state
FROM orders"""

SQL["load_keyed_files"] = C.with_ctes(C.HISTORY, C.PROFILE) + """
SELECT CAST(p_industry_id AS VARCHAR) AS office, CASE WHEN p_industry_id <> 3 THEN h_date END AS h_date,
       h_code, h_close, h_volume,
       CASE WHEN p_industry_id <> 3 THEN 'good' ELSE 'quarantined' END AS row_state
FROM history JOIN profile ON h_code = p_code"""

# Each cell is what stands between "<li>" and the next "</li>", cut into pieces
# at every "<" and ">": the pieces outside of tags are its text.
_CELL_TEXT = "array_to_string(list_transform(string_split(x, '<'), lambda t, i: CASE WHEN i = 1 THEN t ELSE substr(t, strpos(t, '>') + 1) END), '')"

SQL["parse_posts"] = r"""
SELECT CAST(user_id AS VARCHAR) AS t_code, date_trunc('minute', ts) AS t_date,
       'user' || CAST(user_id AS VARCHAR) AS t_author,
       trim(event_type || ',\n' || props) AS t_content
FROM events"""

# str.title on letters-only runs: first letter upper, rest lower
_TITLE = r"array_to_string(list_transform(regexp_extract_all({x}, '(\p{{L}}+|[^\p{{L}}]+)', 1), lambda w: upper(w[1]) || lower(w[2:])), '')"

SQL["parse_profiles"] = f"""
WITH first AS (SELECT l_suppkey, min(CAST(l_shipdate AS DATE)) AS first_ship FROM lineitem GROUP BY l_suppkey)
SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS company_name, s_name AS address,
       n_name AS country, {_TITLE.format(x="lower(r_name)")} AS sector,
       {_TITLE.format(x="lower(n_name)")} AS industry,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS acctbal,
       first_ship AS ipo_date, CAST(NULL AS VARCHAR) AS ceo
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN first ON s_suppkey = first.l_suppkey"""

_CELLS = f"""cells AS (
  SELECT page_id, list_transform(
           list_filter(string_split(html, '<li>')[2:], lambda x: contains(x, '</li>')),
           lambda y: trim(replace(list_transform([string_split(y, '</li>')[1]], lambda x: {_CELL_TEXT})[1], '&amp;', '&'))) AS c
  FROM pages),
pairs AS (
  SELECT page_id, CAST(i AS INTEGER) AS pair, c[2 * i + 1] AS code, c[2 * i + 2] AS name
  FROM (SELECT page_id, c, unnest(range(0, len(c) // 2)) AS i FROM cells) t)"""

SQL["extract_cells"] = C.with_ctes(_CELLS) + "SELECT page_id, pair, code, name FROM pairs"

# Words between blanks, without punctuation at their ends; where such a word
# still holds other signs, letters and digits are taken run by run.
SQL["post_search"] = C.with_ctes(_CELLS) + r""",
codes AS (
  SELECT DISTINCT code, regexp_replace(code, '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') AS bare FROM pairs WHERE code IS NOT NULL),
words AS (
  SELECT DISTINCT doc_id, unnest(string_split_regex(text, '[^\p{L}\p{N}./-]+')) AS w
  FROM documents WHERE lang = 'en' AND NOT starts_with(text, 'RT ')),
parts AS (SELECT DISTINCT doc_id, unnest(string_split_regex(w, '^[./-]+|[./-]+$|[./-]{2,}')) AS tok FROM words),
cuts AS (
  SELECT doc_id, tok, string_split_regex(tok, '[./-]') AS bits FROM parts WHERE tok <> ''),
forms AS (
  SELECT doc_id, tok, n, substr(tok, 1, CAST(list_sum(list_transform(bits[1:n], lambda b: len(b) + 1)) - 1 AS BIGINT)) AS form
  FROM (SELECT doc_id, tok, bits, unnest(range(1, len(bits) + 1)) AS n FROM cuts))
SELECT DISTINCT code, doc_id
FROM (SELECT code, doc_id, n, max(n) OVER (PARTITION BY doc_id, tok) AS longest FROM forms JOIN codes ON form = bare AND bare <> '')
WHERE n = longest"""

_COUNTRIES = sorted(country_codes().items())
_EXCHANGES = [*sorted(EXCHANGE_NAMES.items()), ("Moon Exchange", "Moon Exchange")]


def _texts(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


SQL["map_names"] = f"""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN n_name ELSE {_texts(c for _, c in _COUNTRIES)}[1 + c_custkey % {len(_COUNTRIES)}] END AS country,
       {_texts(e for _, e in _EXCHANGES)}[1 + (n_regionkey + c_custkey) % {len(_EXCHANGES)}] AS exchange
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

# Every ordered pair of artists on one track, themselves included.
_TOGETHER = """casts AS (SELECT track_id, list(artist_id) AS who FROM track_artists WHERE track_id IS NOT NULL GROUP BY track_id),
together AS (SELECT one, unnest(who) AS two FROM (SELECT who, unnest(who) AS one FROM casts))"""

SQL["cooccurrence_edges"] = C.with_ctes(C.TRACK_ARTISTS, _TOGETHER) + """
SELECT one AS artist_id, count(*) AS n_edges, (SELECT count(*) FROM casts WHERE list_contains(who, one)) AS n_groups
FROM together GROUP BY one"""

_SMOOTH = [("track_number", "a_track_number"), ("modality", "a_mode"), *((m[2:], m) for m in MEASURES)]
SQL["neighbor_smoothing"] = C.with_ctes(C.TRACK, C.TRACK_ARTISTS, _AM, _TOGETHER) + "SELECT one AS node, " + ", ".join(
    f"round(avg({c}), {D}) AS {o}" for o, c in _SMOOTH
) + " FROM together JOIN am ON a_id = two GROUP BY one"


def _scaled(table: str, columns: list[str]) -> str:
    """Columns over their sample deviation (0 where that is 0), and the audit."""
    shown = ", ".join(
        f"round(CASE WHEN stddev_samp({c}) OVER () > 0 THEN {c} / stddev_samp({c}) OVER () ELSE 0 END, {D}) AS scaled_{c}"
        for c in columns
    )
    return f"SELECT a_id, {shown}, true AS at_nearest_centre, CAST({P.KMEANS_K} AS BIGINT) AS n_clusters FROM {table}"


SQL["cluster_entities"] = C.with_ctes(C.TRACK, C.TRACK_ARTISTS, _AM) + _scaled("am", ["a_track_number", "a_mode", *MEASURES])

SQL["cluster_smoothed_entities"] = C.with_ctes(C.TRACK, C.TRACK_ARTISTS, _AM, _TOGETHER) + """,
smoothed AS (
  SELECT one AS a_id, """ + ", ".join(f"round(avg({c}), 9) AS {o}" for o, c in _SMOOTH) + """
  FROM together JOIN am ON a_id = two GROUP BY one)
""" + _scaled("smoothed", [o for o, _ in _SMOOTH])


# ---------------------------------------------------- stored tables and files

SQL["bucketed_star"] = C.with_ctes(C.TRACK, C.TRACK_ARTISTS) + f"""
SELECT t_id, s_name AS a_name, t_album, t_year, t_popularity, round(t_valence, {D}) AS t_valence
FROM track JOIN track_artists ON t_id = track_id JOIN supplier ON s_suppkey = artist_id"""

SQL["price_years"] = C.with_ctes(C.HISTORY) + f"""
SELECT h_code, h_date, round(CASE WHEN year(h_date) > {Y - 2} THEN 2 * h_close ELSE h_close END, {D}) AS h_close,
       round(h_volume, {D}) AS h_volume, CAST(year(h_date) AS INTEGER) AS h_year
FROM history WHERE year(h_date) >= {Y - 2} AND year(h_date) <= {Y}"""

SQL["fresh_build"] = f"""
SELECT o_custkey, count(*) + count(*) FILTER (WHERE o_orderkey % 2 = 0) AS n_orders,
       round(sum(CASE WHEN o_orderkey % 2 = 0 THEN 2 * o_totalprice ELSE o_totalprice END), {D}) AS total, 'B-B' AS builds
FROM orders GROUP BY o_custkey"""

# The stored model's clusters are the regions its features set apart.
SQL["similar_entities_kmeans"] = SQL["similar_entities"]

SQL["ordered_report"] = SQL["trend_runs"].replace("SELECT k AS stock,", "SELECT row_number() OVER (ORDER BY k, d1) AS position, true AS in_order, k AS stock,")

SQL["profile_files"] = SQL["parse_profiles"]

SQL["correlation_sql"] = C.with_ctes(C.BARS, C.POSTS, _DAILY) + f"""
SELECT stock, round(CASE WHEN min(price_fluctuation_percent) < max(price_fluctuation_percent) AND min(n_posts) < max(n_posts)
                         THEN corr(price_fluctuation_percent, n_posts) END, {D}) AS correlation_price_fluctuation_percent_n_posts
FROM day_figures WHERE price_fluctuation_percent IS NOT NULL AND n_posts IS NOT NULL
GROUP BY stock"""


def _half_up(sql: str, digits: int = D) -> str:
    """Rewrite ``round(x, digits)`` so DuckDB rounds like Spark does: half-up
    on the shortest decimal form of the double (DuckDB's own ``round`` scales
    the binary value, which differs exactly at the half-way points)."""
    key, out, i = "round(", [], 0
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        head, _, tail = inner.rpartition(",")
        out.append(sql[i:j])
        if tail.strip() == str(digits) and head:
            head = _half_up(head, digits)
            out.append(f"CAST(round(CAST(CAST({head} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)")
        else:
            out.append(sql[j:k])
        i = k


SQL = {name: _half_up(text) for name, text in SQL.items()}
