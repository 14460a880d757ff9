"""Spark SQL forms of the analysis queries for SQL users.

Values and identifiers are passed as named parameters (``spark.sql(args=)``)
and ``IDENTIFIER(:t)`` -- never spliced into the text -- so names such as
``O'Connor`` cannot break or inject into a statement.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

MOVING_AVERAGE = """
SELECT h_date, h_close,
       avg(h_close) OVER (PARTITION BY h_code ORDER BY h_date
                          ROWS BETWEEN :period PRECEDING AND CURRENT ROW) AS moving_average
FROM IDENTIFIER(:history)
WHERE h_code = :code AND h_date >= :year_start AND h_date < :year_end
"""

def moving_average_sql(spark: SparkSession, history: str, code, year: int, period: int) -> DataFrame:
    """Closing value and its trailing mean for one entity in one year."""
    return spark.sql(MOVING_AVERAGE, args={
        "history": history, "code": code, "period": period,
        "year_start": dt.date(year, 1, 1), "year_end": dt.date(year + 1, 1, 1),
    })


TREND_RUNS = """
WITH states AS (
  SELECT h_code, h_date, round(avg(h_close) OVER short_span, 9) > round(avg(h_close) OVER long_span, 9) AS rising
  FROM IDENTIFIER(:history)
  WHERE h_date >= :window_start AND h_date < :window_end
  WINDOW short_span AS (PARTITION BY h_code ORDER BY h_date ROWS BETWEEN :period PRECEDING AND CURRENT ROW),
         long_span AS (PARTITION BY h_code ORDER BY h_date ROWS BETWEEN :long_period PRECEDING AND CURRENT ROW)),
turns AS (
  SELECT *, rising <> lag(rising) OVER (PARTITION BY h_code ORDER BY h_date) AS turned
  FROM states WHERE h_date >= :report_start),
numbered AS (
  SELECT *, count_if(turned) OVER (PARTITION BY h_code ORDER BY h_date) AS run FROM turns),
runs AS (
  SELECT h_code, run, any_value(rising) AS rising, min(h_date) AS began, max(h_date) AS ended,
         max(run) OVER (PARTITION BY h_code) AS open_run
  FROM numbered GROUP BY h_code, run)
SELECT h_code AS stock, datediff(ended, began) AS period, began AS period_start_date, ended AS period_end_date,
       if(rising, 'up', 'down') AS trend
FROM runs WHERE run > 0 AND run < open_run
"""


def trend_runs_sql(spark: SparkSession, history: str, year: int, period: int) -> DataFrame:
    """Up/down runs over the last three years (numbered by turns, one shuffle by key)."""
    return spark.sql(TREND_RUNS, args={
        "history": history, "period": period, "long_period": 2 * period,
        "window_start": dt.date(year - 3, 1, 1), "window_end": dt.date(year + 1, 1, 1),
        "report_start": dt.date(year - 2, 1, 1),
    })


GROUPED_CORR = """
SELECT IDENTIFIER(:key) AS entity,
       try_divide(covar_pop(IDENTIFIER(:col_a), IDENTIFIER(:col_b)),
                  stddev_pop(IDENTIFIER(:col_a)) * stddev_pop(IDENTIFIER(:col_b))) AS correlation
FROM IDENTIFIER(:daily)
WHERE IDENTIFIER(:col_a) IS NOT NULL AND IDENTIFIER(:col_b) IS NOT NULL
GROUP BY IDENTIFIER(:key)
"""


def grouped_corr_sql(spark: SparkSession, daily: str, key: str, col_a: str, col_b: str) -> DataFrame:
    """Correlation of two columns per entity; the table and the columns are named by
    the caller."""
    out = spark.sql(GROUPED_CORR, args={"daily": daily, "key": key, "col_a": col_a, "col_b": col_b})
    return out.withColumnsRenamed({"entity": key, "correlation": f"correlation_{col_a}_{col_b}"})


SIMILAR_ENTITIES = """
WITH target AS (
  SELECT c.prediction, d.a_id, d.genres FROM IDENTIFIER(:dim) d JOIN IDENTIFIER(:clusters) c USING (a_id)
  WHERE d.a_name = :name)
SELECT d.a_name AS artist_name, d.genres, m.a_track_number AS track_number, m.a_mode AS modality,
       m.a_acousticness AS acousticness, m.a_danceability AS danceability, m.a_energy AS energy,
       m.a_loudness AS loudness, m.a_speechiness AS speechiness, m.a_instrumentalness AS instrumentalness,
       m.a_liveness AS liveness, m.a_valence AS valence, m.a_tempo AS tempo
FROM IDENTIFIER(:dim) d JOIN IDENTIFIER(:clusters) c USING (a_id) JOIN IDENTIFIER(:measures) m USING (a_id)
JOIN target t ON c.prediction = t.prediction AND c.a_id <> t.a_id AND arrays_overlap(d.genres, t.genres)
ORDER BY m.a_track_number DESC, d.a_name
LIMIT :k
"""


def similar_entities_sql(
    spark: SparkSession, dim: str, clusters: str, measures: str, name: str, k: int = 10
) -> DataFrame:
    """Entities of the target's cluster that share a tag with it; the cluster table
    (plain or smoothed features) is named by the caller."""
    return spark.sql(SIMILAR_ENTITIES, args={"dim": dim, "clusters": clusters, "measures": measures, "name": name, "k": k})
