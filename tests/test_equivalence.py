"""Our formulations against the definitions and Spark's own functions."""

import os

import pytest
from pyspark.sql import functions as F

from rawhouse.operators import timeseries as ts
from rawhouse.plans import params as P
from rawhouse.plans import standins as S

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def runs_by_definition(days, n, year):
    """(start, end, trend) of the inner spells of one entity's (date, value) list."""
    days = sorted(d for d in days if year - 3 <= d[0].year <= year)
    states = []
    for i, (day, _) in enumerate(days):
        short = [v for _, v in days[max(0, i - n) : i + 1]]
        long = [v for _, v in days[max(0, i - 2 * n) : i + 1]]
        if day.year >= year - 2:
            states.append((day, round(sum(short) / len(short), 9) > round(sum(long) / len(long), 9)))
    spells = []
    for day, rising in states:
        if spells and spells[-1][2] == rising:
            spells[-1][1] = day
        else:
            spells.append([day, day, rising])
    return [(a, b, "up" if rising else "down") for a, b, rising in spells[1:-1]]


def test_trend_runs_by_definition(spark):
    hist = S.history(spark, SF)
    series = {}
    for r in hist.select("h_code", "h_date", "h_close").collect():
        series.setdefault(r[0], []).append((r[1], r[2]))
    want = [
        (code, (b - a).days, a, b, trend)
        for code, days in series.items()
        for a, b, trend in runs_by_definition(days, P.PERIOD, P.TARGET_YEAR)
    ]
    ours = ts.trend_runs(hist, "h_code", "h_date", "h_close", P.PERIOD, P.TARGET_YEAR, out_key="stock")
    assert ours.columns == ["stock", "period", "period_start_date", "period_end_date", "trend"]
    assert sorted(map(tuple, ours.collect())) == sorted(want)


def test_grouped_corr_equals_corr(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    ours = {r[0]: r[1] for r in ts.grouped_corr(df, "l_suppkey", "l_quantity", "l_extendedprice").collect()}
    ref = {r[0]: r[1] for r in df.groupBy("l_suppkey").agg(F.corr("l_quantity", "l_extendedprice")).collect()}
    assert ours.keys() == ref.keys()
    assert all(ours[k] == pytest.approx(ref[k], abs=1e-12) for k in ref)


def test_trend_runs_sql_form(spark):
    from rawhouse.plans.sql_forms import trend_runs_sql

    hist = S.history(spark, SF)
    hist.createOrReplaceTempView("eq_history")
    ours = ts.trend_runs(hist, "h_code", "h_date", "h_close", P.PERIOD, P.TARGET_YEAR, out_key="stock")
    sql = trend_runs_sql(spark, "eq_history", P.TARGET_YEAR, P.PERIOD)
    assert sql.columns == ours.columns
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, ours.collect()))
