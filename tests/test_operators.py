"""Hand-made edge cases per operator (FIXTURES.md part C)."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frame_rows import rows
from rawhouse.functions import reciprocal_fill
from rawhouse.operators import entity as ent
from rawhouse.operators import graph as gr
from rawhouse.operators import ml
from rawhouse.operators import model as mdl
from rawhouse.operators import parse as prs
from rawhouse.operators import ranking as rk
from rawhouse.operators import timeseries as ts
from rawhouse.operators.percentile import percentiles
from rawhouse.sources import files

D = dt.date


# ------------------------------------------------------------------ sources

def test_read_csv_audited(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a.csv")
    with open(path, "w") as fh:
        fh.write("date,open\n2020-01-01,1.5\nbad,2\n2020-01-03,\n2020-01-04,3,9\n2020-01-05\n")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("open", T.DoubleType())])
    good, bad = files.read_csv_audited(spark, path, schema)
    assert rows(good) == [(D(2020, 1, 1), 1.5), (D(2020, 1, 3), None)]
    assert bad.count() == 3
    # counting only one column must not hide a malformed value in another
    assert good.select("open").count() == 2
    assert good.count() + bad.count() == 5
    kept = files.read_csv_audited(spark, path, schema, keep_corrupt=True).good
    assert kept.count() == 5
    both = files.read_csv_audited(spark, path, schema).rows
    assert rows(both.where("row_state = 'good'"), "date", "open") == rows(good)
    assert rows(both.where("row_state = 'quarantined'"), "date", "open") == rows(bad, "date", "open")
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_read_csv_header_check(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h.csv")
    with open(path, "w") as fh:
        fh.write("wrong,names\n2020-01-01,1.5\n")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("open", T.DoubleType())])
    with pytest.raises(Exception):
        files.read_csv_audited(spark, path, schema, enforce_header=True).good.collect()


def test_read_entity_csvs(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "ABC_hist.csv"), "w") as fh:
        fh.write("Date,Close\n2020-01-01,1.5\n2020-01-02,2.5\n")
    with open(os.path.join(tmp_dir, "X Y_hist.csv"), "w") as fh:
        fh.write("something else entirely\n")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("close", T.DoubleType())])
    good, bad = files.read_entity_csvs(spark, tmp_dir, schema, key_col="h_code", prefix="h_")
    assert rows(good) == [("ABC", D(2020, 1, 1), 1.5), ("ABC", D(2020, 1, 2), 2.5)]
    assert good.columns == ["h_code", "h_date", "h_close"]
    assert bad.count() == 0


def test_read_lines_keeps_bare_newlines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t.csv")
    with open(path, "w", newline="") as fh:
        fh.write('Stock,Date,Content,Author\r\nA,3/1/2020 7:05,"x, y\nz",Bob\r\nB,4/1/2020 8:00,plain,Ann\r\n')
    posts = prs.parse_posts(files.read_lines(spark, path))
    got = rows(posts)
    assert got == [
        ("A", dt.datetime(2020, 1, 3, 7, 5), "Bob", '"x, y\\nz"'),
        ("B", dt.datetime(2020, 1, 4, 8, 0), "Ann", "plain"),
    ]


def test_parse_posts_no_comma_in_rest(spark):
    df = spark.createDataFrame([("A,3/1/2020 7:05,onlyone",)], "value string")
    r = prs.parse_posts(df).first()
    assert (r["t_author"], r["t_content"]) == ("onlyone", "onlyone")


def test_parse_kv_profile(spark, tmp_dir):
    text = "x\ncode,ABC\nname,N/A\naddress,1 Main St, Suite 2\ncity,o'fallon\n"
    for i, t in enumerate([text, "x\ncode,\n"]):
        with open(os.path.join(tmp_dir, f"p{i}.txt"), "w") as fh:
            fh.write(t)
    df = files.read_whole_files(spark, tmp_dir)
    fields = {"code": 1, "name": 2, "address": 3, "city": 4, "missing": 40}
    out = prs.parse_kv_profile(df, fields)
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert ("ABC", None, "1 Main St", "o'fallon", None) in got
    assert (None, None, None, None, None) in got
    full = prs.parse_kv_profile(df, fields, keep_commas=["address"]).where("code = 'ABC'").first()
    assert full["address"] == "1 Main St, Suite 2"
    cleaned = prs.clean_profile(out).where("code = 'ABC'").first()
    assert cleaned["city"] == "O'Fallon"


def test_html_cell_pairs(spark):
    html = "<table><tr><td>A</td><td><b>Alpha</b></td></tr><tr><td class='x'>B</td><td>Beta</td></tr><tr><td>C</td></tr></table>"
    df = spark.createDataFrame([(1, html), (2, None), (3, "<p>none</p>")], "id int, html string")
    assert rows(prs.html_cell_pairs(df, "html", ["id"])) == [(1, 0, "A", "Alpha"), (1, 1, "B", "Beta")]


def test_match_posts(spark):
    posts = spark.createDataFrame(
        [(1, "buy $ABC now $ABC", "en"), (2, "RT $ABC", "en"), (3, "$ABCD", "en"), (4, "$ABC", "fr")],
        "id int, text string, lang string",
    )
    codes = spark.createDataFrame([("ABC",), ("ABC",)], "code string")
    out = prs.match_posts(posts, codes, "text", ["id"], lang_col="lang", lang="en")
    assert rows(out) == [("ABC", 1)]


# ---------------------------------------------------------------- modelling

def test_build_dictionary_nulls(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("a", "x"), ("a", "x"), (None, "x")], "s string, i string")
    assert rows(mdl.build_dictionary(df, "s", "i")) == [("a", "x", 1), ("a", "y", 2), ("b", "x", 3)]
    kept = rows(mdl.build_dictionary(df, "s", "i", drop_nulls=False))
    assert kept == [("a", "x", 2), ("a", "y", 3), ("b", "x", 4), (None, "x", 1)]


def test_build_dictionary_equals_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 997).alias("a"), (F.col("id") % 13).alias("b"))
    ours = mdl.build_dictionary(df, "a", "b", num_partitions=7)
    ref = df.distinct().withColumn("id", F.row_number().over(Window.orderBy("a", "b")))
    assert rows(ours) == rows(ref.select("a", "b", "id"))
    ids = [r[0] for r in ours.select("id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_normalize_reciprocal(spark):
    prof = spark.createDataFrame([("p1", None, "Banks"), ("p2", "Tech", "Chips"), ("p3", None, None)],
                                 "code string, sector string, industry string")
    s_, i_ = reciprocal_fill("sector", "industry")
    filled = prof.select("code", s_.alias("sector"), i_.alias("industry"))
    dic = mdl.build_dictionary(filled, "sector", "industry")
    out = mdl.normalize(prof, dic, ["sector", "industry"], fill_reciprocal=True)
    got = {r["code"]: r["id"] for r in out.collect()}
    assert got["p1"] is not None and got["p2"] is not None and got["p3"] is None
    assert out.count() == prof.count()


def test_dimension_from_texts_equals_the_exploded_form(spark):
    facts = spark.createDataFrame(
        [(i, "['A', 'B']", "['1', '2']") for i in range(40)] + [(50, "['A']", None), (51, None, None), (52, "broken", "['1']"), (53, "['C', 'A']", "['3']"),
         (54, "[]", "[]"), (50, "['A']", None), (None, "['A', 'A']", "['1', '1']")],
        "id int, artists string, artist_ids string",
    )
    genres = spark.createDataFrame([("A", "['x']"), ("A", "['y']"), ("C", None)], "artists string, genres string")
    exploded = mdl.explode_zipped(facts, "id", {"a_name": "artists", "a_ext_id": "artist_ids"}, pos_col=None)
    want = mdl.build_dimension(exploded, genres)
    got = mdl.build_dimension_from_texts(facts, genres)
    assert rows(got[0]) == rows(want[0]) and rows(got[1]) == rows(want[1])
    assert got[0].count() > 4 and got[1].count() == exploded.count()


def test_merge_sources_takes_whole_records(spark):
    a = spark.createDataFrame(
        [(1, "zeta", 5, "A1"), (2, "b", 1, "A2"), (2, "a", 9, "A2bis"), (4, None, 2, "A4"), (4, "x", 1, "A4x"), (5, "s", 1, "A5")],
        "id int, name string, n int, only_a string",
    )
    b = spark.createDataFrame(
        [(1, "alpha", 6, 10), (1, "beta", 1, 1), (3, "c", 7, 30), (5, "s", 0, 50)], "id int, name string, n int, only_b int"
    )
    got = rows(mdl.merge_sources(a, b, "id"))
    assert got == [
        (1, "alpha", 6, "A1", 10), (2, "a", 9, "A2bis", None), (3, "c", 7, None, 30), (4, None, 2, "A4", None), (5, "s", 1, "A5", 50),
    ]
    plan = mdl.merge_sources(a, b, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan
    assert rows(mdl.merge_sources(a.limit(0), b.limit(0), "id")) == []


def test_explode_zipped(spark):
    df = spark.createDataFrame(
        [(1, "['a', 'b']", "['1']"), (2, "['a']", None), (3, "[oops", "['1']")],
        "id int, names string, ids string",
    )
    out = mdl.explode_zipped(df, "id", {"name": "names", "ext": "ids"}, pos_col=None)
    assert rows(out) == [(1, "a", "1"), (1, "b", None), (2, "a", None), (3, None, "1")]
    dropped = mdl.explode_zipped(df, "id", {"name": "names", "ext": "ids"}, pos_col=None, drop_null="name")
    assert (3, None, "1") not in rows(dropped)
    unpadded = mdl.explode_zipped(df, "id", {"name": "names", "ext": "ids"}, pad=False, pos_col=None)
    assert rows(unpadded) == [(1, "a", "1"), (1, "b", None)]


def test_build_dimension(spark):
    bridge = spark.createDataFrame(
        [(1, "Ann", "s1"), (1, "Bob", None), (2, "Ann", "s1")], "id int, a_name string, a_ext_id string"
    )
    genres = spark.createDataFrame([("Ann", "['pop']"), ("Ann", "['rock']")], "artists string, genres string")
    dim, br = mdl.build_dimension(bridge, genres)
    assert rows(dim) == [(1, None, "Bob", None), (2, "s1", "Ann", ["pop"])]
    assert rows(br) == [(1, 1), (1, 2), (2, 2)]


def test_distinct_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "x string, y int")
    assert rows(mdl.distinct_profile(df, "x")) == [("a", 2), (None, 1)]
    assert rows(mdl.distinct_profile(df, "x", drop_nulls=True)) == [("a", 2)]
    assert [tuple(r) for r in mdl.distinct_profile(df, "x", limit=1).collect()] == [(None, 1)]


# ---------------------------------------------------------------- time series

def test_moving_average(spark):
    df = spark.createDataFrame([("k", D(2020, 1, d), float(d)) for d in range(1, 6)], "k string, d date, v double")
    got = [r["moving_average"] for r in ts.moving_average(df, "k", "d", "v", 2).orderBy("d").collect()]
    assert got == [1.0, 1.5, 2.0, 3.0, 4.0]


def _indicator_frame(spark, seq):
    return spark.createDataFrame(
        [("k", D(2020, 1, i + 1), "up" if c == "u" else "down", float(i + 1)) for i, c in enumerate(seq)],
        "k string, d date, indicator string, v double",
    )


def test_indicator_runs_lag(spark):
    df = _indicator_frame(spark, "uuddduud")
    got = rows(ts.indicator_runs(df, "k", "d"))
    assert got == [("k", 1, D(2020, 1, 6), D(2020, 1, 7), "up"), ("k", 2, D(2020, 1, 3), D(2020, 1, 5), "down")]


def test_indicator_runs_lead(spark):
    df = _indicator_frame(spark, "uuddduud")
    got = rows(ts.indicator_runs(df, "k", "d", "v", anchor="lead"))
    assert got == [
        ("k", 1, D(2020, 1, 6), D(2020, 1, 7), "up", 6.0, 7.0),
        ("k", 2, D(2020, 1, 3), D(2020, 1, 5), "down", 3.0, 5.0),
    ]


def test_trend_runs_never_overlap(spark):
    base = D(2018, 1, 1)
    data = [("k", base + dt.timedelta(days=i), 100 + 10 * math.sin(i / 9)) for i in range(1200)]
    df = spark.createDataFrame(data, "k string, d date, v double")
    runs = sorted(ts.trend_runs(df, "k", "d", "v", 5, 2020).collect(), key=lambda r: r["period_start_date"])
    assert runs
    for a, b in zip(runs, runs[1:]):
        assert a["period_end_date"] < b["period_start_date"]
        assert a["trend"] != b["trend"]


def test_grouped_corr(spark):
    data = [("line", float(i), 2.0 * i + 1) for i in range(5)]
    data += [("const", float(i), 3.0) for i in range(4)]
    data += [("single", 1.0, 2.0)]
    data += [("nulls", 1.0, None), ("nulls", 2.0, 4.0), ("nulls", 3.0, 6.0)]
    df = spark.createDataFrame(data, "k string, a double, b double")
    got = {r["k"]: r["correlation_a_b"] for r in ts.grouped_corr(df, "k", "a", "b").collect()}
    assert abs(got["line"] - 1.0) < 1e-12 and abs(got["nulls"] - 1.0) < 1e-12
    assert got["const"] is None and got["single"] is None


def test_daily_metrics_zero_open(spark):
    bars = spark.createDataFrame([(1, D(2024, 1, 1), 0.0, 5.0, 1.0, 4.0, 10.0)],
                                 "h_code int, h_date date, h_open double, h_high double, h_low double, h_close double, h_volume double")
    posts = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 9), "x"), (1, dt.datetime(2024, 1, 2, 9), "y")],
                                  "t_code int, t_date timestamp_ntz, t_content string")
    r = ts.daily_metrics(bars, posts).collect()
    assert len(r) == 1 and r[0]["price_difference_percent"] is None and r[0]["n_posts"] == 1


# ---------------------------------------------------------------- rankings

def test_label_frequency(spark):
    df = spark.createDataFrame([(0,), (-1,), (None,), (12,), (0,)], "t_key int")
    assert rows(rk.label_frequency(df, "t_key")) == [(1, "Unknown"), (1, "Unknown"), (1, "Unknown"), (2, "C")]


def test_tag_frequency(spark):
    df = spark.createDataFrame([([],), (None,), (["x", "y"],)], "genres array<string>")
    assert rows(rk.tag_frequency(df, "genres")) == [(1, "x"), (1, "y")]


def test_percentile_board(spark):
    df = spark.createDataFrame([("a", i) for i in range(1, 11)] + [("b", 3), ("c", None)], "name string, pop int")
    got = {g[3]: g[:3] for g in rows(rk.percentile_board(df, "name", "pop"))}
    assert got["a"][0] == 10 and got["a"][1:] == pytest.approx((9.1, 5.5))
    assert got["b"] == (3, 3.0, 3.0) and got["c"] == (None, None, None)


PERCENTILES = [("p50", "v", 0.5), ("p90", "v", 0.9), ("p0", "v", 0.0), ("p100", "v", 1.0), ("w33", "w", 1 / 3)]


def skewed(spark):
    """One hot group, groups of many sizes, of equal values, of NULLs only, and a
    NULL group key."""
    hot = spark.range(0, 60000).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 17771 / 3.0).alias("v"))
    parts = [hot]
    for n in (1, 2, 3, 19, 20, 21, 22, 199, 200, 201, 202, 9999, 10001, 10002):
        parts.append(spark.range(0, n).select(F.lit(f"n{n}").alias("g"), (F.col("id") * 31 % 101 * 1.1).alias("v")))
    parts.append(spark.range(0, 12000).select(F.lit("equal").alias("g"), F.lit(0.028).alias("v")))
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    df = df.unionByName(spark.createDataFrame([("hot", None), ("nulls", None), ("nulls", None), (None, 4.0), (None, 8.0)], "g string, v double"))
    return df.withColumn("w", -F.col("v"))


def same_percentiles(df, got, specs):
    ref = {r["g"]: r for r in df.groupBy("g").agg(*[F.percentile(c, p).alias(n) for n, c, p in specs]).collect()}
    got = {r["g"]: r for r in got.collect()}
    assert got.keys() == ref.keys()
    for g in ref:
        for n, _, _ in specs:
            a, b = got[g][n], ref[g][n]
            assert a == b or a != a and b != b or abs(a - b) <= 1e-12 * max(abs(a), abs(b)), (g, n, a, b)
    return got


@pytest.mark.parametrize("gather", [2, 200, 100_000])
def test_percentiles_equal_the_built_in(spark, gather):
    """Gathered at once, after a round of counting, and after several."""
    df = skewed(spark)
    for stored in (False, True):
        got = same_percentiles(df, percentiles(df, ["g"], PERCENTILES, stored=stored, gather=gather), PERCENTILES)
        assert got["nulls"]["p50"] is None and got["equal"]["p90"] == 0.028


def test_percentiles_of_extreme_values(spark):
    """Heavy tails, both signs, zeros, infinities, NaN, neighbouring doubles, ties."""
    extreme = [0.0, -0.0, 1e-300, -1e-300, 5e-324, 1e308, -1e308, float("inf"), float("-inf"), float("nan")]
    near = [1.0 + i * 2.0**-52 for i in range(300)]
    data = [("mixed", v) for v in extreme * 7 + [(-1.0) ** i * 10.0 ** (i % 600 - 300) for i in range(900)]]
    data += [("near", v) for v in near * 2] + [("ties", 3.5)] * 400 + [("ties", float(i)) for i in range(9)]
    data += [("inf", float("inf"))] * 30 + [("nan", float("nan"))] * 30 + [(None, v) for v in near]
    df = spark.createDataFrame(data, "g string, v double")
    specs = [(f"p{i}", "v", i / 20) for i in range(21)]
    same_percentiles(df, percentiles(df, ["g"], specs, gather=8), specs)


def test_a_group_is_only_gathered_below_the_bound(spark):
    """What is gathered of one group stays below the bound whatever its size."""
    from rawhouse.operators import percentile as pc

    df = spark.range(0, 30000).select(F.lit("hot").alias("g"), F.exp(F.col("id") % 9973 / 7.0).alias("v"))
    seen = []
    real = pc._settled

    def settled(values, done, *rest):
        seen.extend(r["_inside"] for r in done.where("_lo < _hi").collect())
        return real(values, done, *rest)

    pc._settled = settled
    try:
        same_percentiles(df, percentiles(df, ["g"], [("m", "v", 0.37)], gather=100), [("m", "v", 0.37)])
    finally:
        pc._settled = real
    assert seen and max(seen) <= 100


def test_percentiles_of_nothing(spark):
    assert percentiles(skewed(spark).limit(0), ["g"], PERCENTILES).collect() == []


def test_approx_options_pass_through(spark):
    df = spark.createDataFrame([("a", i) for i in range(1, 101)], "name string, pop int")
    board = rk.percentile_board(df, "name", "pop", method="approx").first()
    assert board["popularity"] == 100 and abs(board["popularity50"] - 50) <= 1
    ef = spark.createDataFrame([(1, i, True) + (float(i),) * 9 for i in range(1, 11)],
                               "a_id int, t_id int, t_mode boolean, " + ", ".join(f"{c} double" for c in ent.MEASURES.values()))
    row = ent.entity_measures(ef, method="approx").first()
    assert row["a_track_number"] == 10 and row["a_mode"] == 1.0 and row["a_tempo"] in (5.0, 6.0)


def test_approx_percentiles_close(spark):
    df = spark.range(0, 10000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    got = {r["g"]: r["m"] for r in percentiles(df, ["g"], [("m", "v", 0.5)], method="approx").collect()}
    assert abs(got[0] - 5000) <= 10 and abs(got[1] - 5000) <= 10


# ---------------------------------------------------------------- entities / graph

def test_entity_measures_equal_the_built_in(spark):
    data = [(i % 3 if i % 7 else 0, i, i % 2 == 0 if i % 5 else None) + tuple(float((i * (j + 3)) % 11) if (i + j) % 4 else None for j in range(9))
            for i in range(200)] + [(9, 1000, None) + (None,) * 9]
    cols = "a_id int, t_id int, t_mode boolean, " + ", ".join(f"{c} double" for c in ent.MEASURES.values())
    ef = spark.createDataFrame(data, cols)
    got = {r["a_id"]: r for r in ent.entity_measures(ef).collect()}
    want = {r["a_id"]: r for r in ef.groupBy("a_id").agg(
        F.count("t_id").alias("a_track_number"), F.avg(F.when(F.col("t_mode"), 1).otherwise(0)).alias("a_mode"),
        *[F.percentile(c, 0.5).alias(o) for o, c in ent.MEASURES.items()]).collect()}
    assert got.keys() == want.keys() == {0, 1, 2, 9}
    for k in want:
        for c in ["a_track_number", "a_mode", *ent.MEASURES]:
            assert got[k][c] == pytest.approx(want[k][c]), (k, c)
    assert got[9]["a_tempo"] is None


def test_similar_entities(spark):
    dim = spark.createDataFrame(
        [(1, "T", ["rock", "pop"]), (2, "P", ["pop"]), (3, "Q", ["jazz"]), (4, "R", None), (5, "S", ["pop"])],
        "a_id int, a_name string, genres array<string>",
    )
    clusters = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 0), (5, 1)], "a_id int, prediction int")
    meas = spark.createDataFrame([(i, 10 * i, 0.5) + (0.1,) * 9 for i in range(1, 6)],
                                 "a_id int, a_track_number long, a_mode double, " + ", ".join(f"{m} double" for m in ent.MEASURES))
    peers = ent.cluster_peers(dim, clusters, "a_name", "T")
    out = ent.similar_entities(dim, peers, meas, "a_name")
    assert [r["artist_name"] for r in out.collect()] == ["P"]


def test_attribute_peers(spark):
    df = spark.createDataFrame([("A", "x"), ("B", "x"), ("C", "None"), ("D", "None"), ("E", None)], "code string, ceo string")
    assert rows(ent.attribute_peers(df, "code", "ceo", "A")) == [("A", "B", "x")]
    assert rows(ent.attribute_peers(df, "code", "ceo", "C")) == []


def test_cooccurrence_and_smoothing(spark):
    bridge = spark.createDataFrame([("t1", "a"), ("t1", "b"), ("t2", "a"), ("t3", "c")], "track_id string, artist_id string")
    deg = {r["artist_id"]: (r["n_edges"], r["n_groups"]) for r in gr.cooccurrence_degree(bridge).collect()}
    # edges with self loops: (a,a)x2, (a,b), (b,a), (b,b), (c,c)
    assert deg == {"a": (3, 2), "b": (2, 1), "c": (1, 1)}
    feats = spark.createDataFrame([("a", 0.0), ("b", 3.0), ("c", 7.0)], "a_id string, f double")
    sm = {r["node"]: r["f"] for r in gr.smooth_features(bridge, feats, "a_id", {"f": "f"}).collect()}
    assert sm == {"a": 1.0, "b": 1.5, "c": 7.0}


def test_cluster_repeatable(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 3)) for i in range(60)], "id int, x double, y double")
    a = rows(ml.cluster(df, "id", k=4, seed=3))
    b = rows(ml.cluster(df, "id", k=4, seed=3))
    assert a == b and len(a) == 60 and len({p for _, p in a}) <= 4


def test_cluster_refuses_more_clusters_than_points(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "id int, x double")
    with pytest.raises(ValueError, match="distinct points"):
        ml.cluster(df, "id", k=5)
    found = ml.fit_clusters(df, "id", k=3)
    assert found.assigned.where(~ml.at_nearest_centre(found)).count() == 0
    wrong = found._replace(assigned=found.assigned.withColumn("prediction", (F.col("prediction") + 1) % 3))
    assert wrong.assigned.where(~ml.at_nearest_centre(wrong)).count() == 30


def test_cell_text_as_a_parser_sees_it(spark):
    html = """<td>AT&amp;T</td><td a=">">Y<!-- > </td> --></td><td>&amp;lt; &#8364;&#x41;</td><td title='x>y'>&eacute; &unknown; &#0;</td>"""
    df = spark.createDataFrame([(1, html)], "id int, html string")
    assert rows(prs.html_cell_pairs(df, "html", ["id"])) == [(1, 0, "AT&T", "Y"), (1, 1, "&lt; \u20acA", "\u00e9 &unknown; \ufffd")]


def test_every_reference_is_decoded(spark):
    import html.entities

    texts = [
        "M&uuml;ller &ouml;&auml;&szlig; &ntilde;&aacute; &egrave; 3 &times; 4", "&#38;lt; &amp;#60; &#38;amp;amp;", "&eacute &notit; &AMP &unknown; &; & &#; &#x;",
        "&#150; &#x80; &#x81; &#0; &#xD800; &#x10FFFD; &#1114112; &#99999999999999999999; &#x000000041; &#0000000000065 &#65z", "a\\b $1 &dollar;",
        "", "plain",
    ] + [f"x&{n}y" if n.endswith(";") else f"x&{n} y" for n in html.entities.html5]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "id int, t string")
    got = dict(rows(df.select("id", prs.decode_references(F.col("t")))))
    want = {i: html.unescape(t) for i, t in enumerate(texts)} | {-1: None}
    assert [(texts[i], got[i], want[i]) for i in want if got[i] != want[i]] == []
    cells = spark.createDataFrame([(1, "<li>M&uuml;&szlig;</li><li>Espa&ntilde;a &#38;lt;</li>")], "id int, html string")
    assert rows(prs.html_cell_pairs(cells, "html", ["id"], tag="li")) == [(1, 0, "Müß", "España &lt;")]


def test_match_posts_with_punctuated_codes(spark):
    posts = spark.createDataFrame(
        [(1, "$BRK.B up"), (2, "$BRK."), (3, "$BRK.C, $BF-B."), (4, "$BRKB"), (5, "$RDS/A $A.B.C")], "id int, text string"
    )
    codes = spark.createDataFrame([("BRK",), ("BRK.B",), ("BF-B",), ("RDS/A",), ("A.B",), ("A",), ("la,",), (None,)], "code string")
    got = rows(prs.match_posts(posts, codes, "text", ["id"]))
    assert got == [("A.B", 5), ("BF-B", 3), ("BRK", 2), ("BRK", 3), ("BRK.B", 1), ("RDS/A", 5)]
    plain = spark.createDataFrame([(1, "dans la, rue")], "id int, text string")
    assert rows(prs.match_posts(plain, codes, "text", ["id"], prefix="")) == [("la,", 1)]


def test_audited_reads_parse_every_column(spark, tmp_dir):
    from pyspark.sql import types as T

    from rawhouse.sources import files

    path = f"{tmp_dir}/a.csv"
    with open(path, "w") as f:
        f.write("id,n,d\n1,2,2020-01-01\n2,x,2020-01-02\n3,4,never\n4,5,2020-01-04\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("d", T.DateType())])
    for materialized in (False, True):
        read = files.read_csv_audited(spark, path, schema, materialized=materialized)
        assert rows(read.good.select("id")) == [(1,), (4,)]
        assert rows(read.quarantine.select("id")) == [(2,), (3,)]
        assert read.good.count() + read.quarantine.select("id").count() == 4
