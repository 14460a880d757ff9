"""The end-to-end build jobs on a tiny raw folder in the original layout."""

import datetime as dt
import os

from pyspark.sql import functions as F

from rawhouse.plans import analysis as an
from rawhouse.plans import warehouse as wh


def _profile(code, fields):
    lines = [f"field{i},x" for i in range(32)]
    lines[wh.PROFILE_FIELDS["code"]] = f"Symbol,{code}"
    for name, value in fields.items():
        lines[wh.PROFILE_FIELDS[name]] = f"{name},{value}"
    return "\n".join(lines) + "\n"


def test_equity_warehouse(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "profile"))
    os.makedirs(os.path.join(tmp_dir, "history"))
    profiles = {
        "AAA": {"sector": "technology", "industry": "chips", "country": "United States", "city": "san josé",
                "exchange": "NasdaqGS", "ceo": "Ann", "ipo_date": "1999-05"},
        "BBB": {"sector": "N/A", "industry": "banks", "country": "Atlantis", "ceo": "Ann"},
        "CCC": {"sector": "", "industry": ""},
    }
    for code, f in profiles.items():
        with open(os.path.join(tmp_dir, "profile", f"{code}.txt"), "w") as fh:
            fh.write(_profile(code, f))
    with open(os.path.join(tmp_dir, "history", "AAA_hist.csv"), "w") as fh:
        fh.write("Date,Open,High,Low,Close,Volume,Dividends,Stock Splits\n"
                 "2020-01-02,1,2,0.5,1.5,100,0,0\n2021-01-04,2,3,1,2.5,200,0,0\nbroken,1,1,1,1,1,1,1\n")
    with open(os.path.join(tmp_dir, "Tweet.csv"), "w", newline="") as fh:
        fh.write('Stock,Date,Content,Author\r\nAAA,3/1/2020 7:05,"buy, now\nplease",Bob\r\n'
                 'AAA,2020-01-04 09:30:00,sell,Ann\r\n')
    names = wh.build_equity_warehouse(spark, tmp_dir, database="rh_eq_test", mode="overwrite")
    prof = {r["p_code"]: r for r in spark.table(names["profile"]).collect()}
    ind = {r["id"]: (r["sector"], r["industry"]) for r in spark.table(names["industry"]).collect()}
    assert ind[prof["AAA"]["p_industry_id"]] == ("Technology", "Chips")
    assert ind[prof["BBB"]["p_industry_id"]] == ("Banks", "Banks")  # filled from each other
    assert prof["CCC"]["p_industry_id"] is None
    assert prof["AAA"]["p_country"] == "US" and prof["AAA"]["p_city"] == "San José"
    assert prof["AAA"]["p_exchange"] == "NASDAQ Global Select"
    assert prof["AAA"]["p_ipo_date"] == dt.date(1999, 5, 1)
    hist = spark.table(names["history"])
    assert hist.count() == 2 and spark.table(names["history_quarantine"]).count() == 1
    assert hist.where("h_year = 2021").count() == 1
    tw = {r["t_author"]: r for r in spark.table(names["tweets"]).collect()}
    assert (tw["Bob"]["t_code"], tw["Bob"]["t_content"]) == ("AAA", '"buy, now\\nplease"')
    assert tw["Ann"]["t_date"] == dt.datetime(2020, 1, 4, 9, 30)

    db = "rh_eq_test"
    card = an.stock_info(spark, "AAA", db).first()
    assert (card["sector"], card["industry"], card["country"]) == ("Technology", "Chips", "US")
    assert [r["h_close"] for r in an.close_vs_moving_average(spark, "AAA", 2020, 5, db).collect()] == [1.5]
    assert [(r["me"], r["peer"], r["ceo"]) for r in an.same_ceo(spark, "AAA", db).collect()] == [("AAA", "BBB", "Ann")]
    year_plan = an.close_vs_moving_average(spark, "AAA", 2020, 5, db)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(h_year" in year_plan  # other years' folders are pruned
    assert [(r["p_code"], r["avg_volume"]) for r in an.top_volume(spark, 2021, database=db).collect()] == [("AAA", 200.0)]
    for df in (an.posts_correlation(spark, database=db), an.trend_report(spark, 2021, 5, db),
               an.industry_trend_report(spark, 2021, 5, db), an.sector_trend_report(spark, 2021, 5, db)):
        df.collect()
    spark.sql("DROP SCHEMA rh_eq_test CASCADE")


def test_music_warehouse(spark, tmp_dir):
    a_cols = [f.name for f in wh.TRACKS_A_SCHEMA.fields]
    b_cols = [f.name for f in wh.TRACKS_B_SCHEMA.fields]

    def row(cols, values):
        return ",".join(values.get(c, "1") for c in cols)

    with open(os.path.join(tmp_dir, "tracks_features.csv"), "w") as fh:
        fh.write(",".join(a_cols) + "\n")
        fh.write(row(a_cols, {"id": "t1", "name": "Song", "artists": "\"['Ann', 'Bob']\"",
                              "artist_ids": "\"['x1', 'x2']\"", "explicit": "true", "mode": "1",
                              "release_date": "2001-02-03", "album": "A", "album_id": "al"}) + "\n")
        fh.write(row(a_cols, {"id": "t2", "name": "Zed", "artists": "\"['Ann']\"", "artist_ids": "\"['x1']\"",
                              "explicit": "false", "mode": "0", "release_date": "2002"}) + "\n")
    with open(os.path.join(tmp_dir, "data.csv"), "w") as fh:
        fh.write(",".join(b_cols) + "\n")
        fh.write(row(b_cols, {"id": "t1", "name": "Another", "artists": "\"['Ann', 'Bob']\"", "explicit": "0",
                              "mode": "1", "popularity": "50", "release_date": "2001-02-03"}) + "\n")
        fh.write(row(b_cols, {"id": "t3", "name": "Solo", "artists": "\"['Cat']\"", "explicit": "1",
                              "mode": "0", "popularity": "7", "release_date": "1999"}) + "\n")
        fh.write(row(b_cols, {"id": "t4", "name": "Bad", "artists": "x", "explicit": "1",
                              "mode": "0", "popularity": "oops", "release_date": "1999"}) + "\n")
    with open(os.path.join(tmp_dir, "data_w_genres.csv"), "w") as fh:
        fh.write("artists,genres\nAnn,\"['pop']\"\nCat,[]\n")
    names = wh.build_music_warehouse(spark, tmp_dir, database="rh_mu_test", mode="overwrite")
    track = {r["t_id"]: r for r in spark.table(names["track"]).collect()}
    assert set(track) == {"t1", "t2", "t3"}
    assert track["t1"]["t_name"] == "Another" and track["t1"]["t_popularity"] == 50
    assert track["t1"]["t_album"] == "A" and track["t3"]["t_album"] is None
    assert spark.table(names["track_quarantine"]).count() == 1
    artist = {r["a_name"]: r for r in spark.table(names["artist"]).collect()}
    assert artist["Ann"]["genres"] == ["pop"] and artist["Cat"]["a_ext_id"] is None
    bridge = sorted((r["track_id"], r["artist_id"]) for r in spark.table(names["track_artists"]).collect())
    by_id = {r["a_id"]: r["a_name"] for r in artist.values()}
    assert sorted((t, by_id[a]) for t, a in bridge) == [("t1", "Ann"), ("t1", "Bob"), ("t2", "Ann"), ("t3", "Cat")]
    am = {r["a_id"]: r for r in wh.build_artist_measures(spark, "rh_mu_test").collect()}
    assert am[artist["Ann"]["a_id"]]["a_track_number"] == 2

    db = "rh_mu_test"
    stats = an.artist_stats(spark, "Ann", db).first()
    assert (stats["track_number"], stats["first_release"]) == (2, dt.date(2001, 2, 3))
    assert [r["name"] for r in an.artist_top_tracks(spark, "Ann", database=db).collect()][0] == "Another"
    assert an.artist_albums(spark, "Ann", db).count() == 2
    assert an.artist_features(spark, "Ann", db).first()["genres"] == ["pop"]
    assert sum(r["track_number"] for r in an.key_frequency(spark, db).collect()) == 3
    assert [tuple(r) for r in an.mainstream_genres(spark, database=db).collect()] == [(1, "pop")]
    assert an.popular_artists(spark, database=db).count() == 3
    made = wh.build_artist_clusters(spark, db, k=2)
    assert {n: t.columns for n, t in made.items()} == {
        "artist_cluster_features": ["a_id", "prediction"], "artist_cluster_features_smoothed": ["a_id", "prediction"]
    }
    assert all(t.count() == 3 for t in made.values())
    assert [r["artist_name"] for r in an.similar_artists(spark, "Ann", database=db).collect()] == []
    spark.sql("DROP SCHEMA rh_mu_test CASCADE")


def test_cli_arguments(spark, tmp_dir):
    import pytest

    with pytest.raises(SystemExit):
        wh.main(["equity"])  # a raw folder is required
    with pytest.raises(SystemExit):
        wh.main(["unknown-job", tmp_dir])
