"""Stored tables and files: bucketed joins, loads by year, fresh builds, saved
models, ordered reports, packed small files, statements with names as parameters."""

import datetime
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from frame_rows import rows
from rawhouse.operators import entity as ent
from rawhouse.operators import ml
from rawhouse.plans import queries as Q
from rawhouse.plans import sql_forms, stored_queries
from rawhouse.sources import files, sinks

SF = "/root/testdata/sf0.001"


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def tree_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ bucketed star

@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bucketed_star_shuffles_neither_track_nor_bridge(spark):
    track, bridge = stored_queries.star_tables(spark, SF, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = bridge.join(track, bridge.track_id == track.t_id)
        assert "SortMergeJoin" in tree_of(joined) and "Exchange" not in tree_of(joined)
        # counting by the bucket key needs no shuffle either
        assert "Exchange" not in tree_of(joined.groupBy("track_id").count())
        star = ent.entity_facts(track, bridge, stored_queries.S.artist_keys(spark, SF))
        lines = tree_of(star).splitlines()
        scans = [i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line]
        joins = [i for i, line in enumerate(lines) if "SortMergeJoin [track_id" in line]
        assert len(scans) == 2 and len(joins) == 1
        assert not any("Exchange" in line for line in lines[joins[0] : scans[-1]])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ------------------------------------------------------------------ prices by year

def loaded(spark, path):
    return rows(spark.read.parquet(path), "code", "year", "price")


def test_a_load_replaces_only_its_years(spark, tmp_dir):
    path = os.path.join(tmp_dir, "prices")
    first = spark.createDataFrame([(c, y, float(c + y)) for c in range(20) for y in (2019, 2020, 2021)], "code int, year int, price double")
    sinks.replace_partitions(first, path, "year", "code", files_per_partition=3)
    kept = {y: sorted(os.listdir(os.path.join(path, f"year={y}"))) for y in (2019, 2020, 2021)}
    assert all(1 <= sum(n.endswith(".parquet") for n in names) <= 3 for names in kept.values())
    second = spark.createDataFrame([(1, 2020, -1.0), (7, 2022, 7.0)], "code int, year int, price double")
    sinks.replace_partitions(second, path, "year", "code")
    for y in (2019, 2021):  # not one file was touched
        assert sorted(os.listdir(os.path.join(path, f"year={y}"))) == kept[y]
    want = [r for r in rows(first, "code", "year", "price") if r[1] != 2020] + [(1, 2020, -1.0), (7, 2022, 7.0)]
    assert loaded(spark, path) == sorted(want, key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_other_years_are_not_scanned(spark):
    plan = plan_of(stored_queries.price_years(spark, SF))
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "h_year" in filters and ">= 1996" in filters and "<= 1998" in filters


# ------------------------------------------------------------------ fresh builds

def test_fresh_build_runs_when_rows_change(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS rh_fresh")
    calls = []

    def ask(df, fail=False):
        def build():
            calls.append(1)
            if fail:
                raise RuntimeError("broken build")
            return df.groupBy("k").agg(F.sum("v").alias("v"))

        return sinks.ensure_fresh(spark, "rh_fresh.t", build, [df])

    df = spark.createDataFrame([(i % 3, i) for i in range(30)] + [(None, 1)], "k int, v int")
    table, new = ask(df)
    assert new and rows(table) == rows(df.groupBy("k").agg(F.sum("v")))
    again, new = ask(df.repartition(5).orderBy("v"))  # the same rows in another order
    assert not new and len(calls) == 1
    for other in (df.limit(30), df.union(df), df.withColumn("v", F.col("v") + 1), df.withColumnRenamed("v", "w").withColumn("v", F.lit(1)).drop("w")):
        assert sinks.frame_fingerprint(other) != sinks.frame_fingerprint(df)
    with pytest.raises(RuntimeError):
        ask(df.union(df), fail=True)
    assert rows(spark.table("rh_fresh.t")) == rows(df.groupBy("k").agg(F.sum("v")))  # the old table is whole
    table, new = ask(df.union(df))
    assert new and rows(table) == rows(df.union(df).groupBy("k").agg(F.sum("v")))
    spark.sql("DROP SCHEMA rh_fresh CASCADE")


# ------------------------------------------------------------------ saved model

def test_saved_model_assigns_new_entities_without_a_refit(spark, tmp_dir):
    known = spark.createDataFrame([(i, 10.0 * (i % 3) + 0.01 * i, float(i % 3)) for i in range(30)], "id int, x double, y double")
    found = ml.fit_clusters(known, "id", k=3, seed=5)
    path = os.path.join(tmp_dir, "model")
    ml.save_model(found.model, path)
    model = ml.load_model(path)
    assert rows(ml.assign(model, known, "id")) == rows(found.assigned)
    new = spark.createDataFrame([(100 + i, 10.0 * i - 0.2, float(i)) for i in range(3)], "id int, x double, y double")
    label = {r["id"]: r["prediction"] for r in found.assigned.collect()}
    got = {r["id"]: r["prediction"] for r in ml.assign(model, new, "id").collect()}
    assert [got[100 + i] for i in range(3)] == [label[i] for i in range(3)]
    with pytest.raises(Exception):
        ml.save_model(found.model, path)  # a model is never overwritten


# ------------------------------------------------------------------ ordered report

def test_ordered_report_positions(spark, tmp_dir):
    df = spark.createDataFrame([(i * 7919 % 1000, i % 5) for i in range(1000)], "a int, b int").repartition(6)
    path = os.path.join(tmp_dir, "report")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_files(df, path, order_by=["a", "b"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(n.startswith("part-") for n in os.listdir(path)) > 1
    read = sinks.read_ordered(spark, path, ["a", "b"]).orderBy("position").collect()
    assert [r["position"] for r in read] == list(range(1, 1001)) and all(r["in_order"] for r in read)
    assert [(r["a"], r["b"]) for r in read] == sorted((r["a"], r["b"]) for r in df.collect())
    df.write.parquet(os.path.join(tmp_dir, "loose"))
    loose = sinks.read_ordered(spark, os.path.join(tmp_dir, "loose"), ["a", "b"])
    assert loose.where("NOT in_order").count() > 0 and loose.count() == 1000


# ------------------------------------------------------------------ small files

def test_small_files_share_tasks(spark, tmp_dir):
    for i in range(300):
        with open(os.path.join(tmp_dir, f"e{i}.txt"), "w") as f:
            f.write(f"code,{i}\nname,n{i}\n")
    plain = spark.read.text(tmp_dir, wholetext=True)
    packed = files.read_whole_files(spark, tmp_dir)
    assert packed.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism < plain.rdd.getNumPartitions()
    assert "Exchange" not in tree_of(packed)
    assert packed.count() == 300 and packed.select("file_name").distinct().count() == 300
    assert files.folder_bytes(spark, tmp_dir) == sum(os.path.getsize(os.path.join(tmp_dir, f)) for f in os.listdir(tmp_dir))
    # a folder of larger content keeps more tasks
    assert files.read_whole_files(spark, tmp_dir, task_bytes=500).rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


def test_a_file_per_row_is_written_by_many_tasks(spark, tmp_dir):
    """Rows of one partition, some alike, empty or null: each has a file of its own,
    and no task writes more than its share of them."""
    texts = [f"code,{i % 290}\nname,n" for i in range(297)] + ["", None, "é 🙂"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, `te.xt` string").coalesce(1)
    path = os.path.join(tmp_dir, "files")
    sinks.write_file_per_row(df, path, "te.xt", files_per_task=20)
    names = [f for f in os.listdir(path) if f.startswith("part-") and os.path.getsize(os.path.join(path, f))]
    shares = Counter(f.split("-")[1] for f in names)
    assert len(names) == 300 and len(shares) == 15 and max(shares.values()) <= 25
    got = [r["value"] for r in files.read_whole_files(spark, path).collect()]
    assert sorted(got) == sorted((t or "") + "\n" for t in texts)
    # fewer rows than one task's share still use every core
    few = os.path.join(tmp_dir, "few")
    sinks.write_file_per_row(df.limit(40), few, "te.xt")
    assert len({f.split("-")[1] for f in os.listdir(few) if f.startswith("part-")}) == spark.sparkContext.defaultParallelism


def test_profile_files_are_not_written_by_one_task(spark, tmp_dir, monkeypatch):
    """A supplier table of one row group: its files come from every core."""
    seen = []
    real = files.read_whole_files
    monkeypatch.setattr(files, "read_whole_files", lambda s, path: seen.append(path) or real(s, path))
    supplier = [(i, f"Supplier#{i}", i % 2, 1.0 * i) for i in range(60)]
    made = {
        "supplier": spark.createDataFrame(supplier, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": spark.createDataFrame([(0, "PERU", 0), (1, "CHINA", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "AMERICA"), (1, "ASIA")], "r_regionkey int, r_name string"),
        "lineitem": spark.createDataFrame([(i, datetime.datetime(2020, 1, 2)) for i in range(50)], "l_suppkey long, l_shipdate timestamp"),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(os.path.join(tmp_dir, f"{name}.parquet"))
    got = stored_queries.profile_files(spark, tmp_dir)
    path = seen[0].removeprefix("file:")
    names = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(names) == 60 and len({f.split("-")[1] for f in names}) >= spark.sparkContext.defaultParallelism
    assert rows(got) == rows(Q.parse_profiles(spark, tmp_dir)) and got.count() == 60


# ------------------------------------------------------------------ names as parameters

def test_similar_entities_statement_on_two_cluster_tables(spark):
    ids = list(range(1, 13))
    dim = spark.createDataFrame([(i, f"n{i:02d}", ["pop"] if i % 3 else ["jazz", "pop"]) if i != 5 else (5, "n05", ["folk"]) for i in ids], "a_id int, a_name string, genres array<string>")
    am = spark.createDataFrame([(i, i * 3 % 7, 0.5) + (float(i),) * 9 for i in ids],
                               "a_id int, a_track_number int, a_mode double, " + ", ".join(f"{m} double" for m in ent.MEASURES))
    dim.createOrReplaceTempView("st_dim")
    am.createOrReplaceTempView("st_measures")
    for by in (2, 3):
        clusters = spark.createDataFrame([(i, i % by) for i in ids], "a_id int, prediction int")
        clusters.createOrReplaceTempView(f"st_clusters_{by}")
        got = sql_forms.similar_entities_sql(spark, "st_dim", f"st_clusters_{by}", "st_measures", "n01", 4).collect()
        want = ent.similar_entities(dim, ent.cluster_peers(dim, clusters, "a_name", "n01"), am, "a_name", 4).collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in want] and len(got) >= 3


def test_correlation_statement_of_any_columns(spark):
    from rawhouse.operators import timeseries as ts

    data = [(e, float(i * (e + 1) % 11), float(i * i % 7), i) for e in range(3) for i in range(20)] + [(9, 1.0, None, 1), (8, 2.0, 2.0, 3)]
    df = spark.createDataFrame(data, "who int, a double, b double, c int")
    df.createOrReplaceTempView("st_daily")
    for a, b in (("a", "b"), ("b", "c")):
        assert rows(sql_forms.grouped_corr_sql(spark, "st_daily", "who", a, b)) == rows(ts.grouped_corr(df, "who", a, b))
    with pytest.raises(Exception):
        sql_forms.grouped_corr_sql(spark, "st_daily", "who", "a; DROP TABLE x", "b").collect()
