import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from frame_rows import rows
from rawhouse.sources import files, sinks
from rawhouse.streaming import stream_entity_csvs, stream_posts, write_audited

SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("close", T.DoubleType())])


def test_stream_entity_csvs_incremental(spark, tmp_dir):
    src, out, bad, ck = (os.path.join(tmp_dir, d) for d in ("src", "out", "bad", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "ABC_h.csv"), "w") as fh:
        fh.write("Date,Close\n2020-01-01,1.5\nnot-a-date,2\n")
    q = write_audited(stream_entity_csvs(spark, src, SCHEMA, key_col="h_code", prefix="h_"), out, bad, "t1", ck)
    q.awaitTermination(120)
    assert rows(spark.read.parquet(out)) == [("ABC", dt.date(2020, 1, 1), 1.5, 0)]
    assert spark.read.parquet(bad).count() == 1
    # a new file: only it is read on the next run of the same stream
    with open(os.path.join(src, "XYZ_h.csv"), "w") as fh:
        fh.write("Date,Close\n2020-01-02,3.0\n")
    q = write_audited(stream_entity_csvs(spark, src, SCHEMA, key_col="h_code", prefix="h_"), out, bad, "t2", ck)
    q.awaitTermination(120)
    got = rows(spark.read.parquet(out).select("h_code", "h_date", "h_close"))
    assert got == [("ABC", dt.date(2020, 1, 1), 1.5), ("XYZ", dt.date(2020, 1, 2), 3.0)]


def test_stream_posts(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("src", "out", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "t.csv"), "w", newline="") as fh:
        fh.write('Stock,Date,Content,Author\r\nA,3/1/2020 7:05,"x, y\nz",Bob\r\n')
    q = write_audited(stream_posts(spark, src), out, None, "posts", ck)
    q.awaitTermination(120)
    assert rows(spark.read.parquet(out).select("t_code", "t_author")) == [("A", "Bob")]


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame([(2019, "a"), (2020, "b")], "year int, v string")
    p = os.path.join(tmp_dir, "parts")
    sinks.write_files(df, p, partition_by=["year"])
    assert {"year=2019", "year=2020"} <= set(os.listdir(p))
    pruned = spark.read.parquet(p).where("year = 2020")
    assert rows(pruned) == [("b", 2020)]
    c = os.path.join(tmp_dir, "csv")
    sinks.write_csv(df, c)
    back = files.read_csv_audited(spark, c, T.StructType([T.StructField("year", T.IntegerType()),
                                                          T.StructField("v", T.StringType())])).good
    assert rows(back) == [(2019, "a"), (2020, "b")]
    name = "rawhouse_test_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not sinks.table_exists(spark, name)
    calls = []
    build = lambda: calls.append(1) or df
    assert sinks.ensure_table(spark, name, build).count() == 2
    assert sinks.ensure_table(spark, name, build).count() == 2 and len(calls) == 1
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.save_table(df, name, mode="overwrite")
    assert sinks.table_exists(spark, name) and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_csv_strings_schema_and_prefix(spark, tmp_dir):
    from rawhouse.operators.model import parse_list, prefixed

    path = os.path.join(tmp_dir, "g.csv")
    with open(path, "w") as fh:
        fh.write('artists,genres\nAnn,"[\'pop\', \'rock\']"\nBob,[]\n')
    df = files.read_csv_strings(spark, path)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string"]
    got = {r["artists"]: r["g"] for r in df.select("artists", parse_list("genres").alias("g")).collect()}
    assert got == {"Ann": ["pop", "rock"], "Bob": []}
    assert prefixed(df, "a_", keep=["artists"]).columns == ["artists", "a_genres"]
    sinks.ensure_schema(spark, "rawhouse_test_db")
    assert spark.catalog.databaseExists("rawhouse_test_db")
    spark.sql("DROP SCHEMA IF EXISTS rawhouse_test_db")


def test_materialize_round_trip(spark):
    from rawhouse.session import checkpoint_dir, materialize

    df = spark.createDataFrame([(1, "a", [1.5]), (2, None, None)], "`stock splits` int, `x,y` string, v array<double>")
    m = materialize(df.where("`stock splits` > 0"))
    assert m.columns == ["stock splits", "x,y", "v"]
    assert sorted(map(tuple, m.collect()), key=repr) == [(1, "a", [1.5]), (2, None, None)]
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "parquet" in plan.lower() and "LocalRelation" not in plan
    assert checkpoint_dir(spark).rstrip("/").split("/")[-1] in m.inputFiles()[0]


def test_ordered_report_and_view(spark, tmp_dir):
    import glob

    from rawhouse.sources import sinks

    df = spark.range(0, 1000, 1, 7).selectExpr("id * 7919 % 1000 AS k", "id % 3 AS g")
    sinks.write_csv(df, f"{tmp_dir}/report", order_by=["g", F.col("k").desc()])
    lines = [l for f in sorted(glob.glob(f"{tmp_dir}/report/part-*")) for l in open(f).read().split("\n")[1:] if l]
    got = [tuple(map(int, l.split(",")))[::-1] for l in lines]
    assert len(got) == 1000 and got == sorted(got, key=lambda r: (r[0], -r[1]))
    assert sinks.named_view(df, "report_view").where("g = 1").count() == spark.sql("SELECT * FROM report_view WHERE g = 1").count()


def test_scratch_files_are_deleted(spark):
    from rawhouse import session

    kept = session.materialize(spark.range(5).toDF("x"), "kept")
    gone = session.materialize(spark.range(5).toDF("x"), "gone")
    path = gone._scratch
    session.discard(gone)
    session.discard(spark.range(1))
    assert kept.count() == 5 and not os.path.exists(path.replace("file:", ""))
    session.release_scratch(spark)
    assert not session._scratch_paths
