"""Writing tables and files."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rawhouse.session import discard, materialize


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    mode: str = "error",
    partition_by: Sequence[str] = (),
) -> None:
    """Managed catalog table (``mode``: error, overwrite, append, ignore)."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "error",
    partition_by: Sequence[str] = (),
    order_by: Sequence[Column | str] = (),
    **options: str,
) -> None:
    """Files at ``path``; e.g. ``partition_by=['year']`` for a price table so
    year filters prune whole folders.  ``order_by`` writes an ordered report: a
    range-partitioned sort, so the files in name order hold the rows in order."""
    if order_by:
        df = df.orderBy(*order_by)
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def write_file_per_row(df: DataFrame, path: str, col: str = "value", files_per_task: int = 250) -> None:
    """One small text file at ``path`` for every row, with the text of ``col``.

    Making a file takes far longer than its bytes, so tasks are sized by files: the
    rows are computed once, counted and dealt in turn over tasks of about
    ``files_per_task`` rows (no fewer than the session's cores), however few
    partitions ``df`` has.  Each task also moves its own files in place when it ends
    (commit algorithm 2); algorithm 1 would move all of them one by one on the
    driver.  So ``path`` must be a new folder, read only after this returned.
    """
    texts = materialize(df.select(F.col(f"`{col}`").alias("value")), "file-texts")
    tasks = max(-(-texts.count() // files_per_task), df.sparkSession.sparkContext.defaultParallelism)
    w = texts.repartition(tasks).write.option("maxRecordsPerFile", 1)
    w.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    discard(texts)


def save_bucketed(
    df: DataFrame, name: str, by: Sequence[str] | str, buckets: int, mode: str = "error", path: str | None = None
) -> None:
    """Catalog table of ``buckets`` buckets by the columns ``by``, sorted inside.

    Tables with equal keys and bucket counts join (and aggregate) by that key
    without a shuffle.  The rows are dealt to their buckets before they are
    written, so a bucket is one file; a key with very many rows makes one large
    bucket, so bucket by a key whose groups are small (a fact's own id).  ``path``
    puts the files of an external table there.
    """
    keys = [by] if isinstance(by, str) else list(by)
    w = df.repartition(buckets, *keys).write.format("parquet").mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def replace_partitions(
    df: DataFrame, path: str, partition_by: str, spread_by: str, files_per_partition: int = 8, fmt: str = "parquet"
) -> None:
    """Load a partitioned folder incrementally: the partitions (say years) that
    ``df`` has rows for are replaced, all others stay (dynamic overwrite).

    The rows of a partition are dealt over ``files_per_partition`` tasks by a hash
    of ``spread_by``, so neither one task holds a whole year nor every task writes
    a file for every year.
    """
    spread = F.pmod(F.xxhash64(spread_by), F.lit(files_per_partition))
    dealt = df.repartition(F.col(partition_by), spread)
    dealt.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).save(path)


def read_ordered(spark: SparkSession, path: str, order_by: Sequence[str], position: str = "position") -> DataFrame:
    """An ordered report (``write_files(order_by=...)``) with each row's place in it.

    ``position`` counts from 1 over the files in name order and the rows inside
    them; ``in_order`` tells whether a row is not smaller than the one before it,
    over the borders of files too.  Neighbours are compared inside each file (a
    window by file) and between files by one row a file.
    """
    read = spark.read.parquet(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    rows = read.select("*", number.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    value = F.struct(*[F.col(c) for c in order_by])
    ends = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"), F.max_by(value, "_row").alias("_last"))
    # one row a file
    by_file = Window.orderBy("_file")
    before = ends.select(
        "_file", F.coalesce(F.sum("_n").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.lag("_last").over(by_file).alias("_before"),
    )
    placed = rows.join(before, "_file")
    previous = F.coalesce(F.lag(value).over(Window.partitionBy("_file").orderBy("_row")), F.col("_before"))
    return placed.withColumn("_previous", previous).select(
        *read.columns,
        (F.col("_off") + F.col("_row") + 1).alias(position),
        (F.col("_previous").isNull() | (F.col("_previous") <= value)).alias("in_order"),
    )


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "error",
    header: bool = True,
    partition_by: Sequence[str] = (),
    order_by: Sequence[Column | str] = (),
    **options: str,
) -> None:
    """CSV with a header line, ``"``-quoted where needed."""
    write_files(df, path, "csv", mode, partition_by, order_by, header=str(header).lower(), **options)


def named_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temporary view for SQL statements; returns the view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ensure_schema(spark: SparkSession, name: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` (the catalog quotes the identifier)."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:n)", args={"n": name})


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


FINGERPRINT = "rawhouse.input"


def frame_fingerprint(*frames: DataFrame) -> str:
    """A digest of the frames' columns and rows that does not depend on the order
    of rows or on files: one mergeable aggregation a frame (number of rows, sums
    of two hashes), so rewriting the same rows gives the same digest."""
    parts = []
    for df in frames:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        sums = [F.sum(F.xxhash64(row, F.lit(salt)).cast("decimal(38,0)")) for salt in (0, 1)]
        parts.append((df.schema.simpleString(), *map(str, df.agg(F.count(F.lit(1)), *sums).first())))
    return hashlib.sha256(repr(parts).encode()).hexdigest()


def table_fingerprint(spark: SparkSession, name: str) -> str | None:
    """The input digest a table was built from, if :func:`ensure_fresh` built it."""
    if not table_exists(spark, name):
        return None
    props = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:n)", args={"n": name}).collect()
    return {r["key"]: r["value"] for r in props}.get(FINGERPRINT)


def ensure_fresh(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], inputs: Sequence[DataFrame], fmt: str = "parquet"
) -> tuple[DataFrame, bool]:
    """Build step that runs when its inputs changed: (table, whether it was built).

    The digest of ``inputs`` (:func:`frame_fingerprint`) is kept as a table
    property; an equal digest leaves the table alone.  A changed one builds the
    new table aside, and only a finished build takes the old one's name, so
    readers never meet a half-written table and a failed build leaves the old one.
    """
    wanted = frame_fingerprint(*inputs)
    if table_fingerprint(spark, name) == wanted:
        return spark.table(name), False
    aside = f"{name}__next"
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:n)", args={"n": aside})
    save_table(build(), aside, fmt=fmt)
    spark.sql(f"ALTER TABLE IDENTIFIER(:n) SET TBLPROPERTIES ('{FINGERPRINT}' = '{wanted}')", args={"n": aside})
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:n)", args={"n": name})
    quoted = ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))
    spark.sql(f"ALTER TABLE IDENTIFIER(:n) RENAME TO {quoted}", args={"n": aside})
    spark.catalog.refreshTable(name)
    return spark.table(name), True


def ensure_table(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    fmt: str = "parquet",
    rebuild: bool = False,
) -> DataFrame:
    """Build step that runs once: ``build()`` is written as table ``name``
    unless the table exists (or ``rebuild`` is set); the table is returned.

    Later steps read the written table, which also cuts their lineage."""
    if rebuild or not table_exists(spark, name):
        save_table(build(), name, fmt=fmt, mode="overwrite")
    return spark.table(name)
