"""Readers for raw files: audited CSV, per-entity CSV folders, text lines,
records and whole files.

Bad records are never silently dropped or silently kept: every reader
returns the good rows and a quarantine frame of the rows that failed to
parse (``PERMISSIVE`` mode plus a corrupt-record column).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rawhouse.functions.text import int_flag
from rawhouse.session import materialize

CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Audited:
    """``good`` and ``quarantine`` are two filters of one read (and what unpacking
    gives); ``rows`` has both in one pass, with the column ``row_state`` ('good' or
    'quarantined')."""

    good: DataFrame
    quarantine: DataFrame
    rows: DataFrame

    def __iter__(self) -> Iterator[DataFrame]:
        return iter((self.good, self.quarantine))


def _split(df: DataFrame, corrupt: str, keep_corrupt: bool, materialized: bool) -> Audited:
    # A CSV scan converts only the columns a query needs, and a bad value in
    # another one would go unnoticed.  The test for bad rows therefore reads
    # every column (the second half of it is always true), so each row is judged
    # by all of them whatever a query selects, and good + quarantine is the input.
    if materialized:
        df = materialize(df)
    data = [F.col(f"`{c}`") for c in df.columns if c != corrupt]
    bad = F.concat(F.xxhash64(*data).cast("string"), F.col(corrupt)).isNotNull()
    good = df if keep_corrupt else df.where(~bad)
    state = F.when(bad, F.lit("quarantined")).otherwise(F.lit("good"))
    return Audited(good.drop(corrupt), df.where(bad), df.withColumn("row_state", state).drop(corrupt))


def read_csv_audited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    enforce_header: bool = True,
    keep_corrupt: bool = False,
    bool_flags: tuple[str, ...] = (),
    corrupt_col: str = CORRUPT,
    materialized: bool = False,
    **options: str,
) -> Audited:
    """CSV with a declared schema, split into good rows and a quarantine.

    ``enforce_header`` checks each file's header names against the schema
    (case-insensitive) instead of taking columns by position.  Fields are
    quoted and escaped with ``"``.  ``bool_flags`` are 0/1 integer columns
    turned into booleans.  ``keep_corrupt`` keeps bad rows among the good
    ones (their unparsable fields NULL), as a plain PERMISSIVE read does.
    Every row is parsed with all columns, so good + quarantine always add up to
    the input; ``materialized`` parses once and reads a Parquet copy after that.
    """
    full = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
    reader = (
        spark.read.schema(full)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", not enforce_header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt_col)
    )
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    if bool_flags:
        df = df.withColumns({c: int_flag(c) for c in bool_flags})
    return _split(df, corrupt_col, keep_corrupt, materialized)


def read_csv_strings(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """CSV with a header line, every column a string (no schema inference,
    which would read the data twice); quote and escape ``"``."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


# basename up to the first underscore: "AAPL_history.csv" -> "AAPL"
BASENAME_KEY = r"^([^_]*)_"


def read_entity_csvs(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    key_col: str = "code",
    key_pattern: str = BASENAME_KEY,
    key_from: str = "file_name",
    prefix: str = "",
    recursive: bool = False,
    corrupt_col: str = CORRUPT,
    materialized: bool = False,
    **options: str,
) -> Audited:
    """A folder of per-entity CSV files; the entity key comes from the file.

    Columns are taken by position (the header line of each file is skipped,
    not checked), so files of another shape end up in the quarantine rather
    than failing the job.  The key is group 1 of ``key_pattern`` applied to
    ``_metadata.file_name`` (or ``file_path``); no Python runs per row.
    Output columns are ``key_col`` then the schema's columns renamed to
    ``prefix + name`` (spaces become underscores).
    """
    if key_from not in ("file_name", "file_path"):
        raise ValueError("key_from must be 'file_name' or 'file_path'")
    full = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
    reader = (
        spark.read.schema(full)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt_col)
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    key = F.regexp_extract(F.col(f"_metadata.{key_from}"), key_pattern, 1)
    data = [f.name for f in schema.fields]
    renamed = df.select(
        key.alias(key_col),
        *[F.col(f"`{c}`").alias(prefix + c.replace(" ", "_")) for c in data],
        F.col(corrupt_col),
    )
    return _split(renamed, corrupt_col, False, materialized)


def read_lines(spark: SparkSession, path: str | list[str], line_sep: str = "\r\n") -> DataFrame:
    """Text lines split on ``line_sep`` only, so a bare ``\\n`` stays inside
    a line (``value`` column)."""
    return spark.read.text(path, lineSep=line_sep)


def read_records(spark: SparkSession, path: str | list[str], record_sep: str = "\x1e") -> DataFrame:
    """Multi-line records separated by ``record_sep`` (splittable, unlike
    whole-file reads)."""
    return spark.read.text(path, lineSep=record_sep)


def folder_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Bytes of the files below a path (names of the file system, no data read)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for one in [path] if isinstance(path, str) else path:
        target = jvm.org.apache.hadoop.fs.Path(one)
        total += target.getFileSystem(conf).getContentSummary(target).getLength()
    return total


def read_whole_files(
    spark: SparkSession, path: str | list[str], recursive: bool = False, task_bytes: int = 32 << 20
) -> DataFrame:
    """One row per file (``value``, ``file_name``, ``file_path``).

    A split holds whole files, and each counts for ``openCostInBytes`` (4 MB) at
    least when splits are made, so very many tiny files would make very many
    tasks.  Splits are therefore put together, without a shuffle, to tasks of
    about ``task_bytes`` of real content, and no fewer than the session's cores.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    df = reader.text(path, wholetext=True)
    tasks = max(-(-folder_bytes(spark, path) // task_bytes), spark.sparkContext.defaultParallelism)
    found = df.select("value", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"))
    return found.coalesce(int(tasks))
