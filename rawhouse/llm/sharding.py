"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass 1 scatters the rows into buckets with a seeded hash.  The number of
buckets follows the measured size of the table, all columns of it, so that a
bucket fits a task's memory; a row's bucket depends on its id, text checksum and a number that
tells repeated rows apart, so equal rows spread as well.  Pass 2 brings each
bucket into one fixed order, shuffles it with a Fisher-Yates shuffle
(``functions.shuffle``) and writes it.  The written rows are then dealt: a
bucket's rows follow those of the buckets before it, and the shards take them
in turn, so shard sizes differ by one row at most and slots have no gap.

The shuffled buckets are written once below ``spark.checkpoint.dir`` and every
later number is read from those files, so a lost executor cannot mix two
different shuffles.

The table is read as stored: a derived frame whose row order may change when it
is computed again should be written first.

Defined results: null texts count no bytes; null ids and repeated rows are rows
like any other; extra columns travel along; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rawhouse.llm.common import free_name
from rawhouse.session import default_parallelism, scratch_path

BUCKET_BYTES = 16 << 20
ROW_BYTES = 16
SEED = 42


def _row_bytes(df: DataFrame, names: list[str]) -> Column:
    """About the bytes that a row takes with all its columns; nested ones count
    as their JSON text."""
    out = F.lit(ROW_BYTES).cast("long")
    for c in names:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType | T.BinaryType):
            out += 8 + F.coalesce(F.octet_length(f"`{c}`"), F.lit(0))
        elif isinstance(kind, T.NumericType | T.BooleanType | T.DatetimeType):
            out += F.lit(16 if isinstance(kind, T.DecimalType) else 8)
        else:
            out += 8 + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`").alias("c")))), F.lit(0))
    return out


def shuffled(
    df: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows and columns of ``df`` with ``size`` (text bytes plus 16), ``shard``
    and ``slot``; columns of these names in ``df`` are replaced."""
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = df.sparkSession
    names = [c for c in df.columns if c.lower() not in {"size", "shard", "slot"}]
    length = F.coalesce(F.octet_length(f"`{text_col}`"), F.lit(0)).cast("long")
    total = df.agg(F.sum(_row_bytes(df, names))).first()[0] or 0
    buckets = max(-(-total // bucket_bytes), min(default_parallelism(spark), 64))

    # Pass 1: scatter.  ``nth`` numbers the scanned rows, which parts equal ones.
    nth, mark, bucket, rows, size = (free_name(df, c) for c in ("nth", "mark", "bucket", "rows", "bytes"))
    key = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.crc32(F.coalesce(f"`{text_col}`", F.lit("")).cast("binary")), nth)
    placed = (
        df.select(*[F.col(f"`{c}`") for c in names], (length + ROW_BYTES).alias(size))
        .withColumn(nth, F.monotonically_increasing_id())
        .withColumn(bucket, F.pmod(key, F.lit(buckets)))
        .withColumn(mark, F.xxhash64(F.lit(seed + 1), key, nth))
    )
    # Pass 2: a fixed order (places are sorted, so any column type will do), then
    # Fisher-Yates, then write.
    inside = F.collect_list(F.struct(mark, nth, size, *[F.col(f"`{c}`") for c in names]))
    order = F.sort_array(F.transform(rows, lambda r, i: F.struct(r[mark].alias("m"), r[nth].alias("n"), i.alias("i"))))
    drawn = (
        placed.repartition(buckets, bucket)
        .groupBy(bucket)
        .agg(inside.alias(rows))
        .select(bucket, F.transform(F.shuffle(order, seed), lambda o: F.get(rows, o["i"])).alias(rows))
        .select(bucket, F.posexplode(rows).alias("at", "row"))
    )
    path = scratch_path(spark, "shards")
    drawn.select(F.col(bucket).alias("b"), F.col("at").cast("long").alias("at"), "row").write.parquet(path)
    written = spark.read.parquet(path)

    counts = written.groupBy("b").agg(F.count("*").alias("n")).withColumn("g", F.expr("b div 4096"))
    sums = counts.groupBy("g").agg(F.sum("n").alias("m"))
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    groups = sums.select("g", F.sum("m").over(ahead.orderBy("g")).alias("base"))  # a row per 4096 buckets
    before = counts.join(groups, "g").select(
        "b", (F.coalesce("base", F.lit(0)) + F.coalesce(F.sum("n").over(ahead.partitionBy("g").orderBy("b")), F.lit(0))).alias("first")
    )
    placed_rows = written.join(F.broadcast(before) if buckets <= 100_000 else before, "b")
    return placed_rows.withColumn("place", F.col("first") + F.col("at")).select(
        *[F.col(f"row.`{c}`").alias(c) for c in names],
        F.col(f"row.`{size}`").alias("size"),
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Write the rows of ``shuffled`` as one folder a shard, ordered by slot in
    bounded files."""
    ranges = default_parallelism(placed.sparkSession)
    placed.repartitionByRange(ranges, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


__all__ = ["shuffled", "write_shards"]
