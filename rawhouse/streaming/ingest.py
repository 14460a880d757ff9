"""Incremental ingestion of the raw folders with Structured Streaming.

The reference loads its raw folders (per-entity price CSVs, post lines) in
one batch.  New files keep arriving in such folders, so the same parsing is
offered as a file-source stream: each trigger picks up only the files not
seen before (tracked in the stream's checkpoint), splits good rows from the
quarantine and appends both.  Writes are keyed by the micro-batch id, so a
batch re-run after a failure overwrites its own output instead of
duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from rawhouse.operators.parse import parse_posts
from rawhouse.session import checkpoint_dir
from rawhouse.sources.files import BASENAME_KEY, CORRUPT


def stream_entity_csvs(
    spark: SparkSession,
    path: str,
    schema: StructType,
    key_col: str = "code",
    key_pattern: str = BASENAME_KEY,
    prefix: str = "",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming form of :func:`rawhouse.sources.files.read_entity_csvs`:
    key from the file name, columns by position, corrupt column kept for the
    split done per micro-batch by :func:`write_audited`."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
    reader = (
        spark.readStream.schema(full)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(path)
    data = [f.name for f in schema.fields]
    return df.select(
        F.regexp_extract(F.col("_metadata.file_name"), key_pattern, 1).alias(key_col),
        *[F.col(f"`{c}`").alias(prefix + c.replace(" ", "_")) for c in data],
        F.col(CORRUPT),
    )


def stream_posts(spark: SparkSession, path: str, line_sep: str = "\r\n") -> DataFrame:
    """Streaming form of post-line parsing (lines split on ``line_sep``)."""
    lines = spark.readStream.text(path, lineSep=line_sep)
    return parse_posts(lines)


def _stream_checkpoint(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/rawhouse-streams/{name}"


def write_audited(
    stream: DataFrame,
    table_path: str,
    quarantine_path: str | None,
    name: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append good rows to ``table_path`` and corrupt rows to
    ``quarantine_path``, one sub-folder per micro-batch (overwritten on a
    re-run of the same batch).  ``available_now`` processes what is there
    and stops; otherwise the stream keeps running."""
    spark = stream.sparkSession
    has_corrupt = CORRUPT in stream.columns

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good = batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if has_corrupt else batch
            good.write.mode("overwrite").format(fmt).save(f"{table_path}/batch={batch_id}")
            if has_corrupt and quarantine_path:
                bad = batch.where(F.col(CORRUPT).isNotNull())
                bad.write.mode("overwrite").format(fmt).save(f"{quarantine_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = (
        stream.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint_location or _stream_checkpoint(spark, name))
        .queryName(name)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
