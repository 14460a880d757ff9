"""Session construction and the shared folders jobs may write to.

On a cluster the operator of the cluster names a shared folder in
``spark.checkpoint.dir``; checkpoints and scratch files go below it.  A
machine-local temporary folder is only chosen when nothing is configured,
which is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of the toolkit wants.  ANSI mode stays on (the Spark
# 4 default); operators use try_* functions where the input may be dirty.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Scratch paths handed out by this process and not deleted yet.
_scratch_paths: set[str] = set()


def build_session(
    master: str | None = None,
    app_name: str = "rawhouse",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """Return a session with the toolkit's defaults applied.

    ``master`` is left to ``spark-submit`` when None.  Existing settings of
    an already running session are not overridden except the SQL ones given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context).  Only in local mode, when neither exists (tests), a fresh local
    folder is created and set; on a cluster a missing setting is an error,
    never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder all executors share"
            )
        configured = tempfile.mkdtemp(prefix="rawhouse-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as parquet into the shared checkpoint folder and
    return a frame reading it back.

    One job computes the rows exactly once (no persist, no second pass as an
    RDD checkpoint needs); the copy is columnar, so later reads prune columns
    and push filters; and the lineage is cut, so lost executors never force
    a recomputation of the input.  Columns are stored under positional names
    (any name survives the round trip).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    names = df.columns
    df.toDF(*[f"c{i}" for i in range(len(names))]).write.parquet(path)
    stored = spark.read.parquet(path).toDF(*names)
    stored._scratch = path
    return stored


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame that :func:`materialize` returned, once
    nothing that reads them will run again.  Other frames are left alone."""
    path = getattr(df, "_scratch", None)
    if path:
        _delete(df.sparkSession, path)
        df._scratch = None


def release_scratch(spark: SparkSession) -> None:
    """Delete every scratch file of this session: call it when the results that
    read them have been written."""
    for path in list(_scratch_paths):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _scratch_paths.discard(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/rawhouse-scratch/{name}-{uuid.uuid4().hex}"
    _scratch_paths.add(path)
    return path


def default_parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions the session is configured for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = [
    "DEFAULT_CONF",
    "build_session",
    "checkpoint_dir",
    "discard",
    "materialize",
    "release_scratch",
    "scratch_path",
    "default_parallelism",
]
