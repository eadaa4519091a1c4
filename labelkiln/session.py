"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Codec of written intermediate tables: their lists repeat one another further apart than Spark's default (snappy) looks back.
COMPRESSION = "zstd"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "labelkiln", extra: dict | None = None) -> SparkSession:
    """Session used by tests and the bench.

    AQE is on (coalescing, skew-join splitting, runtime broadcast
    decisions); the UI is off; timestamps are UTC so results agree with
    DuckDB.  On a cluster the caller passes its own session instead.
    """
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # delete checkpoint files once their RDD is garbage-collected (long local runs)
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         # broadcast only what the planner can prove small
         .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024)))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is
    used as is.  Only a local-mode session without the setting (tests,
    bench) gets a fresh folder under /tmp; a cluster session without it
    is an error, because a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d.removeprefix("file:")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    d = tempfile.mkdtemp(prefix="labelkiln-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def shared_uri(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder below ``spark.checkpoint.dir``; a folder without scheme is on Spark's default file system."""
    ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return qualified(spark, f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system's scheme, as Spark itself resolves it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if re.match("file:/[^/]", uri) else uri


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the written table.

    Cuts the lineage like ``checkpoint()``, so what several branches read is
    computed once, and keeps the rows columnar.
    """
    path = shared_uri(df.sparkSession, name)
    df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)
