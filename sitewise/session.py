"""Session, table loading and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sitewise") -> SparkSession:
    """Session with AQE on, UI off, UTC session time zone.

    On a cluster the master and shuffle-partition count come from the submit
    configuration; the arguments are for local runs and tests.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class NoSharedFolder(Exception):
    """Raised where written intermediates would land on one machine's disk."""


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only where it is unset and all tasks run in this
    process (local runs, tests) a scratch folder is made and registered; on
    a cluster that would be a folder of the driver alone, so it fails.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise NoSharedFolder(f"set spark.checkpoint.dir to a folder that all of {master} shares")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sitewise-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or a non-empty folder is at ``path``, in any store that
    Spark reads.  Errors other than absence are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and (fs.getFileStatus(p).isFile() or len(fs.listStatus(p)) > 0)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage: written as a Parquet table
    in the shared checkpoint folder and read back.  For intermediates that
    feed many branches of a plan — without it every branch and scalar
    subquery re-runs the scans and joins beneath it.  (A reliable RDD
    checkpoint would compute the plan twice: once for the action, once for
    the checkpoint write.)"""
    spark = df.sparkSession
    path = scratch_path(spark, "mat")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh sub-path of the shared folder for one job's files."""
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path of :func:`scratch_path` that no lazy frame reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
