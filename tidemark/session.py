"""Session helpers: a local/test session and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark") -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. In local mode (tests,
    laptops) an unset folder becomes a fresh local one; on a cluster that is
    an error, as a machine's own folder is no place for shared tables."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


def stable_base(df: DataFrame, reliable: bool = True) -> DataFrame:
    """Base table that an iterative job reads many times. reliable=True writes
    it once below the shared checkpoint folder (an executor lost mid-loop then
    rereads the table instead of recomputing it from the raw data); otherwise
    it is persisted in memory and on disk. Give it back with ``release``."""
    from pyspark import StorageLevel
    if not reliable:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = shared_path(df.sparkSession, f"base-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stable_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a ``stable_base`` (or unpersist it)."""
    path = getattr(df, "_stable_path", None)
    if path is None:
        df.unpersist()
        return
    p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers as a zip (functions are pickled by
    reference, so workers must be able to import it)."""
    import os
    import zipfile

    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-ship-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("tidemark", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(path)
