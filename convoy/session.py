"""Session and scratch-space helpers.

The library never sets global Spark options on a caller's session.  ``local_session``
is only for tests, the benchmark and the command line.  ``workspace`` resolves the shared
folder a cluster names in ``spark.checkpoint.dir``; only when that is unset (local runs,
tests) does it create one and register it, so lineage cuts and written tables never land
in a machine-local folder on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "convoy") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CONVOY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; created only if unset, and only for a local
    master (other processes would not see it)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="convoy-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def workspace(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the checkpoint root for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "convoy", *parts, uuid.uuid4().hex])


def materialize(df, name: str = "stage"):
    """Write ``df`` once as parquet under the checkpoint folder and return it read back.

    This cuts lineage like ``checkpoint()`` but runs the plan once (an eager checkpoint of
    an unpersisted plan computes it twice) and keeps the data columnar.  The folder is shared
    storage on a cluster, so lost executors re-read files instead of recomputing.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.mode("overwrite").parquet(path)
    _STAGES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path), path


_STAGES: dict[str, list[str]] = {}


@contextmanager
def staging(spark):
    """Remove, on exit, the folders ``materialize`` staged inside the block.  Use it around a
    job whose results are written out, once nothing lazy still reads the staged files."""
    stages = _STAGES.setdefault(spark.sparkContext.applicationId, [])
    start = len(stages)
    try:
        yield
    finally:
        for path in stages[start:]:
            remove_path(spark, path)
        del stages[start:]


def remove_path(spark, path: str, uri: bool = False) -> None:
    """Delete a folder this library staged or owns (Hadoop file system of the path); ``uri``: the
    path is an escaped URI, as file metadata gives it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if uri else path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
