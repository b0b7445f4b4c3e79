"""Session settings the operators rely on, and the place where lineage is cut."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "kindred", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A machine-local folder is only taken when the session itself runs on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="kindred-")


def checkpoint(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the session's shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner take shuffle files and checkpoints that nothing refers to any more. It learns of them when the
    driver collects its garbage, which may be long after a large stage is done with; jobs of several stages call
    this between them, so that the disk holds one stage's files and not those of all."""
    for _ in range(2):  # the first time the last query is still held
        gc.collect()
        spark._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for tables written and read back by one job. Its folder is
    removed when the application ends."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{base}/data"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
