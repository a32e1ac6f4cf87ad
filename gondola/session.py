"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Small shuffle partitions are merged up to this size, compressed.
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# A task scans up to this much of a file, compressed.
SCANNED = "spark.sql.files.maxPartitionBytes"

# Session-scoped SQL settings the plans count on. All can be set at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a task sorts and aggregates is many times that. Spark's default is 64 MB.
    MERGED: str(16 << 20),
    # A task groups what it scans, and keys may hardly repeat: its map grows with its piece of
    # the file, where a row takes some ten bytes. Spark's default is 128 MB.
    SCANNED: str(32 << 20),
    # Layout candidates keep up to 2,402 rows of one (rack, shelf, width);
    # the default of 1,000 would turn the map-side limit off.
    "spark.sql.optimizer.windowGroupLimitThreshold": "4096",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Rows may hold long texts: batches for Python workers are cut by rows and by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


# The training-data operators merge and scan as Spark does: more tasks write more to shuffle, and some
# of them are near their disk budget.
CORPUS_SETTINGS = {MERGED: str(64 << 20), SCANNED: str(128 << 20)}


def tune(spark: SparkSession, more: dict[str, str] | None = None) -> SparkSession:
    """Apply the session-scoped settings, then ``more``, and return the session."""
    for key, value in {**SETTINGS, **(more or {})}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("gondola")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@functools.cache
def _local_dir() -> str:
    """A temporary folder of this process, removed at its end."""
    path = tempfile.mkdtemp(prefix="gondola-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """A new folder for written tables, below the cluster's shared folder.

    ``spark.checkpoint.dir`` names the shared folder. Only where it is unset,
    as in local tests, a temporary folder stands in for it. Results read from such tables
    until they are used, so they stay; the folder's owner clears it between jobs.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all "
                             "executors share")
        base = _local_dir()
    return os.path.join(base, f"gondola-{uuid.uuid4().hex}")


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``checkpoint()`` a shared folder where the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors.
    """
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
