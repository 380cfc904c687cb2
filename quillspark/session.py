"""Sessions for local work, and what every session needs to run this package's Python functions."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: What Spark puts into one Arrow batch for a Python worker, at most: rows and bytes. It bounds a worker's memory.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A session on this machine; on a cluster the session comes from its launcher."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quillspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package from where the driver did; clusters ship it with --py-files."""
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of the session are held to BATCH_ROWS and BATCH_BYTES where they were larger."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key)
        if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= most:
            spark.conf.set(key, str(most))


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder of spark.checkpoint.dir (unset, as in tests: a folder of this machine), which cuts lineage."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quillspark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Returns what a Python worker has freed to the system: allocators keep it, and so does a worker that idles until its next task."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)
