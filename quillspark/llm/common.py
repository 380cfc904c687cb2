"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a numpy step works on at once; a single longer text is a step of its own.
STEP_BYTES = 1 << 20


#: What Spark puts into one Arrow batch for a Python worker, at most: rows and bytes. It bounds a worker's memory.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; Arrow batches of the session are held to BATCH_ROWS and BATCH_BYTES where they were larger."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key)
        if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= most:
            spark.conf.set(key, str(most))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths that stored() has written and nobody has dropped; see drop_written().
_WRITTEN: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of spark.checkpoint.dir. Where that is unset a local session gets a folder of this machine; on a cluster it raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quillspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends there, and a lost executor loses nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, since: int = 0) -> None:
    """Deletes what stored() wrote, from the since-th path on; results that read it must have been written or collected before."""
    while len(_WRITTEN) > since:
        drop_path(spark, _WRITTEN.pop())


def written() -> int:
    return len(_WRITTEN)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def free(name: str, columns: list[str]) -> str:
    """The name, with as many underscores after it as make it none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: A key is hot from this share of all rows on, so there are at most so many hot keys.
HOT_KEYS = 1000


def join_unique(rows: DataFrame, each: DataFrame, key: str, total: int) -> DataFrame:
    """rows joined to each, which has a key once, with its rows n; total is the sum of n. Drops n.

    Keys with more than a HOT_KEYS-th of all rows, so HOT_KEYS at most, are broadcast and their rows
    stay where they are; the others are shuffled.
    """
    hot = each.where(F.col("n") * HOT_KEYS > total).drop("n")
    cold = each.where(F.col("n") * HOT_KEYS <= total).drop("n")
    # fewer than HOT_KEYS rows, by their definition
    there = F.broadcast(hot)
    return rows.join(there, key).unionByName(rows.join(there.select(key), key, "left_anti").join(cold, key))


def fold() -> Column:
    """crc32 of doc_id's decimal text, modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4


def draw() -> Column:
    """A fixed pseudo-random number of 0 to 1 for each doc_id."""
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit("draw")), F.lit(1 << 40)) / float(1 << 40)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes, and len + 1 offsets into them; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    arr = column.cast(kind)
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if kind == pa.large_binary() else "")
    _, offsets, data = arr.buffers()
    ends = np.frombuffer(offsets, np.int64, len(arr) + 1, arr.offset * 8) if len(arr) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes and so many rows, or of one row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(n, a + rows, max(b, a + 1))
        yield a, b
        a = b


def give_back() -> None:
    """Returns what this process has freed to the system: allocators keep it, and so does a worker that idles until its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, with freed memory returned once a task's batches are done."""

    @functools.wraps(run)
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return out


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n in turn, end to end."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
