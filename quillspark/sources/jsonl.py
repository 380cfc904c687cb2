"""JSON Lines tables, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quillspark import schemas


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at a path of any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of a file or folder; a missing one is empty, blank lines are skipped, a malformed line fails the query."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def first_filled(spark: SparkSession, paths: tuple[str, ...], schema: str | StructType) -> DataFrame:
    """The first of these tables that has a row, or an empty one."""
    for path in paths:
        rows = read_jsonl(spark, path, schema)
        if not rows.isEmpty():
            return rows
    return spark.createDataFrame([], schema)


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Labelled queries: a JSON array of objects."""
    return spark.read.schema(schemas.EVAL_QUERY).option("multiLine", True).json(path)


def read_embedding_metadata(spark: SparkSession, path: str, model: str = "deterministic_hash", dimension: int = 384) -> dict:
    """model, backend and dimension of stored vectors; a missing or malformed file gives the defaults."""
    row = None
    if exists(spark, path):
        row = spark.read.schema(schemas.EMBEDDING_METADATA).option("mode", "PERMISSIVE").option("multiLine", True).json(path).first()
    held = row.asDict() if row else {}
    return {"model": held.get("model") or model, "backend": held.get("backend"), "dimension": held.get("dimension") or dimension}


def check_provenance(stored: dict, backend: str, dimension: int) -> None:
    """Stored vectors and queries must come from one backend and have one dimension."""
    if stored["backend"] not in (None, backend):
        raise ValueError(f"vectors are from {stored['backend']}, queries from {backend}")
    if stored["dimension"] != dimension:
        raise ValueError(f"vectors have {stored['dimension']} dimensions, queries {dimension}")


def data_folder(spark: SparkSession, backend: str, folder: str, sample: str) -> str:
    """Where a search reads from: the sample's folder where the given one has no documents and the sample does."""
    if backend not in ("local", "graph"):
        raise ValueError("backend must be 'local' or 'graph'")
    if not exists(spark, f"{folder}/documents.jsonl") and exists(spark, f"{sample}/documents.jsonl"):
        return sample
    return folder
