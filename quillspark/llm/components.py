"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import _WRITTEN, drop_path, scratch


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of one type, neither null: a row (node, root) for each node of an edge, root being the component's least node.

    Every step is an aggregation, which folds before its shuffle, and a join to its result, which has
    a node once, so adaptive execution splits the partition of a hub. Edges stay at most what they were. A step's result is written to the shared folder, which cuts
    lineage; the driver sees a count and a checksum of it. Repeated edges and loops are harmless.
    """
    spark = edges.sparkSession
    schema = edges.select("a", "b").schema

    def write(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = scratch(spark, "edges")
        df.write.parquet(path)
        back = spark.read.schema(schema).parquet(path)
        return back, path, tuple(back.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())

    now, path, mark = write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        after, after_path, after_mark = write(small.where("a <> b").distinct())
        drop_path(spark, path)
        same = after_mark == mark
        now, path, mark = after, after_path, after_mark
        if same:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    _WRITTEN.append(path)
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
