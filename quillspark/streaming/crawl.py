"""Incremental crawling with Structured Streaming: events fold into the state table, posts become documents, once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillspark import schemas
from quillspark.operators.state import apply_events
from quillspark.sources.jsonl import exists


class StateTable:
    """Versions of the state in a folder, one for each batch: a batch that is run again reads the version before it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def version(self, batch: int) -> DataFrame:
        while batch >= 0:
            at = f"{self.path}/batch={batch}"
            if exists(self.spark, f"{at}/_SUCCESS"):
                return self.spark.read.schema(schemas.CRAWL_STATE).parquet(at)
            batch -= 1
        return self.spark.createDataFrame([], schemas.CRAWL_STATE)

    def latest(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.version(-1)
        fs = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        names = [s.getPath().getName() for s in fs.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(fs)]
        return self.version(max((int(n.split("=")[1]) for n in names if n.startswith("batch=")), default=-1))

    def apply(self, events: DataFrame, batch: int) -> None:
        apply_events(self.version(batch - 1), events).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def fold_stream(events: DataFrame, table: StateTable, checkpoint: str, **trigger) -> StreamingQuery:
    """Folds a stream of schemas.CRAWL_EVENT rows into the table; at-least-once batches have exactly-once results."""
    writer = events.writeStream.foreachBatch(lambda rows, batch: table.apply(rows, batch)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def first_seen_stream(posts: DataFrame, key: str = "slug", watermark: tuple[str, str] | None = None) -> DataFrame:
    """Each key's first row of a stream; with (column, delay) the keys are forgotten after the delay."""
    if watermark:
        return posts.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    return posts.dropDuplicates([key])


def document_stream(posts: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Builds documents of each batch of posts and writes them to a folder of the batch, artifacts before the checkpoint."""
    from quillspark.sinks.tables import write_documents

    writer = posts.writeStream.foreachBatch(lambda rows, batch: write_documents(build(rows), path, batch)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
