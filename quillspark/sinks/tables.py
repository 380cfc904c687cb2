"""Sinks: JSON Lines, one-row JSON, Markdown files, and tables for a console."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import truthy


def write_jsonl(rows: DataFrame, path: str) -> None:
    """Overwrites a folder of JSON Lines, nulls kept."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("ignoreNullFields", False).json(path)


def write_json(row: DataFrame, path: str, column: str | None = None) -> None:
    """One small row (metadata, a report) as one JSON file; column is one that holds the JSON already."""
    out = row.select(column) if column else row.select(F.to_json(F.struct(*row.columns)))
    out.coalesce(1).write.mode("overwrite").text(path)


def write_embedding_metadata(vectors: DataFrame, path: str, model: str, backend: str) -> None:
    from quillspark.operators.graph import vector_dimension

    spark = vectors.sparkSession
    write_json(spark.createDataFrame([(model, backend, vector_dimension(vectors))], "model string, backend string, dimension int"), path)


def write_documents(documents: DataFrame, path: str, batch: int | None = None) -> None:
    """Appends documents as JSON Lines, and each content that isn't empty as Markdown under its language and slug.

    With a batch number the rows go to a folder of it, which is overwritten: writing a batch again changes nothing.
    """
    to = f"{path}/documents" if batch is None else f"{path}/documents/batch={batch}"
    documents.write.mode("append" if batch is None else "overwrite").option("ignoreNullFields", False).json(to)
    texts = documents.select("slug", F.expr("stack(2, 'ar', content_ar, 'en', content_en) AS (language, content)")).where(truthy("content").isNotNull())
    place = f"{path}/markdown" if batch is None else f"{path}/markdown/batch={batch}"
    texts.write.mode("append" if batch is None else "overwrite").partitionBy("language", "slug").text(place)


def write_merges(topics: DataFrame, pairs: DataFrame, audit: str, merged: str | None = None) -> None:
    """The audit of near-duplicate names always; renamed topics only where asked and there is a pair."""
    from quillspark.operators.topics import apply_merges

    write_jsonl(pairs.orderBy(F.col("score").desc(), "canonical", "duplicate"), audit)
    if merged and not pairs.isEmpty():
        write_jsonl(apply_merges(topics, pairs), merged)


def write_communities(assigned: DataFrame, described: DataFrame, path: str, summaries: str | None = None) -> None:
    write_jsonl(assigned, path)
    if summaries:
        write_jsonl(described, summaries)


def matches_table(final: DataFrame) -> DataFrame:
    """What a console shows of results: rank, score, document, topics (re-read from the context, cut) and text."""
    topics = F.left(F.regexp_extract("expanded_text", r"(?m)^Topics: (.*)$", 1), F.lit(60))
    return final.select("query_id", "rank", F.format_number("score", 4).alias("score"), "document_id", F.coalesce("title", F.lit("")).alias("title"), topics.alias("topics"), F.left("text", F.lit(80)).alias("text")).orderBy("query_id", "rank")


def stages_table(summary: DataFrame) -> DataFrame:
    return summary.select("stage", "queries", *(F.format_number(c, 3).alias(c) for c in ("precision_at_k", "recall_at_k", "hit_at_1", "hit_at_3", "mrr")), "reranked").orderBy("stage")
