"""Staged retrieval metrics over labelled queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.search import QUERIES, Reranker, SearchIndex, best_per_document, expand, rerank, search_dense, search_hybrid, with_documents
from quillspark.session import bounded_batches, stored

STAGES = ("dense", "hybrid_graph", "hybrid_graph_rerank")


def holders(rows: DataFrame, key: str, text: str, passages: DataFrame, item: str, passage: str) -> DataFrame:
    """(item, key) of each passage and each text that holds it, for a bounded table of passages.

    A text is searched only for passages whose longest inner word it has: a word between blanks
    within a passage stands between the same blanks in a text that holds it. Passages of fewer than
    three words are searched for in all texts.
    """
    few = passages.select(item, passage).limit(QUERIES + 1).toArrow()
    if few.num_rows > QUERIES:
        return rows.join(passages, F.contains(text, passage)).select(item, key)
    bounded_batches(rows.sparkSession)
    ids = few[item].combine_chunks()
    by_word: dict[str, list[tuple[int, str]]] = {}
    short: list[tuple[int, str]] = []
    for i, p in enumerate(few[passage].to_pylist()):
        if p is not None:
            inner = p.split()[1:-1]
            (by_word.setdefault(max(inner, key=len), []) if inner else short).append((i, p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = by_word.keys()
        for batch in batches:
            at, found = [], []
            for n, value in enumerate(batch.column(1).to_pylist()):
                if value is None:
                    continue
                maybe = short + [x for w in known & set(value.split()) for x in by_word[w]]
                for i, p in maybe:
                    if p in value:
                        at.append(n)
                        found.append(i)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(found, pa.int64())), batch.column(0).take(pa.array(at, pa.int64()))], names=[item, key])

    kinds = (passages.schema[item].dataType.simpleString(), rows.schema[key].dataType.simpleString())
    return rows.select(key, text).mapInArrow(run, f"`{item}` {kinds[0]}, `{key}` {kinds[1]}")


def restrict_expected(labelled: DataFrame, documents: DataFrame) -> DataFrame:
    """Labelled queries (id, query, expected_document_ids, notes), with expected ids that are documents only."""
    each = labelled.select("id", F.posexplode("expected_document_ids").alias("pos", "d"))
    there = each.join(documents.select(F.col("id").alias("d")).distinct(), "d", "left_semi")
    kept = there.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "d"))).alias("x")).select("id", F.transform("x", lambda v: v.d).alias("kept"))
    return labelled.join(kept, "id", "left").select("id", "query", F.coalesce("kept", F.slice("expected_document_ids", 1, 0)).alias("expected_document_ids"), "notes")


def score(candidates: DataFrame, labelled: DataFrame, stage: str, k: int = 3) -> DataFrame:
    """A row of metrics for each labelled query: candidates have query_id, document_id, score, rank and maybe rerank_applied.

    Precision divides by k, recall by the expected; ranks are over each document's best chunk;
    top_score is that of the first candidate.
    """
    rows = candidates if "rerank_applied" in candidates.columns else candidates.withColumn("rerank_applied", F.lit(False))
    tops = rows.groupBy("query_id").agg(F.min_by("score", "rank").alias("top"), F.max("rerank_applied").alias("applied"))
    found = best_per_document(rows).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "document_id"))).alias("x")).select("query_id", F.transform("x", lambda v: v.document_id).alias("ids"))
    rows = labelled.withColumnRenamed("id", "query_id").join(found, "query_id", "left").join(tops, "query_id", "left")
    expected = F.col("expected_document_ids")
    ids = F.coalesce("ids", F.slice("expected_document_ids", 1, 0))
    hits = F.size(F.array_intersect(F.slice(ids, 1, k), expected))
    first = F.array_position(F.transform(ids, lambda d: F.array_contains(expected, d)), F.lit(True))
    rows = rows.select("query_id", "query", expected, ids.alias("retrieved_document_ids"), hits.alias("hits"), first.alias("first"), F.coalesce("top", F.lit(0.0)).alias("top_score"), F.coalesce("applied", F.lit(False)).alias("rerank_applied"), "notes")
    some = F.size("expected_document_ids") > 0
    return rows.select(
        F.lit(stage).alias("stage"), "query_id", "query", "expected_document_ids", "retrieved_document_ids",
        F.when(some, F.col("hits") / F.lit(float(k))).otherwise(0.0).alias("precision_at_k"),
        F.when(some, F.col("hits") / F.nullif(F.size("expected_document_ids"), F.lit(0))).otherwise(0.0).alias("recall_at_k"),
        F.when(F.col("first") > 0, 1.0 / F.nullif("first", F.lit(0))).otherwise(0.0).alias("reciprocal_rank"),
        (F.col("first") == 1).alias("hit_at_1"), F.col("first").between(1, 3).alias("hit_at_3"), "top_score", "rerank_applied", "notes",
    )


def evaluate(index: SearchIndex, documents: DataFrame, topics: DataFrame, labelled: DataFrame, top_k: int = 20, k: int = 3, dense_weight: float = 0.35, load: Callable[[], Reranker] | None = None) -> DataFrame:
    """Metrics of three stages at one depth: dense only, hybrid with context, and reranked (without a model: as before)."""
    # what is read for each stage is found once
    known = stored(restrict_expected(labelled, documents), "labelled")
    queries = known.select(F.col("id").alias("query_id"), "query")
    near = with_documents(search_dense(index, queries, top_k), index)
    pool = expand(search_hybrid(index, queries, top_k, dense_weight), index.chunks, documents, topics)
    again = rerank(pool, queries, load)
    stages = [score(rows, known, stage, k) for stage, rows in zip(STAGES, (near, pool, again), strict=True)]
    return stages[0].unionByName(stages[1]).unionByName(stages[2])


def summarize(results: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """A row for each stage, without results too: counts, and means over the queries that expect something."""
    positive = F.size("expected_document_ids") > 0
    mean = lambda c, name: F.coalesce(F.avg(F.when(positive, F.col(c).cast("double"))), F.lit(0.0)).alias(name)
    some = results.groupBy("stage").agg(
        F.count("*").alias("queries"), F.count_if(positive).alias("positive_queries"), mean("precision_at_k", "precision_at_k"), mean("recall_at_k", "recall_at_k"), mean("hit_at_1", "hit_at_1"), mean("hit_at_3", "hit_at_3"), mean("reciprocal_rank", "mrr"), F.count_if("rerank_applied").alias("reranked"),
    )
    every = results.sparkSession.createDataFrame([(s,) for s in stages], "stage string")
    return every.join(some, "stage", "left").na.fill(0)


def report(results: DataFrame, documents: int, k: int = 3) -> DataFrame:
    """One row: the report as JSON, with the data set's sizes, the stages' means and every result."""
    stages = summarize(results)
    rows = results.groupBy().agg(F.array_sort(F.collect_list(F.struct(*(c for c in results.columns)))).alias("results"), F.count_distinct("query_id").alias("queries"))
    means = stages.groupBy().agg(F.array_sort(F.collect_list(F.struct(*stages.columns))).alias("stages"))
    return rows.crossJoin(means).select(F.to_json(F.struct(F.struct(F.lit(documents).alias("documents"), "queries").alias("dataset"), F.lit(k).alias("metric_k"), "stages", "results")).alias("report"))
