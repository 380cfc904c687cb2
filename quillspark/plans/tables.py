"""The engine's tables, made from the synthetic ones: each as a DataFrame, and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.session import bounded_batches

REFERENCE = "STRUCT<source_slug:STRING,target_url:STRING,rel_type:STRING,anchor_text:STRING,context:STRING,target_slug:STRING>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's text as one chunk; its source stands for the document."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("document_id"), "text")


CHUNKS = "(SELECT doc_id AS chunk_id, source AS document_id, text FROM documents)"


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


_DOCUMENT = """
    concat('d', CAST(doc_id AS STRING)) AS id, doc_id AS seq, concat('d', CAST(doc_id AS STRING)) AS slug, concat('https://corpus.example/p/2024/d', CAST(doc_id AS STRING)) AS source_url,
    CASE WHEN lang = 'en' THEN concat('Title ', CAST(doc_id AS STRING)) END AS title_en, CASE WHEN doc_id % 3 = 0 THEN '' WHEN lang <> 'en' THEN concat('Titre ', CAST(doc_id AS STRING)) END AS title_ar,
    CAST(NULL AS STRING) AS date, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE concat(lang, '_kind') END AS document_type, CAST(n_chars AS STRING) AS number, source AS issuer_code,
    CASE WHEN lang = 'en' THEN text END AS content_en, CASE WHEN lang <> 'en' THEN text END AS content_ar"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with two references each: one to the next id, one further on, some to ids that are none, some of no legal relation."""
    rows = table(spark, sf_dir, "documents").selectExpr(*[x.strip() for x in _split(_DOCUMENT)], "doc_id")
    ref = lambda target, rel: F.struct(F.col("slug").alias("source_slug"), F.concat(F.lit("https://corpus.example/p/2024/"), target).alias("target_url"), rel.alias("rel_type"), F.concat(F.lit("see "), target).alias("anchor_text"), F.lit("context").alias("context"), target.alias("target_slug"))
    kind = F.element_at(F.array(F.lit("REFERENCES"), F.lit("REPEALS"), F.lit("AMENDS"), F.lit("CITES")), (F.col("doc_id") % 4 + 1).cast("int"))
    near = F.concat(F.lit("d"), (F.col("doc_id") + 1).cast("string"))
    far = F.concat(F.lit("d"), (F.col("doc_id") * 7 + 3).cast("string"))
    return rows.withColumn("cross_references", F.array(ref(near, kind), ref(far, F.lit("REFERENCES")))).drop("doc_id")


def _split(columns: str) -> list[str]:
    """At commas outside parentheses."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(columns):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(columns[at:i])
            at = i + 1
    return [*out, columns[at:]]


DOCUMENTS = f"""(SELECT {_DOCUMENT}, [
    {{'source_slug': 'd' || doc_id, 'rel_type': ['REFERENCES', 'REPEALS', 'AMENDS', 'CITES'][doc_id % 4 + 1], 'anchor_text': 'see d' || (doc_id + 1), 'target_slug': 'd' || (doc_id + 1)}},
    {{'source_slug': 'd' || doc_id, 'rel_type': 'REFERENCES', 'anchor_text': 'see d' || (doc_id * 7 + 3), 'target_slug': 'd' || (doc_id * 7 + 3)}}] AS cross_references FROM documents)"""

#: Keyword rules over the synthetic words.
RULES = {"Transport": ("thing", "quell"), "Taxation": ("tax", "disgust"), "Education": ("ation", "schul"), "Sports": ("trash", "idiot"), "Judiciary": ("licens", "cort")}


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document_id, seq, name, canonical_name): the rules' topics of each document; every seventh row's canonical name is empty."""
    from quillspark.operators.topics import keyword_topics

    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(keyword_topics(F.col("text"), RULES)).alias("pos", "name"))
    return rows.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("document_id"), (F.col("doc_id") * 10 + F.col("pos")).alias("seq"), "name", F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("name")).alias("canonical_name"))


_RULE_ROWS = ", ".join(f"({i}, '{name}', '{w}')" for i, (name, words) in enumerate(RULES.items()) for w in words)
TOPICS = f"""(SELECT 'd' || doc_id AS document_id, doc_id * 10 + row_number() OVER (PARTITION BY doc_id ORDER BY nth) - 1 AS seq, name, CASE WHEN doc_id % 7 = 0 THEN '' ELSE name END AS canonical_name
    FROM (SELECT DISTINCT doc_id, nth, name FROM documents JOIN (VALUES {_RULE_ROWS}) r(nth, name, word) ON contains(lower(text), word)))"""


def crawl_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl events (schemas.CRAWL_EVENT) from user events: views and the like discover a slug, others mark it, errors with a text."""
    e = table(spark, sf_dir, "events").selectExpr(*[x.strip() for x in _split(_EVENT)])
    return e


_EVENT = """event_id AS seq, CASE WHEN event_id % 3 = 0 THEN 'discovered' ELSE 'status' END AS kind, concat('u', CAST(user_id AS STRING)) AS slug,
    CASE WHEN event_id % 2 = 0 THEN event_id END AS post_id, concat('https://corpus.example/p/2024/u', CAST(event_id AS STRING)) AS source_url, CAST(event_id % 5 = 0 AS INT) AS is_gazette,
    CASE WHEN event_id % 4 = 0 THEN concat('https://translation.example/', CAST(event_id AS STRING)) END AS english_url,
    CASE WHEN event_id % 3 = 1 THEN 'failed' WHEN event_id % 5 = 2 THEN 'skipped_gazette' ELSE 'done' END AS status, CASE WHEN event_id % 3 = 1 AND event_id % 7 > 1 THEN event_type END AS error, ts AS at"""
EVENTS = f"(SELECT {_EVENT} FROM events)"
