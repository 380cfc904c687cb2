"""The engine's queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import html, text, urls, vectors
from quillspark.operators import chunking, community, crawl, evaluation, graph, search, state
from quillspark.operators import topics as topic_ops
from quillspark.plans import sql, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(statement: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if statement:
            SQL[f.__name__] = statement
        return f

    return keep


@_query(f"SELECT doc_id, len(w)::BIGINT AS n_tokens, len(list_distinct(w))::BIGINT AS n_different FROM (SELECT doc_id, {sql.tokens('text')} AS w FROM documents)")
def tokenize_counts(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "documents").select("doc_id", text.tokens("text").alias("w"))
    return rows.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.size(F.array_distinct("w")).cast("long").alias("n_different"))


@_query(f"SELECT item_id, array_to_string({sql.strong('text')}, ' OR ') AS terms FROM benchmark")
def query_terms(spark, sf_dir):
    return tables.table(spark, sf_dir, "benchmark").select("item_id", text.any_of_query("text").alias("terms"))


@_query(f"SELECT doc_id, len({sql.spaced('text')})::BIGINT AS n_words FROM documents")
def whitespace_token_counts(spark, sf_dir):
    return tables.table(spark, sf_dir, "documents").select("doc_id", text.approx_tokens("text").cast("long").alias("n_words"))


@_query(r"SELECT doc_id, left(trim(regexp_replace(text, '[\s\p{Z}\x{85}\x{0B}]+', ' ', 'g')), 350) AS snippet FROM documents")
def snippets(spark, sf_dir):
    return tables.table(spark, sf_dir, "documents").select("doc_id", text.snippet("text").alias("snippet"))


_STRIP = r"regexp_replace(regexp_replace({}, '^[\s\p{{Z}}\x{{85}}\x{{0B}}]+', ''), '[\s\p{{Z}}\x{{85}}\x{{0B}}]+$', '')"


@_query(f"""WITH w AS (SELECT doc_id, text, {sql.spaced('text')} AS t FROM documents),
    cut AS (SELECT doc_id, t, unnest(range(0, greatest(ceil((len(t) - 100) / 80.0), 0)::BIGINT + 1)) AS nth FROM w WHERE len(t) > 100)
    SELECT doc_id, nth::INTEGER AS "order", md5(array_to_string(t[nth * 80 + 1 : nth * 80 + 100], ' ')) AS digest FROM cut
    UNION ALL SELECT doc_id, 0, md5({_STRIP.format('text')}) FROM w WHERE len(t) BETWEEN 1 AND 100""")
def token_windows(spark, sf_dir):
    rows = chunking.token_windows(tables.table(spark, sf_dir, "documents"), "doc_id", "text", 100, 20)
    return rows.select("doc_id", "order", F.md5(F.col("text").cast("binary")).alias("digest"))


def _markdown(spark, sf_dir):
    """documents whose every fourth line is a heading."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.when((i % 4 == 1) & (F.trim(x) != ""), F.concat(F.lit("## "), x)).otherwise(x))
    return tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.lit("en").alias("language"), F.array_join(lines, "\n").alias("content"))


_SECTIONS = rf"""lines AS (SELECT doc_id, i, CASE WHEN (i - 1) % 4 = 1 AND trim(l) <> '' THEN '## ' || l ELSE l END AS line
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
    marked AS (SELECT *, CASE WHEN regexp_matches({_STRIP.format('line')}, '^#{{1,6}}\s+.+$') THEN trim(regexp_extract({_STRIP.format('line')}, '^(#{{1,6}})\s+(.+)$', 2)) END AS head FROM lines),
    numbered AS (SELECT *, sum((head IS NOT NULL)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS sid FROM marked),
    sections AS (SELECT doc_id, sid, max(head) AS heading, {_STRIP.format("string_agg(line, chr(10) ORDER BY i)")} AS body FROM numbered GROUP BY doc_id, sid),
    kept AS (SELECT *, len({sql.spaced('body')}) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY sid) AS k FROM sections WHERE body <> '')"""


@_query(f"""WITH RECURSIVE {_SECTIONS},
    fold AS (SELECT doc_id, k, CASE WHEN n > 80 THEN 1 ELSE 0 END AS gid, CASE WHEN n > 80 THEN 2 ELSE 0 END AS cur, CASE WHEN n > 80 THEN 0 ELSE n END AS held, n > 80 AS long, heading AS h, body FROM kept WHERE k = 1
      UNION ALL SELECT s.doc_id, s.k, CASE WHEN s.n > 80 OR (f.held > 0 AND f.held + s.n > 80) THEN f.cur + 1 ELSE f.cur END, CASE WHEN s.n > 80 THEN f.cur + 2 WHEN f.held > 0 AND f.held + s.n > 80 THEN f.cur + 1 ELSE f.cur END,
        CASE WHEN s.n > 80 THEN 0 WHEN f.held > 0 AND f.held + s.n > 80 THEN s.n ELSE f.held + s.n END, s.n > 80, coalesce(s.heading, f.h), s.body FROM fold f JOIN kept s ON s.doc_id = f.doc_id AND s.k = f.k + 1),
    groups AS (SELECT doc_id, gid, bool_or(long) AS long, arg_max(coalesce(h, chr(0)), k) AS h, string_agg(body, chr(10) || chr(10) ORDER BY k) AS body FROM fold GROUP BY doc_id, gid),
    cut AS (SELECT doc_id, gid, h, 0 AS part, body AS t FROM groups WHERE NOT long
      UNION ALL SELECT doc_id, gid, h, nth, array_to_string(w[nth * 70 + 1 : nth * 70 + 80], ' ') FROM (SELECT doc_id, gid, h, {sql.spaced('body')} AS w, unnest(range(0, greatest(ceil((len({sql.spaced('body')}) - 80) / 70.0), 0)::BIGINT + 1)) AS nth FROM groups WHERE long))
    SELECT doc_id || ':en:' || format('{{:04d}}', o) AS id, doc_id AS document_id, o::INTEGER AS "order", nullif(h, chr(0)) AS heading_path, md5(t) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY gid, part) - 1 AS o FROM cut)""")
def section_chunks(spark, sf_dir):
    rows = chunking.chunk(_markdown(spark, sf_dir), max_tokens=80, overlap=10)
    return rows.select("id", "document_id", "order", "heading_path", F.md5(F.col("text").cast("binary")).alias("digest"))


@_query(sql.slots("doc_id", "documents"))
def hash_embedding_nonzero(spark, sf_dir):
    return vectors.hash_nonzeros(tables.table(spark, sf_dir, "documents"), "doc_id", "text")


_INDEXES: dict[tuple[str, str, str], str] = {}


def _written(spark, sf_dir: str, kind: str, build: Callable[[], search.SearchIndex]) -> search.SearchIndex:
    """The index as tables in the shared folder: a session tokenises a corpus once, whatever its queries read of it."""
    import uuid

    from quillspark.sources.jsonl import exists

    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _INDEXES or not exists(spark, _INDEXES[key]):
        path = _shared(spark) + f"/index-{uuid.uuid4().hex}"
        build().save(path)
        _INDEXES[key] = path
    return search.SearchIndex.load(spark, _INDEXES[key])


def _index(spark, sf_dir):
    return _written(spark, sf_dir, "sources", lambda: search.build_index(tables.chunks(spark, sf_dir)))


@_query(f"WITH {sql.bm25('bm', tables.CHUNKS)} {sql.top('bm', 10)}")
def bm25_topk(spark, sf_dir):
    return search.search_bm25(_index(spark, sf_dir), tables.queries(spark, sf_dir), 10)


_DENSE01 = "d01 AS (SELECT query_id, chunk_id, CASE WHEN hi = lo THEN 0.0::DOUBLE ELSE (score - lo) / (hi - lo) END AS score FROM (SELECT *, min(score) OVER (PARTITION BY query_id) AS lo, max(score) OVER (PARTITION BY query_id) AS hi FROM de))"


@_query(f"WITH {sql.dense('de', tables.CHUNKS)}, {_DENSE01}, r AS (SELECT query_id, chunk_id, round(score, 6) AS score FROM d01 WHERE score > 0) {sql.top('r', 10)}")
def dense_topk(spark, sf_dir):
    return search.search_dense(_index(spark, sf_dir), tables.queries(spark, sf_dir), 10)


_HYBRID = f"""{sql.bm25('bm', tables.CHUNKS)}, {sql.dense('de', tables.CHUNKS)}, {_DENSE01},
    ends AS (SELECT query_id, CASE WHEN count(*) < (SELECT n FROM bm_facts) THEN least(min(score), 0) ELSE min(score) END AS lo, CASE WHEN count(*) < (SELECT n FROM bm_facts) THEN greatest(max(score), 0) ELSE max(score) END AS hi FROM bm GROUP BY query_id),
    s01 AS (SELECT d.query_id, d.chunk_id, d.score AS dense_score, CASE WHEN e.query_id IS NULL OR hi = lo THEN 0.0::DOUBLE ELSE (coalesce(b.score, 0) - lo) / (hi - lo) END AS bm25_score FROM d01 d LEFT JOIN bm b ON b.query_id = d.query_id AND b.chunk_id = d.chunk_id LEFT JOIN ends e ON e.query_id = d.query_id),
    hy AS (SELECT query_id, chunk_id, round(bm25_score + 0.35::DOUBLE * greatest(0.0::DOUBLE, dense_score - bm25_score), 6) AS score, round(dense_score, 6) AS dense_score, round(bm25_score, 6) AS bm25_score FROM s01),
    hits AS ({sql.top('(FROM hy WHERE score > 0)', 50, 'query_id, chunk_id, score, dense_score, bm25_score')})"""


@_query(f"WITH {_HYBRID} SELECT * FROM hits")
def hybrid_topk(spark, sf_dir):
    return search.search_hybrid(_index(spark, sf_dir), tables.queries(spark, sf_dir), 50)


@_query(f"""WITH {_HYBRID}, best AS (SELECT h.*, source AS document_id FROM hits h JOIN documents ON doc_id = chunk_id QUALIFY row_number() OVER (PARTITION BY query_id, source ORDER BY rank) = 1)
    SELECT * EXCLUDE (rank, r), r::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS r FROM best) WHERE r <= 5""")
def hybrid_dedup_topn(spark, sf_dir):
    index = _index(spark, sf_dir)
    return search.best_per_document(search.with_documents(search.search_hybrid(index, tables.queries(spark, sf_dir), 50), index), 5)


_WINDOWS = f"""wins AS (SELECT doc_id * 10000 + nth AS chunk_id, doc_id AS document_id, array_to_string(t[nth * 80 + 1 : nth * 80 + 100], ' ') AS text
    FROM (SELECT doc_id, t, unnest(range(0, greatest(ceil((len(t) - 100) / 80.0), 0)::BIGINT + 1)) AS nth FROM (SELECT doc_id, {sql.spaced('text')} AS t FROM documents)) WHERE len(t) > 0)"""


def _window_index(spark, sf_dir):
    rows = chunking.token_windows(tables.table(spark, sf_dir, "documents"), "doc_id", "text", 100, 20)
    return _written(spark, sf_dir, "windows", lambda: search.build_index(rows.select((F.col("doc_id") * 10000 + F.col("order")).alias("chunk_id"), F.col("doc_id").alias("document_id"), "text")))


_FULLTEXT = f"""{_WINDOWS}, {sql.bm25('own', 'wins', asked=sql.strong('text'))}, {sql.bm25('doc', tables.CHUNKS, asked=sql.strong('text'))},
    spread AS (SELECT query_id, w.chunk_id, max(score) AS score FROM doc d JOIN wins w ON w.document_id = d.chunk_id GROUP BY ALL),
    ft AS (SELECT query_id, chunk_id, max(score) AS score FROM (SELECT query_id, chunk_id, score FROM ({sql.top('own', 50)}) UNION ALL SELECT query_id, chunk_id, score FROM ({sql.top('spread', 50)})) GROUP BY ALL)"""


@_query(f"WITH {_FULLTEXT} SELECT query_id, chunk_id, score FROM ft")
def fulltext_max_merge(spark, sf_dir):
    return search.fulltext_hits(_window_index(spark, sf_dir), _index(spark, sf_dir), tables.queries(spark, sf_dir), 50)


@_query(f"""WITH {_FULLTEXT}, {sql.dense('de', 'wins')}, near AS ({sql.top('de', 50)}),
    a AS (SELECT query_id, chunk_id, CASE WHEN hi = lo THEN 1.0::DOUBLE ELSE (score - lo) / (hi - lo) END AS x FROM (SELECT *, min(score) OVER (PARTITION BY query_id) AS lo, max(score) OVER (PARTITION BY query_id) AS hi FROM near)),
    b AS (SELECT query_id, chunk_id, CASE WHEN hi = lo THEN 1.0::DOUBLE ELSE (score - lo) / (hi - lo) END AS y FROM (SELECT *, min(score) OVER (PARTITION BY query_id) AS lo, max(score) OVER (PARTITION BY query_id) AS hi FROM ft)),
    f AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.chunk_id, b.chunk_id) AS chunk_id, coalesce(x, 0.0::DOUBLE) AS x, coalesce(y, 0.0::DOUBLE) AS y FROM a FULL JOIN b ON a.query_id = b.query_id AND a.chunk_id = b.chunk_id),
    g AS (SELECT query_id, chunk_id, round(y + 0.35::DOUBLE * greatest(0.0::DOUBLE, x - y), 6) AS score, round(x, 6) AS dense_score, round(y, 6) AS bm25_score FROM f)
    {sql.top('g', 50, 'query_id, chunk_id, score, dense_score, bm25_score')}""")
def graph_style_fusion(spark, sf_dir):
    return search.search_graph(_window_index(spark, sf_dir), _index(spark, sf_dir), tables.queries(spark, sf_dir), 50)


_COSINE = "list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)) / sqrt(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE * x::DOUBLE)) * list_sum(list_transform(b.embedding, lambda x: x::DOUBLE * x::DOUBLE)))"


@_query(f"""SELECT query_id, chunk_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id)::INTEGER AS rank FROM (
    SELECT a.label AS query_id, b.vec_id AS chunk_id, round({_COSINE}, 6) AS score FROM (SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label) a, embeddings b)) WHERE rank <= 20""")
def vector_topk(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "embeddings")
    asked = rows.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("asked"))
    pairs = rows.select(F.col("vec_id").alias("chunk_id"), "embedding").crossJoin(search._small(asked))
    return search.top_k(pairs.select("query_id", "chunk_id", F.round(vectors.cosine("asked", "embedding"), 6).alias("score")), 20)


@_query()
def vector_topk_approximate(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "embeddings")
    asked = rows.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return search.approximate_hits(rows.select(F.col("vec_id").alias("chunk_id"), "embedding"), asked, 20)


def _topic_documents(spark, sf_dir):
    return tables.documents(spark, sf_dir)


_KEYWORD_ROWS = ", ".join(f"({i}, '{n}', '{w}')" for i, (n, ws) in enumerate(topic_ops.KEYWORDS.items()) for w in ws)
_RULED = f"""ruled AS (SELECT id, nth, name, row_number() OVER (PARTITION BY id ORDER BY nth) - 1 AS seq FROM (SELECT DISTINCT id, nth, name FROM {tables.DOCUMENTS} d JOIN (VALUES {_KEYWORD_ROWS}) k(nth, name, word)
    ON contains(lower(concat_ws(' ', coalesce(title_ar, ''), coalesce(title_en, ''), coalesce(content_ar, ''), coalesce(content_en, ''))), word)))"""


@_query(f"""WITH {_RULED} SELECT id AS document_id, seq::INTEGER AS seq, name, name AS canonical_name, 0.62::DOUBLE AS confidence, 'keyword fallback' AS evidence FROM ruled WHERE seq < 6
    UNION ALL SELECT id, 0, upper(left(document_type, 1)) || substr(document_type, 2, 2) || 'Kind', upper(left(document_type, 1)) || substr(document_type, 2, 2) || 'Kind', 0.45::DOUBLE, 'document type fallback'
      FROM (SELECT id, replace(document_type, '_', ' ') AS document_type FROM {tables.DOCUMENTS} WHERE document_type IS NOT NULL) WHERE id NOT IN (SELECT id FROM ruled)""")
def topic_rules(spark, sf_dir):
    return topic_ops.rule_topics(_topic_documents(spark, sf_dir))


@_query("""SELECT label, (generate_subscripts(embedding, 1) - 1)::INTEGER AS place, round(avg(x), 9) AS x FROM (SELECT label, embedding, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS place FROM embeddings) GROUP BY 1, 2""".replace("(generate_subscripts(embedding, 1) - 1)::INTEGER AS place, round", "place::INTEGER AS place, round"))
def label_centroids(spark, sf_dir):
    means = topic_ops.centroids(tables.table(spark, sf_dir, "embeddings"), "label")
    return means.select(F.col("name").alias("label"), F.posexplode("centroid").alias("place", "x")).select("label", "place", F.round("x", 9).alias("x"))


_PAIRS = """means AS (SELECT label, list(x ORDER BY place) AS embedding FROM (SELECT label, place, avg(x) AS x FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place FROM embeddings) GROUP BY ALL) GROUP BY label),
    pairs AS (SELECT CASE WHEN length(a.label::VARCHAR) <= length(b.label::VARCHAR) THEN a.label ELSE b.label END AS canonical, CASE WHEN length(a.label::VARCHAR) <= length(b.label::VARCHAR) THEN b.label ELSE a.label END AS duplicate, round({cosine}, 6) AS score
      FROM means a JOIN means b ON a.label < b.label WHERE round({cosine}, 9) >= {threshold}::DOUBLE)"""


@_query(f"WITH {_PAIRS.format(cosine=_COSINE, threshold=0.0)} SELECT canonical, duplicate, score FROM pairs")
def duplicate_label_pairs(spark, sf_dir):
    pairs = topic_ops.duplicate_pairs(topic_ops.centroids(tables.table(spark, sf_dir, "embeddings"), "label"), 0.0)
    return pairs.select("canonical", "duplicate", F.round("score", 6).alias("score"))


@_query(f"""WITH {_PAIRS.format(cosine=_COSINE, threshold=0.0)}, mapping AS (SELECT duplicate, arg_min(canonical, score) AS canonical FROM pairs GROUP BY duplicate)
    SELECT vec_id, coalesce(canonical, label) AS label FROM embeddings LEFT JOIN mapping ON duplicate = label""")
def topic_merge_apply(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return topic_ops.apply_merges(rows, topic_ops.duplicate_pairs(topic_ops.centroids(rows, "label"), 0.0), "label").select("vec_id", "label")


@_query("SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def upsert_last_wins(spark, sf_dir):
    return graph.last_per_key(tables.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), ("user_id",), "event_id")


_EDGES = f"""refs AS (SELECT id AS src, unnest(cross_references) AS r FROM {tables.DOCUMENTS}), edges AS (SELECT DISTINCT src, r.rel_type AS rel_type, r.target_slug AS dst, r.anchor_text AS anchor_text FROM refs WHERE r.rel_type IN ('REFERENCES', 'REPEALS', 'AMENDS'))"""


@_query(f"WITH {_EDGES} SELECT * FROM edges")
def edge_dedupe(spark, sf_dir):
    return graph.reference_edges(tables.documents(spark, sf_dir)).select("src", "rel_type", "dst", "anchor_text")


@_query(f"WITH {_EDGES} SELECT id, title_en IS NULL AND number IS NULL AS stub FROM {tables.DOCUMENTS} UNION ALL SELECT DISTINCT dst, true FROM edges WHERE dst NOT IN (SELECT id FROM {tables.DOCUMENTS})")
def stub_nodes(spark, sf_dir):
    docs = tables.documents(spark, sf_dir)
    return graph.with_stubs(docs, graph.reference_edges(docs)).select("id", (F.col("title_en").isNull() & F.col("number").isNull()).alias("stub"))


@_query("SELECT 'd' || doc_id AS document_id, 'en' AS language, 'c' || conv_id || ':' || turn AS chunk_id, turn AS \"order\" FROM conversations JOIN documents ON doc_id = conv_id")
def chunk_edges(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "conversations").select(F.concat(F.lit("d"), F.col("conv_id").cast("string")).alias("document_id"), F.lit("en").alias("language"), F.concat_ws(":", F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.col("turn").cast("string")).alias("id"), F.col("turn").alias("order"))
    return graph.chunk_edges(rows, tables.documents(spark, sf_dir)).select("document_id", "language", "chunk_id", "order")


@_query(f"SELECT document_id, canonical_name, name FROM {tables.TOPICS} QUALIFY row_number() OVER (PARTITION BY document_id, canonical_name ORDER BY seq DESC) = 1")
def topic_edges(spark, sf_dir):
    rows = tables.topics(spark, sf_dir).withColumns({"confidence": F.lit(0.62), "evidence": F.col("name")})
    return graph.topic_edges(rows, tables.documents(spark, sf_dir)).select("document_id", "canonical_name", F.col("evidence").alias("name"))


@_query(f"""SELECT id AS document_id, coalesce(text, '') || chr(10) || concat_ws(' ', coalesce(title_en, ''), coalesce(title_ar, ''), coalesce(document_type, ''), coalesce(number, ''), coalesce(issuer_code, '')) || chr(10) || coalesce(t, '') AS index_text
    FROM {tables.DOCUMENTS} JOIN documents ON 'd' || doc_id = id LEFT JOIN (SELECT document_id, string_agg(coalesce(nullif(canonical_name, ''), name, ''), ' ' ORDER BY seq) AS t FROM {tables.TOPICS} GROUP BY 1) ON document_id = id""")
def index_texts(spark, sf_dir):
    docs = tables.documents(spark, sf_dir)
    rows = docs.select(F.col("id").alias("document_id"), F.coalesce("content_en", "content_ar").alias("text"))
    return search.index_text(rows, docs, tables.topics(spark, sf_dir)).select("document_id", "index_text")


_CONTEXT = "coalesce(text, '') || chr(10) || chr(10) || '--- Graph Context ---' || chr(10) || 'Document: ' || {title} || chr(10) || 'Date: None' || chr(10) || 'Type: ' || coalesce(document_type, 'None') || chr(10) || 'Number: ' || coalesce(number, 'None') || chr(10) || 'Topics: ' || coalesce(names, '') || chr(10) || 'References: ' || coalesce(refs, '')"
_DOC_CHUNKS = "(SELECT doc_id AS chunk_id, 'd' || doc_id AS document_id, text FROM documents)"
_TITLE = "coalesce(nullif(title_en, ''), nullif(title_ar, ''))"


def _doc_chunks(spark, sf_dir):
    return tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("document_id"), "text")


@_query(f"""WITH {_HYBRID}, names AS (SELECT document_id, string_agg(n, ', ' ORDER BY n) AS names FROM (SELECT DISTINCT document_id, coalesce(nullif(canonical_name, ''), name) AS n FROM {tables.TOPICS}) GROUP BY 1),
    refs AS (SELECT id, array_to_string(list_transform(cross_references, lambda r: r.rel_type || ' ' || r.anchor_text), '; ') AS refs FROM {tables.DOCUMENTS})
    SELECT query_id, chunk_id, rank, md5({_CONTEXT.format(title=f"coalesce({_TITLE}, 'None')")}) AS digest FROM hits JOIN {_DOC_CHUNKS} c USING (chunk_id) LEFT JOIN {tables.DOCUMENTS} d ON d.id = c.document_id LEFT JOIN names ON names.document_id = c.document_id LEFT JOIN refs ON refs.id = c.document_id""")
def local_context(spark, sf_dir):
    hits = search.search_hybrid(_index(spark, sf_dir), tables.queries(spark, sf_dir), 50)
    rows = search.expand(hits, _doc_chunks(spark, sf_dir), tables.documents(spark, sf_dir), tables.topics(spark, sf_dir))
    return rows.select("query_id", "chunk_id", "rank", F.md5(F.col("expanded_text").cast("binary")).alias("digest"))


@_query(f"""WITH {sql.bm25('bm', tables.CHUNKS)}, hits AS ({sql.top('bm', 10)}), {_EDGES}, names AS (SELECT document_id, string_agg(n, ', ' ORDER BY n) AS names FROM (SELECT DISTINCT document_id, canonical_name AS n FROM {tables.TOPICS}) GROUP BY 1),
    rs AS (SELECT src, list_sort(list(DISTINCT e.rel_type || ' ' || coalesce({_TITLE}, id)))[1:5] AS l FROM edges e JOIN {tables.DOCUMENTS} t ON t.id = dst GROUP BY src), said AS (SELECT src, array_to_string(l, '; ') AS refs FROM rs)
    SELECT query_id, chunk_id, rank, md5({_CONTEXT.format(title=f"coalesce({_TITLE}, d.id)")}) AS digest FROM hits JOIN {_DOC_CHUNKS} c USING (chunk_id) JOIN {tables.DOCUMENTS} d ON d.id = c.document_id LEFT JOIN names ON names.document_id = c.document_id LEFT JOIN said ON said.src = c.document_id""")
def hydrate_context(spark, sf_dir):
    docs = tables.documents(spark, sf_dir)
    hits = search.search_bm25(_index(spark, sf_dir), tables.queries(spark, sf_dir), 10)
    rows = search.hydrate(hits, _doc_chunks(spark, sf_dir), docs, tables.topics(spark, sf_dir).select("document_id", "canonical_name"), graph.reference_edges(docs))
    return rows.select("query_id", "chunk_id", "rank", F.md5(F.col("expanded_text").cast("binary")).alias("digest"))


@_query(f"""WITH {_HYBRID}, best AS (SELECT query_id, chunk_id, rank, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS r FROM hits),
    said AS (SELECT query_id, string_agg('[' || r || '] ' || coalesce({_TITLE}, d.id) || ': ' || left(trim(regexp_replace(text, '[\\s\\p{{Z}}\\x{{85}}\\x{{0B}}]+', ' ', 'g')), 350), chr(10) ORDER BY r) AS a FROM best JOIN {_DOC_CHUNKS} c USING (chunk_id) JOIN {tables.DOCUMENTS} d ON d.id = c.document_id WHERE r <= 5 GROUP BY 1)
    SELECT item_id AS query_id, coalesce('LLM synthesis is disabled, so here is an extractive answer from the top retrieved contexts:' || chr(10) || a, 'No matching context was found.') AS answer FROM benchmark LEFT JOIN said ON query_id = item_id""")
def extractive_answer(spark, sf_dir):
    found = search.run_search(_written(spark, sf_dir, "documents", lambda: search.build_index(_doc_chunks(spark, sf_dir))), tables.documents(spark, sf_dir), tables.topics(spark, sf_dir), tables.queries(spark, sf_dir))
    return found.answers


_LABELLED = f"""labelled AS (SELECT b.item_id AS query_id, coalesce((SELECT list('d' || doc_id ORDER BY doc_id) FROM documents d WHERE contains(d.text, b.text)), []) AS expected FROM benchmark b)"""


def _labelled(spark, sf_dir):
    """Benchmark items, with the documents that hold them expected."""
    asked = tables.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("passage"))
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    held = evaluation.holders(docs, "doc_id", "text", asked, "item_id", "passage").groupBy("item_id").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    named = F.transform(F.coalesce("ids", F.array().cast("array<bigint>")), lambda d: F.concat(F.lit("d"), d.cast("string")))
    return asked.join(held, "item_id", "left").select(F.col("item_id").alias("id"), F.col("passage").alias("query"), named.alias("expected_document_ids"), F.lit("").alias("notes"))


_METRICS = f"""{_HYBRID}, {_LABELLED}, r AS ({sql.top('(SELECT query_id, chunk_id, round(score, 6) AS score FROM d01 WHERE score > 0)', 20)}),
    cand AS (SELECT 'dense' AS stage, query_id, chunk_id, score, rank FROM r UNION ALL SELECT s, query_id, chunk_id, score, rank FROM hits, (VALUES ('hybrid_graph'), ('hybrid_graph_rerank')) v(s) WHERE rank <= 20),
    lists AS (SELECT stage, query_id, list('d' || chunk_id ORDER BY rank) AS ids, arg_min(score, rank) AS top_score FROM cand GROUP BY ALL),
    rows AS (SELECT s AS stage, l.query_id, expected, coalesce(ids, []) AS ids, coalesce(top_score, 0.0::DOUBLE) AS top_score FROM labelled l CROSS JOIN (VALUES ('dense'), ('hybrid_graph'), ('hybrid_graph_rerank')) v(s) LEFT JOIN lists t ON t.query_id = l.query_id AND t.stage = s),
    ranked AS (SELECT *, len(list_intersect(ids[1:3], expected)) AS hit, coalesce(list_position(list_transform(ids, lambda i: list_contains(expected, i)), true), 0) AS first FROM rows),
    metrics AS (SELECT stage, query_id, len(expected)::INTEGER AS n_expected, len(ids)::INTEGER AS n_retrieved, CASE WHEN len(expected) > 0 THEN hit / 3.0::DOUBLE ELSE 0.0::DOUBLE END AS precision_at_k, CASE WHEN len(expected) > 0 THEN hit / len(expected)::DOUBLE ELSE 0.0::DOUBLE END AS recall_at_k,
      CASE WHEN first > 0 THEN 1.0::DOUBLE / first ELSE 0.0::DOUBLE END AS reciprocal_rank, first = 1 AS hit_at_1, first BETWEEN 1 AND 3 AS hit_at_3, top_score FROM ranked)"""


def _results(spark, sf_dir):
    index = _written(spark, sf_dir, "documents", lambda: search.build_index(_doc_chunks(spark, sf_dir)))
    return evaluation.evaluate(index, tables.documents(spark, sf_dir), tables.topics(spark, sf_dir), _labelled(spark, sf_dir))


@_query(f"WITH {_METRICS} SELECT stage, query_id, n_expected, n_retrieved, round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k, round(reciprocal_rank, 6) AS reciprocal_rank, hit_at_1, hit_at_3, top_score FROM metrics")
def retrieval_metrics(spark, sf_dir):
    r = _results(spark, sf_dir)
    return r.select("stage", "query_id", F.size("expected_document_ids").alias("n_expected"), F.size("retrieved_document_ids").alias("n_retrieved"), *(F.round(c, 6).alias(c) for c in ("precision_at_k", "recall_at_k", "reciprocal_rank")), "hit_at_1", "hit_at_3", "top_score")


@_query(f"""WITH {_METRICS} SELECT stage, count(*) AS queries, count(*) FILTER (n_expected > 0) AS positive_queries, round(avg(precision_at_k) FILTER (n_expected > 0), 6) AS precision_at_k, round(avg(recall_at_k) FILTER (n_expected > 0), 6) AS recall_at_k,
    round(avg(hit_at_1::INT) FILTER (n_expected > 0), 6) AS hit_at_1, round(avg(hit_at_3::INT) FILTER (n_expected > 0), 6) AS hit_at_3, round(avg(reciprocal_rank) FILTER (n_expected > 0), 6) AS mrr, 0::BIGINT AS reranked FROM metrics GROUP BY stage""")
def stage_summary(spark, sf_dir):
    s = evaluation.summarize(_results(spark, sf_dir))
    return s.select("stage", "queries", "positive_queries", *(F.round(c, 6).alias(c) for c in ("precision_at_k", "recall_at_k", "hit_at_1", "hit_at_3", "mrr")), "reranked")


_STATE = f"""ev AS {tables.EVENTS}, firsts AS (SELECT slug, min(seq) AS f FROM ev WHERE kind = 'discovered' GROUP BY slug), e AS (SELECT ev.*, f FROM ev JOIN firsts USING (slug)),
    st AS (SELECT slug, arg_max(post_id, seq) FILTER (kind = 'discovered' AND post_id IS NOT NULL) AS post_id, arg_max(source_url, seq) FILTER (kind = 'discovered') AS source_url,
      coalesce(arg_max(status, seq) FILTER (kind = 'status' AND seq > f), 'pending') AS status, count(*) FILTER (kind = 'status' AND seq > f AND error IS NOT NULL)::INTEGER AS retries, arg_max(is_gazette, seq) FILTER (kind = 'discovered') AS is_gazette,
      arg_max(english_url, seq) FILTER (kind = 'discovered' AND english_url IS NOT NULL) AS english_url, arg_max_null(error, seq) FILTER (kind = 'status' AND seq > f) AS error FROM e GROUP BY slug)"""


def _state(spark, sf_dir):
    from quillspark import schemas

    return state.apply_events(spark.createDataFrame([], schemas.CRAWL_STATE), tables.crawl_events(spark, sf_dir))


@_query(f"WITH {_STATE} SELECT * FROM st")
def crawl_state_final(spark, sf_dir):
    return _state(spark, sf_dir).drop("updated_at")


@_query(f"WITH {_STATE} SELECT slug, status, retries FROM st WHERE status IN ('pending', 'failed') AND retries <= 5")
def pending_records(spark, sf_dir):
    return state.pending(_state(spark, sf_dir)).select("slug", "status", "retries")


@_query(f"WITH {_STATE} SELECT * FROM st")
def crawl_state_stream(spark, sf_dir):
    """The same state by a stream of files, folded batch by batch into the versioned table."""
    import uuid

    from quillspark.streaming.crawl import StateTable, fold_stream

    base = _shared(spark) + f"/crawl-{uuid.uuid4().hex}"
    # the stream sees event files in order of seq
    events = tables.crawl_events(spark, sf_dir)
    cuts = events.approxQuantile("seq", [0.34, 0.67], 0.01) if not events.isEmpty() else [0, 0]
    for n, (lo, hi) in enumerate(((None, cuts[0]), (cuts[0], cuts[1]), (cuts[1], None))):
        part = events.where((F.lit(True) if lo is None else F.col("seq") > lo) & (F.lit(True) if hi is None else F.col("seq") <= hi))
        part.write.parquet(f"{base}/events/part={n}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 100_000).parquet(f"{base}/events/part=*")
    table = StateTable(spark, f"{base}/state")
    fold_stream(stream, table, f"{base}/checkpoint").awaitTermination()
    return table.latest().drop("updated_at")


def _shared(spark: SparkSession) -> str:
    import tempfile

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return base.rstrip("/") if base else "file://" + tempfile.mkdtemp(prefix="quillspark-")


_SLUG = r"nullif(regexp_extract(regexp_extract({}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/(?:p/)?[0-9]{{4}}/([^/?#]+)/?', 1), '')"
_PAGE_URL = "'https://corpus.example/p/2024/' || page_id || '?x=' || url"


@_query(f"SELECT page_id, {_SLUG.format('u')} AS slug, {_SLUG.format('url')} AS own_slug, regexp_extract(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1) AS host, true AS is_corpus, page_id % 2 = 0 AS gazette FROM (SELECT *, {_PAGE_URL} AS u FROM pages)")
def page_slugs(spark, sf_dir):
    u = F.concat(F.lit("https://corpus.example/p/2024/"), F.col("page_id").cast("string"), F.lit("?x="), "url")
    rows = tables.table(spark, sf_dir, "pages").withColumn("u", u)
    name = F.concat(F.when(F.col("page_id") % 2 == 0, "og").otherwise("rd"), F.col("page_id").cast("string"))
    return rows.select("page_id", urls.slug_of("u").alias("slug"), urls.slug_of("url").alias("own_slug"), urls.host("u").alias("host"), urls.is_corpus_url("u").alias("is_corpus"), urls.is_gazette_slug(name).alias("gazette"))


_PDF = "CASE doc_id % 5 WHEN 0 THEN 'https://data.corpus.example/ar/md/' || source || '/2024-00' || doc_id || '.pdf' WHEN 1 THEN 'https://data.corpus.example/ar/rd/2023-' || doc_id || '.pdf' WHEN 2 THEN 'https://data.corpus.example/og/ar2/issue' || doc_id || '.pdf' WHEN 3 THEN 'https://data.corpus.example/x/' || doc_id || '.pdf' ELSE 'https://data.corpus.example/files/ar/laws/' || doc_id || '.pdf' END"


@_query(f"""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'md' WHEN 1 THEN 'rd' WHEN 2 THEN 'og' WHEN 4 THEN 'laws' END AS family, CASE doc_id % 5 WHEN 0 THEN '2024' WHEN 1 THEN '2023' END AS year, CASE WHEN doc_id % 5 = 0 THEN source END AS issuer_code,
    CASE doc_id % 5 WHEN 0 THEN doc_id::VARCHAR WHEN 1 THEN doc_id::VARCHAR WHEN 2 THEN 'issue' || doc_id END AS serial, CASE doc_id % 5 WHEN 0 THEN 'ministerial_decision' WHEN 1 THEN 'royal_decree' WHEN 2 THEN 'official_gazette' WHEN 4 THEN 'laws' END AS kind FROM documents""")
def pdf_metadata(spark, sf_dir):
    pdf = F.expr(_PDF)
    m = urls.pdf_metadata(pdf)
    return tables.table(spark, sf_dir, "documents").select("doc_id", *(m[c].alias(c) for c in ("family", "year", "issuer_code", "serial")), urls.document_type(F.concat(F.lit("x"), F.col("doc_id").cast("string")), pdf).alias("kind"))


_WORDS = ["بعد الاطلاع على", "يلغى", "يعدل و تلغى", "تضاف مادة", "وعلى", "plain"]


@_query("SELECT doc_id, CASE doc_id % 6 WHEN 1 THEN 'REPEALS' WHEN 2 THEN 'REPEALS' WHEN 3 THEN 'AMENDS' ELSE 'REFERENCES' END AS rel_type FROM documents")
def reference_classes(spark, sf_dir):
    context = F.concat("text", F.lit(" "), F.element_at(F.array(*map(F.lit, _WORDS)), (F.col("doc_id") % 6 + 1).cast("int")))
    return tables.table(spark, sf_dir, "documents").select("doc_id", text.relation_of(context).alias("rel_type"))


@_query(r"""SELECT page_id, (generate_subscripts(h, 1) - 1)::INTEGER AS pos, unnest(h) AS href FROM (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->', '', 'g'), '(?i)<a\s[^>]*?href="([^"]*)"', 1) AS h FROM pages)""")
def page_links(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "pages").select("page_id", F.explode(html.page_links("html")).alias("x"))
    return rows.select("page_id", "x.pos", "x.href")


@_query()
def page_texts(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "pages")
    return rows.select("page_id", html.page_title("html").alias("title"), F.length(html.article_html("html")).alias("article_chars"), F.length(html.clean_html("html")).alias("clean_chars"), F.length(html.html_to_markdown("html")).alias("markdown_chars"), html.detail_number("html").alias("number"), F.length(html.strip_html_text("html")).alias("text_chars"))


_POST = """'<p>' || CASE page_id % 3 WHEN 0 THEN 'يلغى' ELSE 'وعلى' END || ' <a href="/p/2024/s' || (page_id + 1) || '/">next</a> and <a href="https://corpus.example/p/2023/s' || page_id || '/">self</a></p><p>again <a href="/p/2024/s' || (page_id + 1) || '/">next</a>' || ' <a class="decree-link" href="https://translation.example/t' || page_id || '">T</a> <a href="https://data.corpus.example/ar/md/x/2024-0' || page_id || '.pdf">pdf</a></p>' || html"""


def _posts(spark, sf_dir):
    """Posts made of pages: two links to the next, one to itself, a translation and a PDF before the page's own HTML."""
    return tables.table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.concat(F.when(F.col("page_id") % 10 == 9, "og").otherwise("s"), F.col("page_id").cast("string")).alias("slug"), F.concat(F.lit("https://corpus.example/p/2024/s"), F.col("page_id").cast("string")).alias("link"), F.lit("2024-01-01").alias("date"), F.concat(F.lit("<b>Page &amp; "), F.col("page_id").cast("string"), F.lit("</b>")).alias("title"), F.expr(_POST).alias("content"), F.array(F.lit(1)).alias("categories"))


@_query("""SELECT slug AS source_slug, 's' || (page_id + 1) AS target_slug, rel_type, 'https://corpus.example/p/2024/s' || (page_id + 1) || '/' AS target_url, 'next' AS anchor_text FROM (SELECT page_id, CASE WHEN page_id % 10 = 9 THEN 'og' ELSE 's' END || page_id AS slug FROM pages), (VALUES ('REFERENCES'), ('REPEALS')) r(rel_type)
    WHERE rel_type = 'REFERENCES' OR page_id % 3 = 0 UNION ALL SELECT 'og' || page_id, 's' || page_id, CASE WHEN page_id % 3 = 0 THEN 'REPEALS' ELSE 'REFERENCES' END, 'https://corpus.example/p/2023/s' || page_id || '/', 'self' FROM pages WHERE page_id % 10 = 9""")
def cross_references(spark, sf_dir):
    return html.cross_references(_posts(spark, sf_dir), "content", "slug").select("source_slug", "target_slug", "rel_type", "target_url", "anchor_text")


@_query("SELECT 's' || (page_id + d) AS slug, max(CASE d WHEN 1 THEN 'https://corpus.example/p/2024/s' || (page_id + 1) || '/' ELSE 'https://corpus.example/p/2023/s' || page_id || '/' END) AS source_url FROM pages, (VALUES (0), (1)) v(d) WHERE page_id % 10 = 9 GROUP BY 1")
def gazette_split(spark, sf_dir):
    return crawl.gazette_discoveries(_posts(spark, sf_dir))


@_query("""SELECT 's' || page_id AS id, 'https://corpus.example/p/2024/s' || page_id AS source_url, 'Page & ' || page_id AS title_ar, 'ministerial_decision' AS document_type, 'x' AS issuer_code, 'https://translation.example/t' || page_id AS english_url,
    'https://data.corpus.example/ar/md/x/2024-0' || page_id || '.pdf' AS pdf_url_ar, page_id::VARCHAR AS serial, CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END AS n_references, CASE WHEN page_id % 4 = 0 THEN 'English ' || page_id END AS title_en, CASE WHEN page_id % 4 = 1 THEN '7/2024' END AS number FROM pages WHERE page_id % 10 <> 9""")
def documents_from_posts(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages")
    n = F.col("page_id").cast("string")
    details = pages.where("page_id % 4 = 1").select(F.concat(F.lit("https://corpus.example/p/2024/s"), n).alias("url"), F.lit('<h1 class="entry-title">x</h1><div class="intro-text section-inner"><p>2024/7 7/2024</p></div>').alias("html"))
    english = pages.where("page_id % 4 = 0").select(F.concat(F.lit("https://translation.example/t"), n).alias("url"), F.concat(F.lit("<h1>English "), n, F.lit("</h1><article><p>body</p></article>")).alias("html"))
    docs = crawl.build_documents(_posts(spark, sf_dir), details, english)
    return docs.select("id", "source_url", "title_ar", "document_type", "issuer_code", "english_url", "pdf_url_ar", F.col("raw.pdf_metadata.serial").alias("serial"), F.size("cross_references").alias("n_references"), "title_en", "number")


@_query("SELECT DISTINCT ON (lang) lang AS slug, doc_id AS seq, source FROM documents ORDER BY lang, doc_id")
def first_seen(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "documents").select(F.col("lang").alias("slug"), F.col("doc_id").alias("seq"), "source")
    return crawl.first_seen(rows)


_GRAPH = f"""cg AS (SELECT DISTINCT least(x, y) AS a, greatest(x, y) AS b FROM (SELECT 'doc:' || id AS x, 'doc:' || r.target_slug AS y FROM (SELECT id, unnest(cross_references) AS r FROM {tables.DOCUMENTS})
    UNION ALL SELECT 'doc:' || document_id, 'topic:' || canonical_name FROM {tables.TOPICS}) WHERE x <> y)"""


@_query(f"WITH {_GRAPH} SELECT a, b FROM cg")
def community_edges(spark, sf_dir):
    return graph.community_graph(tables.documents(spark, sf_dir), tables.topics(spark, sf_dir))


@_query()
def communities(spark, sf_dir):
    docs = tables.documents(spark, sf_dir)
    found = community.communities(graph.community_graph(docs, tables.topics(spark, sf_dir)))
    return community.assignments(found, community.describe(found, docs))


def _by_source(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select(F.concat(F.lit("doc:d"), F.col("doc_id").cast("string")).alias("node"), F.xxhash64("source").alias("k"), "source")
    tops = tables.topics(spark, sf_dir).join(tables.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("document_id"), "source"), "document_id")
    return docs.select("node", F.substring("source", 4, 9).cast("long").alias("community_id")).union(tops.where("canonical_name <> ''").select(F.concat(F.lit("topic:"), "canonical_name").alias("node"), F.substring("source", 4, 9).cast("long").alias("community_id")).distinct())


@_query(f"""WITH members AS (SELECT 'doc:d' || doc_id AS node, substr(source, 4)::BIGINT AS c, NULL AS label, coalesce({_TITLE}, id) AS title FROM documents JOIN {tables.DOCUMENTS} d ON id = 'd' || doc_id
      UNION ALL SELECT DISTINCT 'topic:' || canonical_name, substr(source, 4)::BIGINT, canonical_name, NULL FROM {tables.TOPICS} t JOIN documents ON 'd' || doc_id = document_id WHERE canonical_name <> ''),
    g AS (SELECT c, coalesce(list(label ORDER BY label) FILTER (label IS NOT NULL), []) AS labels, coalesce(list(title ORDER BY title) FILTER (title IS NOT NULL), []) AS titles FROM members GROUP BY c)
    SELECT c AS community_id, labels[1:15] AS topic_labels, titles[1:8] AS representative_documents, CASE WHEN len(labels) > 0 THEN 'Community around ' || array_to_string(labels[1:5], ', ') || '.' ELSE 'Community around documents: ' || array_to_string(titles[1:3], '; ') || '.' END AS summary FROM g""")
def community_descriptions(spark, sf_dir):
    return community.describe(_by_source(spark, sf_dir), tables.documents(spark, sf_dir))


@_query("SELECT doc_id, lang, round(n_chars / 7.0::DOUBLE, 6) AS x, source FROM documents")
def jsonl_round_trip(spark, sf_dir):
    """Rows through JSON Lines and back by an explicit schema."""
    import uuid

    from quillspark.sinks.tables import write_jsonl
    from quillspark.sources.jsonl import read_jsonl

    rows = tables.table(spark, sf_dir, "documents").select("doc_id", "lang", F.round(F.col("n_chars") / F.lit(7.0), 6).alias("x"), "source")
    path = _shared(spark) + f"/jsonl-{uuid.uuid4().hex}"
    write_jsonl(rows, path)
    return read_jsonl(spark, path, rows.schema)
