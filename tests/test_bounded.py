"""Plans whose rows, memory and traffic stay bounded, whatever the tables' size."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import vectors
from quillspark.operators import chunking, community, evaluation, search, topics


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def corpus(spark):
    words = "law tax court school bank river stone cloud".split()
    texts = [" ".join(words[(i * k) % 8] for k in range(1, 2 + i % 9)) for i in range(60)] + ["", None, "law law law law tax", "no such word"]
    chunks = spark.createDataFrame([(i, f"d{i % 13}", t) for i, t in enumerate(texts)], "chunk_id long, document_id string, text string")
    queries = spark.createDataFrame([(1, "tax law"), (2, "river cloud stone stone"), (3, "zzz"), (4, "court")], "query_id long, query string")
    return chunks, queries


@pytest.mark.parametrize("name", ["search_bm25", "search_dense", "search_hybrid", "vector_hits"])
@pytest.mark.parametrize("k", [3, 100])
def test_scan_equals_joins_and_makes_no_pairs(spark, corpus, monkeypatch, name, k):
    index = search.build_index(corpus[0])
    scanned = getattr(search, name)(index, corpus[1], k)
    # no query meets a chunk as a row of the plan, and nothing but the tasks' best is shuffled
    assert not any(x in plan(scanned) for x in ("Join", "CartesianProduct")) and "MapInArrow" in plan(scanned)
    monkeypatch.setattr(search, "QUERIES", 2)
    joined = getattr(search, name)(index, corpus[1], k)
    assert "Join" in plan(joined) or "CartesianProduct" in plan(joined)
    rows = lambda df: sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    assert rows(scanned) == rows(joined) and rows(scanned)


def test_scan_in_small_steps(spark, corpus, monkeypatch):
    from quillspark.operators import scan

    index = search.build_index(corpus[0])
    rows = lambda: sorted(map(tuple, search.search_hybrid(index, corpus[1], 4).collect()))
    whole = rows()
    best = scan.Best(2, 2)
    best.most = 1
    import numpy as np
    import pyarrow as pa

    for at in range(6):
        best.add([pa.array([10 - at])], np.array([[1.0, float(at)]]))
    kept = [tuple(x.values()) for b in best.result(pa.array([7, 8]), ["q", "s", "c"]) for x in b.to_pylist()]
    assert kept == [(7, 1.0, 5), (7, 1.0, 6), (8, 5.0, 5), (8, 4.0, 6)]
    assert list(scan.steps(5, 300_000)) == [(0, 3), (3, 5)] and list(scan.steps(3, 1, np.array([0, 5_000_000, 5_000_001, 5_000_002]))) == [(0, 1), (1, 3)]
    assert whole == rows()


def test_document_hits_at_equal_scores(spark, monkeypatch):
    """Documents of one score: their chunks stand in order of chunk, not of document, and the limit is before their join."""
    docs = spark.createDataFrame([(i, "x", "tax law") for i in range(30)], "chunk_id long, document_id string, text string")
    # document 29 has the first chunks; 5 has none
    chunks = spark.createDataFrame([(1000 - 10 * d + n, d, f"other {n}") for d in range(30) if d != 5 for n in range(2)], "chunk_id long, document_id long, text string")
    queries = spark.createDataFrame([(1, "tax law"), (2, "other")], "query_id long, query string")
    parts = search.build_index(chunks), search.build_index(docs)
    rows = lambda: sorted(map(tuple, search.fulltext_hits(*parts, queries, 7).collect()))
    got = rows()
    assert search._document_hits(*parts, queries, 7).count() == 7
    monkeypatch.setattr(search, "QUERIES", 1)
    assert got == rows() and [c for q, c, _ in got if q == 1] == sorted(r.chunk_id for r in chunks.collect())[:7]


def test_context_meets_only_found_documents(spark, corpus):
    docs = spark.createDataFrame([(f"d{i}", f"T{i}", None, "u", None, "law", "1", []) for i in range(13)], "id string, title_en string, title_ar string, source_url string, date string, document_type string, number string, cross_references array<struct<rel_type:string,anchor_text:string>>")
    named = spark.createDataFrame([(f"d{i}", 0, "Tax", "Tax") for i in range(13)], "document_id string, seq int, name string, canonical_name string")
    hits = search.search_bm25(search.build_index(corpus[0]), corpus[1], 2)
    rows = search.expand(hits, corpus[0], docs, named)
    # found rows are broadcast, so texts and topics aren't shuffled for them
    assert "LeftSemi, BuildRight" in plan(rows) and rows.count() == hits.count()


def test_index_rows_shuffle_nothing(spark, corpus):
    assert "Exchange" not in plan(search.build_index(corpus[0]).rows)


def test_nonzeros_shuffle_nothing(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, "")], "id long, text string")
    got = vectors.hash_nonzeros(df, "id", "text")
    assert "Exchange" not in plan(got)
    each = df.select("id", F.explode(vectors.hash_slots("text")).alias("s")).groupBy("id", "s.place").agg(F.sum("s.sign").alias("value")).where("value <> 0")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, each.collect()))


def test_holders_equal_contains(spark):
    docs = spark.createDataFrame([(1, "a bb ccc dd e"), (2, "xa bb ccc dd"), (3, None), (4, "bb ccc"), (5, "a bb\tccc dd"), (6, "")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a bb ccc dd"), (2, "bb ccc"), (3, "c"), (4, None), (5, ""), (6, " bb ccc dd ")], "item long, p string")
    got = evaluation.holders(docs, "doc_id", "text", asked, "item", "p")
    want = docs.join(asked, F.contains("text", "p")).select("item", "doc_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and "NestedLoop" not in plan(got)


def test_windows_find_words_once(spark):
    df = spark.createDataFrame([(1, "one two three four five six seven"), (2, ""), (3, "one")], "id long, text string")
    cut = chunking.token_windows(df, "id", "text", 3, 1)
    assert plan(cut).count("regexp_extract_all") <= 2  # one in the plan's tree, one in its details
    assert [tuple(r) for r in cut.orderBy("id", "order").collect()] == [(1, 0, "one two three"), (1, 1, "three four five"), (1, 2, "five six seven"), (3, 0, "one")]


def test_topics_read_a_text_once(spark):
    docs = spark.createDataFrame([("a", None, "Tax court", None, "x", "law"), ("b", None, None, None, "y", "royal_decree"), ("c", None, None, None, "y", None)], "id string, title_ar string, title_en string, content_ar string, content_en string, document_type string")
    ruled = topics.rule_topics(docs)
    assert plan(ruled).count("Scan") == 1 and "Union" not in plan(ruled)
    assert sorted((r.document_id, r.seq, r.name) for r in ruled.collect()) == [("a", 0, "Taxation"), ("a", 1, "Judiciary"), ("b", 0, "Royal Decree")]


def test_pages_come_in_bounded_batches(spark):
    from quillspark.plans import tables

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    tables.table(spark, "/root/testdata/sf0.001", "pages")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000


def test_sweeps_send_nothing_through_the_driver(spark, monkeypatch):
    """Two squares with an edge between: swept by all, no table of any sweep is broadcast, and modularity is as by hand."""
    squares = [(f"{s}{i}", f"{s}{j}") for s in "ab" for i in range(4) for j in range(i)] + [("a0", "b0")]
    edges = spark.createDataFrame([tuple(sorted(e)) for e in squares], "a string, b string")
    plans, keep = [], community._stored
    monkeypatch.setattr(community, "SMALL", 0)
    monkeypatch.setattr(community, "_stored", lambda df: plans.append(plan(df)) or keep(df))
    found = community.communities(edges)
    assert len(plans) > 5 and not any("BroadcastExchange" in p for p in plans)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.community_id, set()).add(r.node)
    assert {frozenset(g) for g in groups.values()} == {frozenset(f"{s}{i}" for i in range(4)) for s in "ab"}
    labels = found.select("node", F.col("community_id").alias("c"))
    assert abs(community.modularity(edges.withColumn("w", F.lit(1.0)), labels) - (12 / 13 - 2 * (13 / 26) ** 2)) < 1e-9
