"""Explicit schemas of every table, as DDL: nothing is inferred, so an all-null column keeps its type."""

from __future__ import annotations

REFERENCE = "source_slug string, target_url string, rel_type string, anchor_text string, context string, target_slug string"
PDF_METADATA = "family string, year string, issuer_code string, serial string"
DOCUMENT = (
    "id string, slug string, source_url string, title_ar string, title_en string, date string, document_type string, number string, issuer_code string, "
    "pdf_url_ar string, pdf_url_en string, english_url string, content_ar string, content_en string, categories array<int>, "
    f"cross_references array<struct<{REFERENCE.replace(' string', ':string')}>>, "
    f"raw struct<wordpress_id:int,pdf_metadata:struct<{PDF_METADATA.replace(' string', ':string')}>>"
)
CHUNK = "id string, document_id string, language string, text string, `order` int, heading_path string, embedding array<double>"
TOPIC = "document_id string, name string, canonical_name string, confidence double, evidence string, embedding array<double>"
MERGE_PAIR = "canonical string, duplicate string, score double"
COMMUNITY = "node string, community_id long, topic_labels array<string>, community_summary string"
COMMUNITY_SUMMARY = "community_id long, topic_labels array<string>, representative_documents array<string>, summary string"
EMBEDDING_METADATA = "model string, backend string, dimension int"
EVAL_QUERY = "id string, query string, expected_document_ids array<string>, notes string"
EVAL_RESULT = (
    "stage string, query_id string, query string, expected_document_ids array<string>, retrieved_document_ids array<string>, precision_at_k double, recall_at_k double, "
    "reciprocal_rank double, hit_at_1 boolean, hit_at_3 boolean, top_score double, rerank_applied boolean, notes string"
)
CRAWL_STATE = "slug string, post_id long, source_url string, status string, retries int, is_gazette int, english_url string, error string, updated_at timestamp"
CRAWL_EVENT = "seq long, kind string, slug string, post_id long, source_url string, is_gazette int, english_url string, status string, error string, at timestamp"
CRAWL_META = "key string, value string, updated_at timestamp"
PAGE_LINK = "pos int, href string, text string, classes array<string>, context string"
POST = "id long, slug string, link string, date string, title string, content string, categories array<int>"
