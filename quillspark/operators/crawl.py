"""From crawled posts to documents, and the crawl's bookkeeping, as plans over tables of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.config import Site
from quillspark.functions import html, urls
from quillspark.functions.text import truthy

SHORT = 80  # characters of content below which a PDF's text is taken


def first_seen(posts: DataFrame, key: str = "slug", seq: str = "seq") -> DataFrame:
    """The first row of each key, by seq."""
    rest = [c for c in posts.columns if c != key]
    return posts.groupBy(key).agg(F.min_by(F.struct(*rest), seq).alias("_r")).select(key, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*posts.columns)


def merge_queues(pending: DataFrame, discovered: DataFrame, limit: int | None = None) -> DataFrame:
    """Pending posts, then discovered ones, each slug once where it is first, so many at most."""
    both = pending.withColumn("_q", F.lit(0)).unionByName(discovered.withColumn("_q", F.lit(1))).withColumn("seq", F.struct("_q", "seq")).drop("_q")
    rows = first_seen(both)
    return rows if limit is None else rows.orderBy("seq").limit(limit)


def gazette_discoveries(posts: DataFrame, site: Site = Site()) -> DataFrame:
    """(slug, source_url): documents that gazette posts link to. The gazettes themselves become no documents."""
    links = html.corpus_links(posts.where(urls.is_gazette_slug("slug")), "content", "slug", site)
    rows = links.select(urls.slug_of("url").alias("found"), "url", "slug", "pos").where("found IS NOT NULL")
    return rows.groupBy(F.col("found").alias("slug")).agg(F.max_by("url", F.struct("slug", "pos")).alias("source_url"))


def build_documents(posts: DataFrame, details: DataFrame, translations: DataFrame, site: Site = Site(), pdf_texts: DataFrame | None = None) -> DataFrame:
    """Documents (schemas.DOCUMENT) of posts (schemas.POST) that are no gazettes.

    details (url, html) are the posts' own pages, translations (url, html) the pages that they name as
    their English version; a missing page leaves its fields null. pdf_texts (url, text) stand in for
    contents of fewer than SHORT characters.
    """
    rows = posts.where(~urls.is_gazette_slug("slug")).withColumn("_links", html.page_links("content"))
    absolute = posts.where(~urls.is_gazette_slug("slug"))
    links = html.absolute_links(absolute, "content", ("slug",), site)
    gathered = links.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("url").alias("href"), "text", "classes"))).alias("_absolute"))
    rows = rows.join(gathered, "slug", "left").withColumn("english_url", html.english_link(F.col("_absolute"), site)).withColumn("pdf_url_ar", F.get(html.pdf_urls(F.col("_links"), "content", site), F.lit(0)))
    rows = rows.join(details.select(F.col("url").alias("link"), html.detail_number("html").alias("number")), "link", "left")
    english = translations.select(F.col("url").alias("english_url"), html.page_title("html").alias("title_en"), html.article_html("html").alias("_article"))
    english = english.withColumn("content_en", html.html_to_markdown("_article")).withColumn("pdf_url_en", F.get(html.pdf_urls(html.page_links("_article"), "_article", site), F.lit(0))).drop("_article")
    rows = rows.join(english, "english_url", "left").withColumn("content_ar", html.html_to_markdown("content"))
    if pdf_texts is not None:
        rows = rows.join(pdf_texts.select(F.col("url").alias("pdf_url_ar"), F.col("text").alias("_pdf")), "pdf_url_ar", "left")
        rows = rows.withColumn("content_ar", F.when(F.length(F.trim("content_ar")) < SHORT, F.coalesce(truthy("_pdf"), "content_ar")).otherwise(F.col("content_ar")))
    refs = html.cross_references(absolute, "content", "slug", site)
    refs = refs.groupBy(F.col("source_slug").alias("slug")).agg(F.array_sort(F.collect_list(F.struct("pos", F.struct("source_slug", "target_url", "rel_type", "anchor_text", "context", "target_slug").alias("r")))).alias("rs")).select("slug", F.transform("rs", lambda x: x.r).alias("cross_references"))
    rows = rows.join(refs, "slug", "left")
    meta = urls.pdf_metadata("pdf_url_ar")
    none = F.array().cast("array<struct<source_slug:string,target_url:string,rel_type:string,anchor_text:string,context:string,target_slug:string>>")
    return rows.select(
        F.col("slug").alias("id"), "slug", F.coalesce("link", F.lit("")).alias("source_url"), html.strip_html_text("title").alias("title_ar"), "title_en", "date",
        urls.document_type("slug", "pdf_url_ar").alias("document_type"), "number", meta["issuer_code"].alias("issuer_code"), "pdf_url_ar", "pdf_url_en", "english_url", "content_ar", "content_en",
        F.coalesce("categories", F.array().cast("array<int>")).alias("categories"), F.coalesce("cross_references", none).alias("cross_references"),
        F.struct(F.col("id").cast("int").alias("wordpress_id"), meta.alias("pdf_metadata")).alias("raw"),
    )
