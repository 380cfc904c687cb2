"""Sitemaps: an index of sitemaps, and the addresses in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSTS = "wp-sitemap-posts-post"


def locations(xml: Column | str) -> Column:
    """All addresses of a sitemap or of an index, in order; null and empty sources have none. Namespaces don't matter."""
    c = F.coalesce(F.col(xml) if isinstance(xml, str) else xml, F.lit(""))
    found = F.regexp_extract_all(c, F.lit(r"<loc>\s*(?:<!\[CDATA\[)?([^<\]]+?)(?:\]\]>)?\s*</loc>"), F.lit(1))
    return F.transform(found, lambda u: F.replace(F.replace(u, F.lit("&amp;"), F.lit("&")), F.lit("&#038;"), F.lit("&")))


def sitemap_urls(index: DataFrame, maps: DataFrame, limit: int | None = None) -> DataFrame:
    """(url, map, pos) of the sitemaps that an index names and whose address says that they hold posts. Both tables are (url, xml)."""
    named = index.select(F.posexplode(locations("xml")).alias("n", "map")).where(F.contains("map", F.lit(POSTS)))
    rows = named.join(maps.select(F.col("url").alias("map"), "xml"), "map").select("n", "map", F.posexplode(locations("xml")).alias("pos", "url"))
    return rows.select("url", "map", "pos") if limit is None else rows.orderBy("n", "pos").limit(limit).select("url", "map", "pos")
