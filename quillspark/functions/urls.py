"""URL functions as Column expressions. Parts are taken by pattern, so a malformed URL gives null and never fails a query."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillspark.config import Site

HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"
PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
SLUG = r"/(?:p/)?[0-9]{4}/([^/?#]+)/?"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def host(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), HOST, 1)


def path(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), PATH, 1)


def slug_of(url: Column | str) -> Column:
    """The name after a four-digit year in the path, or null."""
    return F.nullif(F.regexp_extract(path(url), SLUG, 1), F.lit(""))


def is_corpus_url(url: Column | str, site: Site = Site()) -> Column:
    return F.coalesce(host(url).isin(*site.corpus_hosts) & path(url).contains("/p/"), F.lit(False))


def is_gazette_slug(slug: Column | str) -> Column:
    return F.coalesce(_col(slug).rlike("^og[0-9]+$"), F.lit(False))


def pdf_metadata(url: Column | str) -> Column:
    """(family, year, issuer_code, serial) from where a PDF lies; paths of fewer than three parts tell nothing."""
    parts = F.split(F.regexp_replace(path(url), "^/+|/+$", ""), "/")
    ar = F.array_position(parts, F.lit("ar")).cast("int")
    get = lambda i: F.get(parts, i)
    name = F.element_at(parts, -1)
    family = F.when(ar > 0, get(ar)).when(get(F.lit(0)) == "og", F.lit("og"))
    issuer = F.when((ar > 0) & (get(ar) == "md"), get(ar + 1))
    dated = r"(20[0-9]{2})-([0-9]+)\.pdf$"
    year = F.nullif(F.regexp_extract(name, dated, 1), F.lit(""))
    number = F.regexp_replace(F.nullif(F.regexp_extract(name, dated, 2), F.lit("")), "^0+(?=[0-9])", "")
    serial = F.when(year.isNotNull(), number).when(get(F.lit(0)) == "og", F.regexp_replace(name, r"\.pdf$", ""))
    known = F.coalesce(F.size(parts) >= 3, F.lit(False))
    return F.struct(*(F.when(known, c).alias(n) for n, c in (("family", family), ("year", year), ("issuer_code", issuer), ("serial", serial))))


def document_type(slug: Column | str, pdf_url: Column | str, categories: Column | None = None) -> Column:
    """Type of a document by its slug, its PDF's family and the names of its categories."""
    s, family = _col(slug), pdf_metadata(pdf_url)["family"]
    law = s.startswith("laws")
    if categories is not None:
        law = law | F.exists(F.coalesce(categories, F.array().cast("array<string>")), lambda n: n.contains("قانون"))
    return F.when((family == "rd") | s.startswith("rd"), "royal_decree").when(family == "md", "ministerial_decision").when((family == "og") | is_gazette_slug(s), "official_gazette").when(law, "law").otherwise(family)


@F.pandas_udf(StringType())
def absolute_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """href against base, by the rules of RFC 3986; null where href is null or empty."""
    return pd.Series([urljoin(b, h) if isinstance(h, str) and h else None for b, h in zip(base, href, strict=True)], dtype=object)
