"""Heading-aware chunks of Markdown with overlapping windows, as relational plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.text import approx_tokens, words

HEADING = r"^(#{1,6})\s+(.+)$"


def _check(max_tokens: int, overlap: int) -> None:
    if not 0 <= overlap < max_tokens:
        raise ValueError("overlap must be 0 or more, and less than max_tokens")


def window_texts(text: Column | str, max_tokens: int, overlap: int) -> Column:
    """The whole trimmed text where it has max_tokens words or fewer; else windows of so many, which share overlap words."""
    _check(max_tokens, overlap)
    c = F.col(text) if isinstance(text, str) else text
    stride = max_tokens - overlap

    def windows(each: Column) -> Column:
        last = F.ceil((F.size(each) - max_tokens) / F.lit(stride)).cast("int")
        cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(each, i * stride + 1, F.lit(max_tokens)), " "))
        whole = F.regexp_replace(c, r"^(?U)\s+|(?U)\s+$", "")
        none = F.array().cast("array<string>")
        return F.when(F.size(each) == 0, none).when(F.size(each) <= max_tokens, F.array(whole)).otherwise(cut)

    # a lambda's argument is worked out once, not again for each window
    return F.get(F.transform(F.array(words(c)), windows), F.lit(0))


def sections(docs: DataFrame, keys: tuple[str, ...], text: str) -> DataFrame:
    """(keys..., sid, heading, body, n_tokens): a heading begins a section and is its first line; blank sections are dropped.

    Lines of a document are numbered within it, so only one document's lines are ever together.
    """
    lines = docs.select(*keys, F.posexplode(F.split(F.coalesce(text, F.lit("")), r"\R", -1)).alias("pos", "line"))
    stripped = F.regexp_replace("line", r"^(?U)\s+|(?U)\s+$", "")
    head = F.regexp_extract(stripped, HEADING, 2)
    lines = lines.withColumn("head", F.when(stripped.rlike(HEADING), F.trim(head)))
    sid = F.sum(F.col("head").isNotNull().cast("int")).over(W.partitionBy(*keys).orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    out = lines.withColumn("sid", sid).groupBy(*keys, "sid").agg(F.max("head").alias("heading"), F.array_join(F.transform(ordered, lambda x: x.line), "\n").alias("body"))
    out = out.withColumn("body", F.regexp_replace("body", r"^(?U)\s+|(?U)\s+$", ""))
    return out.where("body <> ''").withColumn("n_tokens", approx_tokens("body"))


def chunk(docs: DataFrame, keys: tuple[str, ...] = ("document_id", "language"), text: str = "content", max_tokens: int = 800, overlap: int = 100) -> DataFrame:
    """(id, keys..., text, order, heading_path): sections are packed up to max_tokens words, in order; longer ones are cut into windows.

    The groups come from one fold over a document's section sizes; a chunk's heading is that of its
    last section, or the nearest heading before it.
    """
    _check(max_tokens, overlap)
    each = sections(docs, keys, text)
    facts = F.array_sort(F.collect_list(F.struct("sid", "heading", "body", "n_tokens")))
    state = F.struct(F.lit(0).alias("cur"), F.lit(0).alias("held"), F.lit(None).cast("string").alias("heading"), F.array().cast("array<struct<gid:int,long:boolean,heading:string,body:string>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        long = s.n_tokens > max_tokens
        over = (acc.held > 0) & (acc.held + s.n_tokens > max_tokens)
        gid = F.when(long | over, acc.cur + 1).otherwise(acc.cur)
        cur = F.when(long, acc.cur + 2).otherwise(gid)
        held = F.when(long, 0).when(over, s.n_tokens).otherwise(acc.held + s.n_tokens)
        heading = F.coalesce(s.heading, acc.heading)
        one = F.struct(gid.alias("gid"), long.alias("long"), heading.alias("heading"), s.body.alias("body"))
        return F.struct(cur.alias("cur"), held.alias("held"), heading.alias("heading"), F.concat(acc.out, F.array(one)).alias("out"))

    packed = each.groupBy(*keys).agg(F.aggregate(facts, state, step, lambda acc: acc.out).alias("parts"))
    rows = packed.select(*keys, F.posexplode("parts").alias("n", "p")).select(*keys, "n", "p.*")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "body"))), lambda x: x.body), "\n\n")
    groups = rows.groupBy(*keys, "gid").agg(F.max("long").alias("long"), F.max_by("heading", "n").alias("heading_path"), joined.alias("body"))
    cut = groups.select(*keys, "gid", "heading_path", F.posexplode(F.when(F.col("long"), window_texts("body", max_tokens, overlap)).otherwise(F.array("body"))).alias("part", "text"))
    cut = cut.withColumn("order", F.row_number().over(W.partitionBy(*keys).orderBy("gid", "part")) - 1)
    name = F.concat_ws(":", *(F.col(k).cast("string") for k in keys), F.format_string("%04d", "order"))
    return cut.select(name.alias("id"), *keys, "text", "order", "heading_path")


def chunk_documents(documents: DataFrame, max_tokens: int = 800, overlap: int = 100) -> DataFrame:
    """Chunks of both languages of a document table; empty contents give none."""
    both = documents.select(F.col("id").alias("document_id"), F.expr("stack(2, 'ar', content_ar, 'en', content_en) AS (language, content)"))
    return chunk(both.where("content IS NOT NULL AND content <> ''"), max_tokens=max_tokens, overlap=overlap)


def token_windows(docs: DataFrame, key: str, text: str, max_tokens: int, overlap: int) -> DataFrame:
    """(key, order, text): each text's windows."""
    return docs.select(key, F.posexplode(window_texts(F.coalesce(text, F.lit("")), max_tokens, overlap)).alias("order", "text"))
