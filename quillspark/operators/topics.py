"""Topics of documents: keyword rules, a model's own, names in one form, centroids and near-duplicate names."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillspark.functions.text import truthy
from quillspark.functions.vectors import cosine

# Names that topics are brought to, and the keywords that tell a topic, in order of rank.
TAXONOMY = (
    "Administrative Law", "Banking and Finance", "Civil Service", "Commerce and Companies", "Criminal Law", "Customs", "Education", "Employment and Labour",
    "Environment", "Healthcare", "Insurance", "International Treaties", "Investment", "Judiciary", "Maritime Law", "Municipal Affairs", "Oil and Gas",
    "Public Procurement", "Real Estate", "Sports", "Taxation", "Telecommunications", "Transport", "Urban Planning",
)
KEYWORDS = {
    "Taxation": ("ضريبة", "tax", "vat"),
    "Employment and Labour": ("عمل", "عامل", "labour", "labor", "worker", "omanization"),
    "Healthcare": ("صحي", "الصحة", "medical", "health"),
    "Education": ("تعليم", "جامعة", "school", "education", "university"),
    "Banking and Finance": ("بنك", "مصرف", "finance", "bank", "cbo"),
    "Urban Planning": ("التخطيط العمراني", "urban planning"),
    "Transport": ("نقل", "transport", "postal", "البريد"),
    "Judiciary": ("قضائي", "محكمة", "judicial", "court"),
    "International Treaties": ("اتفاقية", "treaty", "agreement"),
    "Commerce and Companies": ("تجارة", "شركة", "commercial", "company"),
    "Environment": ("بيئة", "environment"),
    "Sports": ("رياض", "sports"),
    "Public Procurement": ("مناقصة", "tender", "procurement"),
}
RULE_CONFIDENCE, TYPE_CONFIDENCE = 0.62, 0.45
RULE_TOPICS, MODEL_TOPICS = 6, 8


@F.pandas_udf(StringType())
def title_case(names: pd.Series) -> pd.Series:
    """Python's title(): a letter after any non-letter is upper-case."""
    return names.str.title()


def normalized_name(name: Column | str) -> Column:
    """Blanks collapsed, then the taxonomy's own spelling, or title case."""
    c = F.col(name) if isinstance(name, str) else name
    compact = F.regexp_replace(F.regexp_replace(c, r"^(?U)\s+|(?U)\s+$", ""), r"(?U)\s+", " ")
    known = F.create_map(*(F.lit(x) for t in TAXONOMY for x in (t.lower(), t)))
    return F.coalesce(F.try_element_at(known, F.lower(compact)), title_case(compact))


def keyword_topics(text: Column, rules: dict[str, tuple[str, ...]] | None = None, most: int = RULE_TOPICS) -> Column:
    """Names of the rules of which some keyword is in the text (as part of a word too), by rank, the first few."""
    hit = lambda low, words: F.greatest(*(F.contains(low, F.lit(w.lower())) for w in words), F.lit(False))
    named = lambda low: F.slice(F.array_compact(F.array(*(F.when(hit(low, words), F.lit(name)) for name, words in (rules or KEYWORDS).items()))), 1, most)
    # a lambda's argument is worked out once, not again for each word
    return F.get(F.transform(F.array(F.lower(F.coalesce(text, F.lit("")))), named), F.lit(0))


def rule_topics(documents: DataFrame) -> DataFrame:
    """(document_id, seq, name, canonical_name, confidence, evidence): keyword rules, or the document's type where none holds."""
    text = F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in ("title_ar", "title_en", "content_ar", "content_en")))
    rows = documents.select(F.col("id").alias("document_id"), truthy("document_type").alias("kind"), keyword_topics(text).alias("names"))
    # one pass: no filter that would have the names worked out again
    kind = F.when(F.size("names") == 0, F.replace(F.col("kind"), F.lit("_"), F.lit(" ")))
    rows = rows.select("document_id", "names", normalized_name(kind).alias("typed"))
    entry = lambda name, confidence, evidence: F.struct(name.alias("name"), F.lit(confidence).alias("confidence"), F.lit(evidence).alias("evidence"))
    ruled = F.transform("names", lambda n: entry(n, RULE_CONFIDENCE, "keyword fallback"))
    typed = F.filter(F.array(entry(F.col("typed"), TYPE_CONFIDENCE, "document type fallback")), lambda x: x["name"].isNotNull())
    each = rows.select("document_id", F.posexplode(F.concat(ruled, typed)).alias("seq", "t"))
    return each.select("document_id", "seq", "t.name", F.col("t.name").alias("canonical_name"), "t.confidence", "t.evidence")


def model_topics(replies: DataFrame) -> DataFrame:
    """(document_id, seq, ...) from a model's JSON replies (document_id, reply): named entries, in one form, the first few."""
    kind = "struct<topics:array<struct<name:string,canonical_name:string,confidence:double,evidence:string>>>"
    entries = F.filter(F.from_json("reply", kind)["topics"], lambda t: truthy(t["name"]).isNotNull())
    rows = replies.select("document_id", F.posexplode(F.slice(entries, 1, MODEL_TOPICS)).alias("seq", "t"))
    rows = rows.select("document_id", "seq", normalized_name(F.col("t.name")).alias("name"), F.col("t.canonical_name").alias("given"), "t.confidence", "t.evidence")
    return rows.select("document_id", "seq", "name", normalized_name(F.coalesce(truthy("given"), "name")).alias("canonical_name"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.left(F.coalesce("evidence", F.lit("")), F.lit(300)).alias("evidence"))


def extract_topics(documents: DataFrame, ask: Callable[[str, str], str | None] | None = None) -> DataFrame:
    """Topics of each document: the model's where it gives any, the rules' otherwise. ask(title, content) returns JSON or None."""
    ruled = rule_topics(documents)
    if ask is None:
        return ruled

    @F.pandas_udf("string")
    def reply(title: pd.Series, content: pd.Series) -> pd.Series:
        return pd.Series([ask(t, c) for t, c in zip(title, content, strict=True)], dtype=object)

    content = F.left(F.coalesce(truthy("content_en", "content_ar"), F.lit("")), F.lit(12000))
    asked = documents.select(F.col("id").alias("document_id"), reply(F.coalesce(truthy("title_en", "title_ar"), F.lit("")), content).alias("reply"))
    own = model_topics(asked)
    return own.unionByName(ruled.join(own.select("document_id").distinct(), "document_id", "left_anti"))


def centroids(topics: DataFrame, name: str = "canonical_name", embedding: str = "embedding") -> DataFrame:
    """(name, centroid): element-wise means. Values are summed by (name, place), so a popular name is never one task's."""
    each = topics.where(truthy(F.col(name).cast("string")).isNotNull() & F.col(embedding).isNotNull()).select(F.col(name).alias("name"), F.posexplode(embedding).alias("place", "x"))
    means = each.groupBy("name", "place").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("name").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda v: v.x).alias("centroid"))


def duplicate_pairs(means: DataFrame, threshold: float = 0.88) -> DataFrame:
    """(canonical, duplicate, score) of names whose centroids are this near: the shorter name, then the first, is canonical.

    Names are compared a block against a block, each pair of blocks in one task: exact, with one
    copy of the table for each block row.
    """
    blocks = max(1, -(-means.count() // 1000))
    dealt = means.withColumn("block", F.pmod(F.xxhash64("name"), F.lit(blocks)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    left = dealt.select(F.col("name").alias("l"), F.col("centroid").alias("lc"), F.col("block").alias("lb"), F.explode(every).alias("rb"))
    right = dealt.select(F.col("name").alias("r"), F.col("centroid").alias("rc"), F.col("block").alias("rb"), F.explode(every).alias("lb"))
    pairs = left.join(right, ["lb", "rb"]).where("l < r").withColumn("score", F.round(cosine("lc", "rc"), 9)).where(F.col("score") >= threshold)
    text = lambda c: F.col(c).cast("string")
    keep_left = F.length(text("l")) <= F.length(text("r"))
    return pairs.select(F.when(keep_left, F.col("l")).otherwise(F.col("r")).alias("canonical"), F.when(keep_left, F.col("r")).otherwise(F.col("l")).alias("duplicate"), "score")


def apply_merges(topics: DataFrame, pairs: DataFrame, name: str = "canonical_name") -> DataFrame:
    """topics with duplicates renamed, one hop; of several canonical names that of the lowest score, the last of the list, holds."""
    mapping = pairs.groupBy("duplicate").agg(F.max_by("canonical", F.struct(-F.col("score"), F.when(F.col("canonical") < F.col("duplicate"), F.col("canonical")).otherwise(F.col("duplicate")), "canonical")).alias("_to"))
    rows = topics.join(mapping, topics[name] == mapping.duplicate, "left")
    return rows.select(*(F.coalesce("_to", name).alias(name) if c == name else F.col(c) for c in topics.columns))
