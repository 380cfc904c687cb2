"""Text functions as Column expressions: all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are no search terms, and phrases that tell how a text refers to another.
STOPWORDS = ("a", "an", "and", "are", "as", "by", "for", "from", "give", "gives", "in", "is", "of", "on", "or", "the", "to", "what", "which", "who", "whose", "with")
REPEAL_WORDS = ("يلغى", "تلغى", "إلغاء", "بالإلغاء")
AMEND_WORDS = ("يعدل", "تعدل", "يستبدل", "تستبدل", "يضاف", "تضاف")
RELATIONS = ("REFERENCES", "REPEALS", "AMENDS")

TOKEN = r"[\p{L}\p{N}_]+|[\x{0600}-\x{06FF}]+"
NOT_SPACE = r"(?U)\S+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """Lower-cased words; null gives none."""
    return F.transform(F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(TOKEN), F.lit(0)), F.lower)


def search_terms(text: Column | str) -> Column:
    """Words of more than two letters that are no stopwords, or all words where none is left."""
    every = tokens(text)
    strong = F.filter(every, lambda w: (F.length(w) > 2) & ~w.isin(*STOPWORDS))
    return F.when(F.size(strong) > 0, strong).otherwise(every)


def any_of_query(text: Column | str) -> Column:
    """Search terms joined by OR; a text without words stays as it is."""
    terms = search_terms(text)
    return F.when(F.size(terms) > 0, F.array_join(terms, " OR ")).otherwise(_col(text))


def words(text: Column | str) -> Column:
    """Runs without white space of any script."""
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(NOT_SPACE), F.lit(0))


def approx_tokens(text: Column | str) -> Column:
    return F.size(words(text))


def truthy(*columns: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(_col(c), F.lit("")) for c in columns))


def snippet(text: Column | str, size: int = 350) -> Column:
    """White space collapsed, ends trimmed, cut."""
    return F.left(F.trim(F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"(?U)\s+", " ")), F.lit(size))


def cut(text: Column | str, size: int = 1800) -> Column:
    return F.left(_col(text), F.lit(size))


def relation_of(context: Column | str) -> Column:
    """REPEALS before AMENDS before REFERENCES, by the words in the context."""
    has = lambda ws: F.coalesce(_col(context).rlike("|".join(ws)), F.lit(False))
    return F.when(has(REPEAL_WORDS), "REPEALS").when(has(AMEND_WORDS), "AMENDS").otherwise("REFERENCES")


def node_id(kind: str, key: Column | str) -> Column:
    return F.concat(F.lit(f"{kind}:"), _col(key).cast("string"))


def node_key(kind: str, node: Column | str) -> Column:
    """What stands after the prefix, or null for another kind of node."""
    return F.when(_col(node).startswith(f"{kind}:"), F.substring(_col(node), len(kind) + 2, 1 << 30))


def line_rstrip_compact(markdown: Column | str) -> Column:
    """Lines without blanks at their ends, runs of empty lines as one, and one line's end at the text's end."""
    c = F.regexp_replace(_col(markdown), r"(?U)[^\S\n]+(?=\n|$)", "")
    return F.concat(F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"^(?U)\s+|(?U)\s+$", ""), F.lit("\n"))
