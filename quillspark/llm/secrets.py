"""Secret scans by a trigram inverted index: Boolean trigram queries from each rule's pattern, postings, and verification.

All of it is DataFrame expressions; the driver only parses the rules' patterns.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import stored, table

BLOCK_BITS = 12  # document ids of a block of the index: 2 to this power
BROADCAST_ROWS = 500_000  # candidates up to which they are broadcast; more are joined by a shuffle
ALTERNATIVES = 64  # strings that the analysis follows at once


@dataclass(frozen=True)
class Rule:
    """A pattern that Python, Java and RE2 read alike; a match counts if its group is of so many characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The patterns to find. Letters in either case are spelt out where they may be.
_KEYWORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE = (
    Rule("assign", rf"({_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # as [0-9a-f]+ of 24 or more: runs are matched whole
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
)
RULES = BASE + ADDED

#: A Boolean query in disjunctive form: some of the sets must have all its trigrams. {frozenset()} holds always.
Query = frozenset
ALWAYS: Query = frozenset([frozenset()])


def _least(q: Query) -> Query:
    """Without the sets that hold another set."""
    return frozenset(a for a in q if not any(b < a for b in q))


def _both(a: Query, b: Query) -> Query:
    out = _least(frozenset(x | y for x, y in product(a, b)))
    return out if len(out) <= ALTERNATIVES else min(a, b, key=len)


def _of_strings(strings: set[str]) -> Query:
    return _least(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _analyse(parsed) -> tuple[set[str] | None, Query]:
    """The strings that a pattern can match, where they are few, and a query that its matches fulfil otherwise."""
    exact: set[str] = {""}
    query: Query = ALWAYS
    whole = True
    for op, arg in parsed:
        part: set[str] | None = None
        needs: Query = ALWAYS
        if op is rc.LITERAL:
            part = {chr(arg).lower()}
        elif op is rc.IN and all(o in (rc.LITERAL, rc.RANGE) for o, _ in arg):
            some = {chr(c).lower() for o, v in arg for c in ([v] if o is rc.LITERAL else range(v[0], v[1] + 1))}
            part = some if len(some) <= 8 else None
        elif op is rc.SUBPATTERN:
            part, needs = _analyse(arg[3])
        elif op is rc.BRANCH:
            each = [_analyse(x) for x in arg[1]]
            part = set().union(*(e for e, _ in each)) if all(e is not None for e, _ in each) else None
            needs = _least(frozenset().union(*(q for _, q in each)))
        elif op is rc.MAX_REPEAT:
            low, high, body = arg
            inner, inner_needs = _analyse(body)
            if high == 1 and inner is not None:
                part = inner | {""} if low == 0 else inner
            elif low == high and inner is not None and len(inner) == 1 and low <= 16:
                part = {next(iter(inner)) * low}
            elif low:
                needs = inner_needs
        if part is not None and len(exact) * len(part) <= ALTERNATIVES:
            exact = {a + b for a, b in product(exact, part)}
            continue
        whole = False
        query = _both(_both(query, _of_strings(exact)), needs)
        if part is not None:
            exact = part
        else:
            exact = {""}
    if whole:
        return exact, _of_strings(exact)
    return None, _both(query, _of_strings(exact))


def trigram_query(pattern: str) -> Query:
    """The query over lower-cased text that every text with a match of the pattern fulfils."""
    return _analyse(rp.parse(pattern))[1]


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (block, trigram, ids) of these trigrams in the lower-cased texts of (doc_id, text).

    A block is a range of 2**BLOCK_BITS ids, so a posting is bounded however common its trigram.
    """
    lowered = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in trigrams)))
    rows = lowered.select("doc_id", F.explode(present).alias("trigram"))
    return rows.groupBy(F.shiftright("doc_id", BLOCK_BITS).alias("block"), "trigram").agg(F.sort_array(F.collect_set("doc_id")).alias("ids"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """doc_id and rules: the ids whose postings fulfil each query, and the names of those queries."""
    blocks = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("of"))
    none = F.array().cast("array<bigint>")

    def ids(query: Query) -> Column:
        out = None
        for group in sorted(map(sorted, query)):
            both = None
            for g in group:
                posting = F.coalesce(F.try_element_at("of", F.lit(g)), none)
                both = posting if both is None else F.array_intersect(both, posting)
            out = both if out is None else F.array_union(out, both)
        return out

    each = F.array(*(F.struct(F.lit(kind).alias("rule"), ids(q).alias("ids")) for kind, q in queries.items()))
    return blocks.select(F.explode(each).alias("x")).select("x.rule", F.explode("x.ids").alias("doc_id")).groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def _spans(df: DataFrame, rule: Rule, order: int) -> DataFrame:
    """df (text, rules) with a column s_kind: spans (start, order, kind, end) in code points of the matches that count."""
    pattern, kind = F.lit(rule.pattern), rule.kind
    asked = F.array_contains("rules", kind)
    none = F.array().cast("array<string>")
    df = df.withColumn(f"m_{kind}", F.when(asked, F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(none))
    some = F.size(f"m_{kind}") > 0
    tested = F.when(some, F.regexp_extract_all("text", pattern, F.lit(rule.group))).otherwise(none) if rule.group else F.col(f"m_{kind}")
    gaps = F.when(some, F.slice(F.split("text", rule.pattern, -1), 1, F.size(f"m_{kind}"))).otherwise(none)
    facts = F.zip_with(F.zip_with(gaps, f"m_{kind}", lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))), tested, lambda a, t: F.struct(a.gap.alias("gap"), a["size"].alias("size"), (F.length(t) >= rule.least).alias("ok")))
    span = "array<struct<start:int,at:int,kind:string,end:int>>"
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(span).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc.pos + x.gap
        one = F.array(F.struct(begin.alias("start"), F.lit(order).alias("at"), F.lit(kind).alias("kind"), (begin + x["size"]).alias("end")))
        return F.struct((begin + x["size"]).alias("pos"), F.when(x.ok, F.concat(acc.spans, one)).otherwise(acc.spans).alias("spans"))

    return df.withColumn(f"f_{kind}", facts).withColumn(f"s_{kind}", F.when(F.size(f"f_{kind}") > 0, F.aggregate(f"f_{kind}", start, step, lambda acc: acc.spans)).otherwise(F.array().cast(span)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each row of (doc_id, text): doc_id, n_<kind> for each rule, base_sha256 of the spans of BASE, and all spans.

    Rules whose pattern has mandatory trigrams are verified only on documents that the index gives;
    the others, and rows without a doc_id, are scanned fully. A null text counts as empty. Repeated
    rows repeat, an empty table gives an empty table, other columns are not read.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if frozenset() not in q}
    full = [r.kind for r in rules if r.kind not in indexed]
    rows = docs.select("doc_id", "text")
    if indexed:
        index = stored(trigram_index(rows, sorted({g for q in indexed.values() for group in q for g in group})), "postings")
        found = stored(candidates(index, indexed), "candidates").withColumnRenamed("doc_id", "found_id")
        small = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        rows = rows.join(F.broadcast(found) if small else found, rows.doc_id == found.found_id, "left")
        every = F.array(*(F.lit(r.kind) for r in rules))
        known = F.concat(F.array(*map(F.lit, full)).cast("array<string>"), F.coalesce("rules", F.array().cast("array<string>")))
        rows = rows.select("doc_id", "text", F.when(F.col("doc_id").isNull(), every).otherwise(known).alias("rules"))
    else:
        rows = rows.withColumn("rules", F.array(*map(F.lit, full)))
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    for i, r in enumerate(rules):
        rows = _spans(rows, r, i)
    base = F.concat(*(F.col(f"s_{r.kind}") for r in rules if r in BASE))
    everything = F.concat(*(F.col(f"s_{r.kind}") for r in rules))
    counts = [F.size(f"s_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in rules]
    return rows.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(everything).alias("spans"))


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return scan(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def _sql() -> str:
    """The same rows by full scans in DuckDB."""
    parts = []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, {i} AS nth, '{r.kind}' AS kind, start, start + size AS stop FROM (
            SELECT doc_id, unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0)))::BIGINT AS start,
                   unnest(list_transform(m, lambda x: length(x)))::BIGINT AS size, unnest(list_transform(g, lambda x: length(x)))::BIGINT AS tested
            FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', {r.group}) AS g, regexp_split_to_array(text, '{pattern}') AS s
                  FROM documents WHERE regexp_matches(text, '{pattern}'))) WHERE tested >= {r.least}""")
    return f"""WITH found AS ({" UNION ALL ".join(parts)}),
        joined AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
            string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth) FILTER (nth < {len(BASE)}) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth) AS spans
            FROM found GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id"""


SQL = _sql()
