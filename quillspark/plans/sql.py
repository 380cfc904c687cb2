"""SQL fragments that the oracle statements are made of, for DuckDB."""

from __future__ import annotations

TOKENS = r"list_transform(regexp_extract_all(coalesce({}, ''), '[\p{{L}}\p{{N}}_]+|[\x{{0600}}-\x{{06FF}}]+'), lambda x: lower(x))"
SPACED = r"regexp_extract_all(coalesce({}, ''), '[^\s\p{{Z}}\x{{85}}\x{{0B}}]+')"
STOP = "('a','an','and','are','as','by','for','from','give','gives','in','is','of','on','or','the','to','what','which','who','whose','with')"


def tokens(column: str) -> str:
    return TOKENS.format(column)


def spaced(column: str) -> str:
    return SPACED.format(column)


def strong(column: str) -> str:
    """Search terms of a column."""
    every = tokens(column)
    picked = f"list_filter({every}, lambda w: length(w) > 2 AND w NOT IN {STOP})"
    return f"CASE WHEN len({picked}) > 0 THEN {picked} ELSE {every} END"


def bm25(prefix: str, rows: str, words: str = "text", asked: str | None = None) -> str:
    """CTEs <prefix>_... ending in <prefix>(query_id, chunk_id, score), of rows (chunk_id, text) and the benchmark's texts as queries."""
    return f"""
{prefix}_words AS (SELECT chunk_id, {tokens(words)} AS w FROM {rows}),
{prefix}_sizes AS (SELECT chunk_id, len(w)::BIGINT AS size FROM {prefix}_words),
{prefix}_facts AS (SELECT count(*) AS n, avg(size) AS mean_size FROM {prefix}_sizes),
{prefix}_postings AS (SELECT chunk_id, term, count(*) AS tf FROM (SELECT chunk_id, unnest(w) AS term FROM {prefix}_words) GROUP BY ALL),
{prefix}_raw AS (SELECT term, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS raw FROM (SELECT term, count(*) AS df FROM {prefix}_postings GROUP BY term), {prefix}_facts),
{prefix}_terms AS (SELECT term, CASE WHEN raw < 0 THEN 0.25::DOUBLE * (SELECT avg(raw) FROM {prefix}_raw) ELSE raw END AS idf FROM {prefix}_raw),
{prefix}_asked AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, unnest({asked or tokens("text")}) AS term FROM benchmark) GROUP BY ALL),
{prefix} AS (SELECT query_id, chunk_id, round(sum(qtf * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * size / mean_size))), 6) AS score
  FROM {prefix}_asked JOIN {prefix}_terms USING (term) JOIN {prefix}_postings USING (term) JOIN {prefix}_sizes USING (chunk_id), {prefix}_facts GROUP BY query_id, chunk_id)"""


def slots(key: str, rows: str, column: str = "text") -> str:
    """(key, place, value): hash embedding sums that aren't 0."""
    return f"""SELECT {key}, place, sum(sign)::BIGINT AS value FROM (SELECT {key}, (('0x' || substr(h, 1, 8))::BIGINT % 384)::INTEGER AS place,
  CASE WHEN ('0x' || substr(h, 9, 2))::BIGINT % 2 = 0 THEN 1 ELSE -1 END AS sign FROM (SELECT {key}, sha256(t) AS h FROM (SELECT {key}, unnest({spaced(f"lower({column})")}) AS t FROM {rows})))
  GROUP BY {key}, place HAVING sum(sign) <> 0"""


def dense(prefix: str, rows: str) -> str:
    """CTEs ending in <prefix>(query_id, chunk_id, score) over all pairs."""
    return f"""
{prefix}_cs AS ({slots("chunk_id", rows)}), {prefix}_qs AS ({slots("query_id", "(SELECT item_id AS query_id, text FROM benchmark)")}),
{prefix}_cv AS (SELECT chunk_id, place, value / sqrt(sum(value * value) OVER (PARTITION BY chunk_id))::DOUBLE AS x FROM {prefix}_cs),
{prefix}_qv AS (SELECT query_id, place, value / sqrt(sum(value * value) OVER (PARTITION BY query_id))::DOUBLE AS x FROM {prefix}_qs),
{prefix}_dot AS (SELECT query_id, chunk_id, sum(c.x * q.x) AS s FROM {prefix}_cv c JOIN {prefix}_qv q USING (place) GROUP BY ALL),
{prefix} AS (SELECT item_id AS query_id, ids.chunk_id, round(coalesce(s, 0), 6) AS score FROM benchmark CROSS JOIN (SELECT chunk_id FROM {rows}) ids
  LEFT JOIN {prefix}_dot d ON d.query_id = item_id AND d.chunk_id = ids.chunk_id)"""


def top(scores: str, k: int, columns: str = "query_id, chunk_id, score") -> str:
    return f"SELECT {columns}, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id)::INTEGER AS rank FROM {scores} QUALIFY rank <= {k}"
