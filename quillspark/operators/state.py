"""Resumable crawl state: a keyed table that events are folded into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.graph import last_per_key, upsert

MAX_RETRIES = 5


def fold_events(events: DataFrame) -> DataFrame:
    """What a run of events does to each slug, as one row: see apply_events. events has schemas.CRAWL_EVENT.

    Discoveries: the last address and gazette flag hold, the last known post id and English address
    too. Statuses: the last status and error hold, and errors are counted. Statuses before a slug's
    first discovery do nothing to a slug that isn't known yet, so they are kept apart.
    """
    known = F.col("kind") == "discovered"
    last = lambda c, cond: F.max_by(F.when(cond, F.col(c)), F.when(cond, F.col("seq")))
    first = events.where(known).groupBy("slug").agg(F.min("seq").alias("first"))
    rows = events.join(first, "slug", "left")
    mark = ~known
    after = mark & (F.col("seq") > F.col("first"))
    return rows.groupBy("slug").agg(
        F.max(known).alias("discovered"),
        last("source_url", known).alias("source_url"), last("is_gazette", known).alias("is_gazette"),
        last("post_id", known & F.col("post_id").isNotNull()).alias("post_id"), last("english_url", known & F.col("english_url").isNotNull()).alias("english_url"),
        *(f for name, cond in (("all", mark), ("new", after)) for f in (
            F.max(cond).alias(f"marked_{name}"), last("status", cond).alias(f"status_{name}"), last("error", cond).alias(f"error_{name}"), F.count_if(cond & F.col("error").isNotNull()).cast("int").alias(f"errors_{name}"))),
        F.max("at").alias("at"),
    )


def apply_events(state: DataFrame, events: DataFrame) -> DataFrame:
    """state (schemas.CRAWL_STATE) after the events, in order of seq.

    A discovery inserts a slug as pending, or overwrites its address and gazette flag, keeps its post
    id and English address where the new ones are null, and leaves status and retries. A status
    counts a retry where it has an error; a slug that isn't known is left out.
    """
    folded = fold_events(events).alias("f")
    s = state.alias("s")
    rows = s.join(folded, F.col("s.slug") == F.col("f.slug"), "full")
    held = F.col("s.slug").isNotNull()
    rows = rows.where(held | F.coalesce(F.col("f.discovered"), F.lit(False)))

    def marked(c: str) -> Column:
        return F.when(held, F.col(f"f.{c}_all")).otherwise(F.col(f"f.{c}_new"))

    was = F.coalesce(marked("marked"), F.lit(False))
    seen = F.coalesce(F.col("f.discovered"), F.lit(False))
    return rows.select(
        F.coalesce("s.slug", "f.slug").alias("slug"), F.coalesce("f.post_id", "s.post_id").alias("post_id"),
        F.when(seen, F.col("f.source_url")).otherwise(F.col("s.source_url")).alias("source_url"),
        F.when(was, marked("status")).otherwise(F.coalesce("s.status", F.lit("pending"))).alias("status"),
        (F.coalesce("s.retries", F.lit(0)) + F.coalesce(marked("errors"), F.lit(0))).cast("int").alias("retries"),
        F.when(seen, F.col("f.is_gazette")).otherwise(F.col("s.is_gazette")).alias("is_gazette"),
        F.coalesce("f.english_url", "s.english_url").alias("english_url"),
        F.when(was, marked("error")).otherwise(F.col("s.error")).alias("error"),
        F.coalesce("f.at", "s.updated_at").alias("updated_at"),
    )


def pending(state: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Rows to crawl (again), the oldest first."""
    return state.where(F.col("status").isin("pending", "failed") & (F.col("retries") <= max_retries)).orderBy("updated_at", "slug")


def set_meta(meta: DataFrame, rows: DataFrame) -> DataFrame:
    """Key-value upsert; rows have key, value, updated_at and seq."""
    return upsert(meta, last_per_key(rows, ("key",)).drop("seq"), ("key",))


def get_meta(meta: DataFrame, key: str, default: str | None = None) -> str | None:
    row = meta.where(F.col("key") == key).select("value").first()
    return row.value if row else default
