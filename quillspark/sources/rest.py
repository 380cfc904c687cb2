"""A paged REST source of posts, batch and streaming, over a fetch function that tests and users can replace."""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from quillspark import schemas

FIELDS = "id,slug,link,date,title,content,categories"
ATTEMPTS = 4
LONGEST_WAIT = 60.0
AGENTS = ("Mozilla/5.0 (X11; Linux x86_64) quillspark", "Mozilla/5.0 (Macintosh) quillspark", "Mozilla/5.0 (Windows NT 10.0) quillspark", "quillspark")


def http_get(url: str, timeout: float = 30.0, pause: tuple[float, float] = (0.8, 2.4), opener=urllib.request.urlopen, sleep=time.sleep) -> tuple[int, dict[str, str], bytes]:
    """Status, headers and body; so many attempts with growing random waits, and a server's Retry-After up to a minute."""
    for attempt in range(ATTEMPTS):
        sleep(random.uniform(*pause))
        try:
            with opener(urllib.request.Request(url, headers={"User-Agent": random.choice(AGENTS)}), timeout=timeout) as r:
                return r.status, dict(r.headers), r.read()
        except urllib.error.HTTPError as e:
            asked = (e.headers or {}).get("Retry-After", "")
            if e.code not in (408, 425, 429, 500, 502, 503, 504) or attempt == ATTEMPTS - 1:
                raise
            sleep(min(LONGEST_WAIT, float(asked)) if asked.isdigit() else random.uniform(1, min(20.0, 2.0 ** (attempt + 1))))
        except OSError:
            if attempt == ATTEMPTS - 1:
                raise
            sleep(random.uniform(1, min(20.0, 2.0 ** (attempt + 1))))
    raise AssertionError


def _row(post: dict) -> tuple:
    shown = lambda v: v.get("rendered") if isinstance(v, dict) else v
    return post.get("id"), post.get("slug"), post.get("link"), post.get("date"), shown(post.get("title")), shown(post.get("content")) or "", post.get("categories") or []


def fetch_page(options: dict[str, str], page: int, get=http_get) -> tuple[list[tuple], bool]:
    """A page's rows, and whether another may follow. A folder of page-<n>.json stands in for a server where `folder` is set."""
    size = int(options.get("perPage", "100"))
    if options.get("folder"):
        try:
            with open(f"{options['folder']}/page-{page}.json", encoding="utf-8") as f:
                posts = json.load(f)
        except FileNotFoundError:
            return [], False
        return [_row(p) for p in posts], bool(posts)
    _, headers, body = get(f"{options['url']}?per_page={size}&page={page}&_fields={options.get('fields', FIELDS)}")
    posts = json.loads(body)
    pages = {k.lower(): v for k, v in headers.items()}.get("x-wp-totalpages", "")
    return [_row(p) for p in posts], bool(posts) and not (pages.isdigit() and page >= int(pages))


class _Page(InputPartition):
    def __init__(self, first: int, step: int) -> None:
        self.first, self.step = first, step


class _Reader(DataSourceReader):
    """Partition i of n reads pages i, i + n, ... until one is empty or the last."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        n, start = int(self.options.get("readers", "1")), int(self.options.get("startPage", "1"))
        return [_Page(start + i, n) for i in range(n)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        page, more = partition.first, True
        while more:
            rows, more = fetch_page(self.options, page)
            yield from rows
            page += partition.step


class _StreamReader(SimpleDataSourceStreamReader):
    """The offset is the next page; a batch is a page, and the stream stays at the last full page's end."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def initialOffset(self) -> dict:
        return {"page": int(self.options.get("startPage", "1"))}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, _ = fetch_page(self.options, start["page"])
        return iter(rows), {"page": start["page"] + (1 if rows else 0)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for page in range(start["page"], end["page"]):
            yield from fetch_page(self.options, page)[0]


class PostSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rest_posts"

    def schema(self):
        return schemas.POST

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _StreamReader(dict(self.options))


def read_posts(spark: SparkSession, limit: int | None = None, **options: str) -> DataFrame:
    """Posts of a REST endpoint (option url) or of stored pages (option folder)."""
    spark.dataSource.register(PostSource)
    rows = spark.read.format("rest_posts").options(**options).load()
    return rows if limit is None else rows.limit(limit)


def stream_posts(spark: SparkSession, **options: str) -> DataFrame:
    spark.dataSource.register(PostSource)
    return spark.readStream.format("rest_posts").options(**options).load()


def post_of_slug(posts: DataFrame, slug: str):
    """The first post of a slug; none raises."""
    row = posts.where(F.col("slug") == slug).first()
    if row is None:
        raise LookupError(f"no post has slug {slug}")
    return row


def post_of_page(pages: DataFrame, slug: str) -> DataFrame:
    """A post made of a page (url, html), for sites without an endpoint: no id and no date."""
    from quillspark.functions.html import article_html, page_title

    return pages.select(F.lit(None).cast("long").alias("id"), F.lit(slug).alias("slug"), F.col("url").alias("link"), F.lit(None).cast("string").alias("date"), page_title("html").alias("title"), article_html("html").alias("content"), F.array().cast("array<int>").alias("categories"))


def probe(url: str, timeout: float = 10.0, get=http_get) -> tuple[bool, str]:
    """Whether an endpoint gives posts, and what it said; errors are told, not raised."""
    try:
        _, _, body = get(url, timeout)
        posts = json.loads(body)
        ok = isinstance(posts, list) and bool(posts) and isinstance(posts[0], dict) and "id" in posts[0]
        return ok, "posts" if ok else "no posts"
    except Exception as e:  # noqa: BLE001
        return False, f"{type(e).__name__}: {e}"
