"""PDF files as Markdown: a section for each page that has text. The extractor is a plug-in; the default reads plain text operators."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)
_SHOWN = re.compile(rb"\(((?:\\.|[^\\()])*)\)\s*(?:Tj|'|\")|\[((?:\\.|[^\]])*)\]\s*TJ|(T\*|Td\b|TD\b|ET\b)", re.S)
_PART = re.compile(rb"\(((?:\\.|[^\\()])*)\)", re.S)
_ESCAPE = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b""}


def _literal(raw: bytes) -> str:
    def one(m: re.Match) -> bytes:
        e = m[1]
        return bytes([int(e, 8) & 255]) if e[:1].isdigit() else _ESCAPE.get(e, e)

    return re.sub(rb"\\([0-7]{1,3}|.)", one, raw, flags=re.S).decode("latin-1")


def plain_pages(data: bytes) -> list[str]:
    """The shown strings of each page, in the order of the pages' objects."""
    objects = {int(m[1]): m[2] for m in _OBJECT.finditer(data)}
    pages = []
    for number in sorted(objects):
        body = objects[number]
        if not re.search(rb"/Type\s*/Page\b", body):
            continue
        named = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
        text = []
        for ref in re.findall(rb"(\d+)\s+\d+\s+R", named[1]) if named else []:
            held = objects.get(int(ref), b"")
            stream = _STREAM.search(held)
            if not stream:
                continue
            raw = stream[1]
            if b"/FlateDecode" in held:
                try:
                    raw = zlib.decompress(raw)
                except zlib.error:
                    continue
            for m in _SHOWN.finditer(raw):
                text.append("\n" if m[3] else _literal(m[1]) if m[1] is not None else "".join(_literal(p) for p in _PART.findall(m[2])))
        pages.append("".join(text))
    return pages


def pages_to_markdown(pages: list[str]) -> str:
    """`## Page i` and the text of each page that isn't blank; blank pages are counted."""
    return "\n\n".join(f"## Page {i}\n\n{t.strip()}" for i, t in enumerate(pages, 1) if t.strip())


def pdf_to_markdown(content: Column | str, load: Callable[[], Callable[[bytes], list[str]]] | None = None) -> Column:
    """load gives the extractor, called once a worker; a file that it can't read gives null."""

    @F.pandas_udf("string")
    def run(files: pd.Series) -> pd.Series:
        extract = load() if load else plain_pages

        def one(data) -> str | None:
            try:
                return None if data is None else pages_to_markdown(extract(bytes(data)))
            except Exception:  # noqa: BLE001
                return None

        return pd.Series([one(x) for x in files], dtype=object)

    return run(content)


def read_pdfs(spark: SparkSession, path: str, load=None) -> DataFrame:
    """(url, text) of the PDF files in a folder of any store."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)
    return files.select(F.col("path").alias("url"), pdf_to_markdown("content", load).alias("text"))
