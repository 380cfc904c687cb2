"""Vector functions: deterministic hash embeddings, norms and cosines, all in 64-bit floats."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from quillspark.session import bounded_batches

DIMENSION = 384


def _doubles(v: Column | str) -> Column:
    return F.transform(F.col(v) if isinstance(v, str) else v, lambda x: x.cast("double"))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_doubles(v), F.lit(0.0), lambda acc, x: acc + x * x))


def normalize(v: Column | str) -> Column:
    """At length 1; the zero vector stays."""
    size = norm(v)
    return F.when(size > 0, F.transform(_doubles(v), lambda x: x / size)).otherwise(_doubles(v))


def cosine(a: Column | str, b: Column | str) -> Column:
    """0 where a norm is 0; vectors of different lengths raise; null stays null."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    size = norm(a) * norm(b)
    same = F.size(a) == F.size(b)
    return F.when(~same, F.raise_error(F.lit("vectors differ in length")).cast("double")).when(size > 0, dot(a, b) / F.nullif(size, F.lit(0.0))).when(a.isNotNull() & b.isNotNull(), F.lit(0.0))


def hash_slots(text: Column | str, dimension: int = DIMENSION) -> Column:
    """For each word between white space, lower-cased: (place, sign) by its SHA-256."""
    col = F.col(text) if isinstance(text, str) else text
    each = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(r"(?U)\S+"), F.lit(0))

    def slot(word: Column) -> Column:
        h = F.sha2(word, 256)
        place = F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % dimension
        even = F.conv(F.substring(h, 9, 2), 16, 10).cast("int") % 2 == 0
        return F.struct(place.cast("int").alias("place"), F.when(even, 1).otherwise(-1).alias("sign"))

    return F.transform(each, slot)


def hash_nonzeros(rows: DataFrame, key: str, text: str, dimension: int = DIMENSION) -> DataFrame:
    """(key, place, value) of the sums that aren't 0, before they are brought to length 1. A row is a text of its own."""
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots(dimension)
        for batch in batches:
            row, place, value = slots.sums([x.split("\n") if x else [] for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(place.astype(np.int32)), pa.array(value)], names=[key, "place", "value"])

    # the words have no line ends
    words = F.array_join(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"(?U)\S+"), F.lit(0)), "\n")
    return rows.select(key, words.alias("_w")).mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, place int, value bigint")


class Slots(dict):
    """word -> 2 * place, and 1 more where its sign is +; what was worked out is kept, up to a bound, from batch to batch."""

    MOST = 500_000

    def __init__(self, dimension: int = DIMENSION) -> None:
        super().__init__()
        self.dimension = dimension

    def __missing__(self, word: str) -> int:
        h = hashlib.sha256(word.encode()).digest()
        slot = self[word] = int.from_bytes(h[:4], "big") % self.dimension * 2 + 1 - h[4] % 2
        return slot

    def sums(self, rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, value) of the sums that aren't 0 of each row's words, by row and place."""
        if len(self) > self.MOST:
            self.clear()
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        each = np.fromiter(map(self.__getitem__, chain.from_iterable(rows)), np.int64, int(lengths.sum()))
        key = np.repeat(np.arange(len(rows)) * self.dimension, lengths) + each // 2
        total = np.bincount(key, weights=each % 2 * 2 - 1, minlength=len(rows) * self.dimension).astype(np.int64)
        at = np.flatnonzero(total)
        return at // self.dimension, at % self.dimension, total[at]

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """sums of texts' words."""
        return self.sums([(value or "").lower().split() for value in texts.to_pylist()])


def at_length_one(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """value of each (row, place), the row's values at length 1; sums of squares are whole numbers, so their order is nothing."""
    return value / np.sqrt(np.bincount(row, weights=value.astype(np.float64) ** 2, minlength=rows))[row]


def sparse_vectors(row: np.ndarray, place: np.ndarray, value: np.ndarray, rows: int) -> pa.ListArray:
    """Unit vectors as lists of (place, weight), in order of place."""
    entries = pa.StructArray.from_arrays([pa.array(place.astype(np.int32)), pa.array(at_length_one(row, value, rows))], names=["place", "weight"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), entries)


def hash_sparse(rows: DataFrame, key: str, text: str, dimension: int = DIMENSION) -> DataFrame:
    """(key, vector): unit vectors as arrays of (place, weight) in order of place, empty where nothing is left.

    hash_nonzeros says the same in SQL's terms; both add up within a row, in Arrow batches, and shuffle nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots(dimension)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), sparse_vectors(*slots.of_texts(batch.column(1)), batch.num_rows)], names=[key, "vector"])

    return rows.select(key, text).mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, vector array<struct<place:int,weight:double>>")


def hash_embedding(rows: DataFrame, key: str, text: str, dimension: int = DIMENSION) -> DataFrame:
    """(key, embedding): dense unit vectors; a text without words gives zeros."""
    sparse = hash_sparse(rows, key, text, dimension)
    at = F.map_from_entries("vector")
    return sparse.select(key, F.transform(F.sequence(F.lit(0), F.lit(dimension - 1)), lambda i: F.coalesce(F.try_element_at(at, i), F.lit(0.0))).alias("embedding"))


def sparse_dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of arrays of (place, weight); work is that of the shorter, by a map of the other."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    at = F.map_from_entries(b)
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.weight * F.coalesce(F.try_element_at(at, x.place), F.lit(0.0)))


Encoder = Callable[[list[str]], list[list[float]]]


def encode(rows: DataFrame, key: str, text: Column | str, load: Callable[[], Encoder] | None = None, kind: str = "passage", dimension: int = DIMENSION) -> DataFrame:
    """Adds the column embedding. load gives a model's function, called once a worker on Arrow batches with the prefix `kind: `.

    Without it the hash embedding is used, which takes no prefix.
    """
    rows = rows.withColumn("_encoded", text if isinstance(text, Column) else F.col(text))
    if load is None:
        slots = hash_embedding(rows, key, "_encoded", dimension)
        return rows.drop("_encoded").join(slots, key)

    @F.pandas_udf(ArrayType(DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series([[float(x) for x in v] for v in model([f"{kind}: {t}" for t in batch.fillna("")])])

    return rows.withColumn("embedding", run("_encoded")).drop("_encoded")
