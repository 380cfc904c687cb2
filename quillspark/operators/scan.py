"""Scores of a bounded batch of queries against every row of an index, of which only the best ever leave a task.

A row of the index holds a chunk's terms, their counts and its vector, so a block of rows meets all
queries at once in memory of a fixed size, and no pair of query and chunk becomes a row of a plan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quillspark.functions import vectors

K1, B = 1.5, 0.75
PLACES = 6  # decimals of a score: ties don't hang on the order of a sum
PAIRS, HITS = 1_000_000, 4_000_000  # pairs of row and query, and of posting and query, in one step


@dataclass
class Asked:
    """Queries: their ids, vectors as the columns of a matrix, and weighted terms; of a term those of first[t] to first[t + 1]."""

    ids: pa.Array
    kind: str  # of the ids, as Spark names it
    matrix: np.ndarray | None = None
    words: pa.Array | None = None
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    asker: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    mean_size: float = 1.0


def rounded(x: np.ndarray) -> np.ndarray:
    """Half away from 0; never -0."""
    return np.copysign(np.floor(np.abs(x) * 10.0**PLACES + 0.5) / 10.0**PLACES, x) + 0.0


#: A place of a chunk's hash embedding and the sum there.
SLOT = np.dtype([("place", "<u2"), ("value", "<i4")])


def owners(lists: pa.ListArray) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))


def lines(texts: pa.Array) -> pa.ListArray:
    """The words of texts that have one a line; none of an empty text."""
    return pc.split_pattern(pc.if_else(pc.equal(texts, ""), None, texts), "\n")


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows' values as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of what packed() made."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4)
    values = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind) if len(column) and data is not None else np.zeros(0, kind)
    return np.repeat(np.arange(len(column)), np.diff(ends) // kind.itemsize), values


def spread(row: np.ndarray, slots: np.ndarray, rows: int) -> np.ndarray:
    """Unit vectors as rows of a matrix."""
    out = np.zeros((rows, vectors.DIMENSION))
    out[row, slots["place"]] = vectors.at_length_one(row, slots["value"].astype(np.int64), rows)
    return out


def narrowed(asked: Asked, terms: pa.Array, tfs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, asked term, count) of the postings that some query asks for."""
    words = lines(terms)
    code = pc.fill_null(pc.index_in(words.flatten(), asked.words), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(code >= 0)
    return owners(words)[at], code[at].astype(np.int64), unpacked(tfs, np.dtype("<i4"))[1][at].astype(np.float64)


class Postings:
    """The asked postings of a block of rows, by row."""

    def __init__(self, asked: Asked, size: np.ndarray, row: np.ndarray, code: np.ndarray, tf: np.ndarray) -> None:
        self.asked, self.code, self.row = asked, code, row
        self.part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[row] / asked.mean_size))
        self.askers = (asked.first[1:] - asked.first[:-1])[code]
        self.at = np.searchsorted(row, np.arange(len(size) + 1))
        self.hits = np.concatenate([[0], np.cumsum(self.askers)])[self.at]

    def scores(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Of rows a to b and all queries: BM25, and whether they share a term."""
        n, lo, hi = len(self.asked.ids), self.at[a], self.at[b]
        many = self.askers[lo:hi]
        posting = np.repeat(np.arange(lo, hi), many)
        ends = np.cumsum(many)
        pair = np.arange(len(posting)) - np.repeat(ends - many, many) + self.asked.first[self.code[posting]]
        key = (self.row[posting] - a) * n + self.asked.asker[pair]
        total = np.bincount(key, weights=self.part[posting] * self.asked.weight[pair], minlength=(b - a) * n)
        seen = np.zeros((b - a) * n, bool)
        seen[key] = True
        return rounded(total).reshape(b - a, n), seen.reshape(b - a, n)

    def steps(self) -> Iterator[tuple[int, int]]:
        """Ranges of rows of at most PAIRS and HITS, or of one row."""
        return steps(len(self.at) - 1, len(self.asked.ids), self.hits)


def steps(rows: int, queries: int, hits: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    a = 0
    while a < rows:
        b = min(rows, a + max(1, PAIRS // max(1, queries)))
        if hits is not None:
            b = min(b, max(a + 1, int(np.searchsorted(hits, hits[a] + HITS, "right")) - 1))
        yield a, b
        a = b


class Best:
    """The k best of each query of blocks of scores, ties by the first of the columns that come with a block."""

    def __init__(self, queries: int, k: int) -> None:
        self.queries, self.k = queries, k
        self.floor = np.full(queries, -np.inf)
        self.most = max(2 * queries * k, 200_000)
        self.held: list[pa.Table] = []
        self.rows = 0

    def add(self, columns: list[pa.Array], scores: np.ndarray, more: tuple[np.ndarray, ...] = (), among: np.ndarray | None = None) -> None:
        able = scores if among is None else np.where(among, scores, -np.inf)
        take = able >= self.floor
        if among is not None:
            take &= among
        if np.count_nonzero(take) > self.most // 2 and len(scores) > self.k:
            self.floor = np.maximum(self.floor, np.partition(able, len(able) - self.k, axis=0)[len(able) - self.k])
            take &= able >= self.floor
        row, query = np.nonzero(take)
        if not len(row):
            return
        at = pa.array(row)
        self.held.append(pa.table([pa.array(query.astype(np.int32)), pa.array(scores[row, query]), *(c.take(at) for c in columns), *(pa.array(m[row, query]) for m in more)], names=["q", "score", *(f"c{i}" for i in range(len(columns))), *(f"m{i}" for i in range(len(more)))]))
        self.rows += len(row)
        if self.rows > self.most:
            self._prune()

    def _prune(self) -> pa.Table:
        every = pa.concat_tables(self.held)
        every = every.take(pc.sort_indices(every, sort_keys=[("q", "ascending"), ("score", "descending"), ("c0", "ascending")], null_placement="at_start"))
        query = every["q"].to_numpy()
        rank = np.arange(len(query)) - np.searchsorted(query, np.arange(self.queries))[query]
        last = np.flatnonzero(rank == self.k - 1)
        self.floor[query[last]] = np.maximum(self.floor[query[last]], every["score"].to_numpy()[last])
        kept = every.filter(pa.array(rank < self.k)).combine_chunks()
        self.held, self.rows = [kept], kept.num_rows
        return kept

    def result(self, ids: pa.Array, names: list[str]) -> Iterator[pa.RecordBatch]:
        """query_id, score and what came with the blocks, under the given names."""
        if self.held:
            kept = self._prune()
            whole = pa.table([ids.take(kept["q"].combine_chunks()), *kept.columns[1:]], names=names)
            yield from whole.combine_chunks().to_batches(max_chunksize=100_000)
