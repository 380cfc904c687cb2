"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Every word of the examples is a term. A term's weight is its inverse document frequency times FLOOR
plus the share of the label's variance that its presence explains, so words that go with the label
count for more, and no word is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from quillspark.llm.common import draw, fold, ranges, steps, table, utf8
from quillspark.llm.features import words

EXAMPLES = 2000  # labelled rows of each class, at most
NEIGHBOURS = 25
BLOCK = 64  # examples under one maximum
LONG = 512  # postings lists, the longest, that are kept by block; shorter ones are read whole
FIRST = 3  # blocks that are read before bounds are compared
FLOOR = 0.01
ROWS = 256
THRESHOLD = 0.3


class BlockMaxIndex:
    """Postings of unit vectors by term.

    The LONG longest lists are dense, in blocks of examples, with each list's greatest weight in each
    block; the others are sparse. Examples stand in order of their heaviest terms, so that those of a
    block are alike and its maxima tell something.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int) -> None:
        self.size = len(vectors)
        self.blocks = -(-self.size // BLOCK) or 1
        heaviest = [(-1, 0.0) if not len(t) else (int(t[w.argmax()]), -float(w.max())) for t, w in vectors]
        self.example = np.array(sorted(range(self.size), key=lambda i: (heaviest[i], i)), np.int64)
        place = np.argsort(self.example)
        term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)]).astype(np.int64)
        weight = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        at = np.repeat(place, [len(t) for t, _ in vectors])
        count = np.bincount(term, minlength=terms)
        longest = np.argsort(-count, kind="stable")[:LONG]
        self.row = np.full(terms, -1, np.int64)
        self.row[longest] = np.arange(len(longest))
        dense = self.row[term] >= 0
        self.long = np.zeros((len(longest), self.blocks * BLOCK))
        self.long[self.row[term[dense]], at[dense]] = weight[dense]
        self.most = self.long.reshape(len(longest), self.blocks, BLOCK).max(2)
        term, at, weight = term[~dense], at[~dense], weight[~dense]
        order = np.lexsort((at, term))
        self.at, self.weight = at[order].astype(np.int32), weight[order]
        self.begin = np.searchsorted(term[order], np.arange(terms + 1))

    def nearest(self, own: np.ndarray, terms: np.ndarray, weights: np.ndarray, rows: int, k: int, without: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of so many rows the k examples of the greatest cosine above 0, exactly (ties: the first example), and their cosines.

        own is the row of each term. A block's long lists are read for the rows whose bound in it is
        not below their k-th best cosine so far; without names an example to leave out for each row.
        """
        wide = self.blocks * BLOCK
        row = self.row[terms]
        asked = np.zeros((rows, len(self.most)))
        asked[own[row >= 0], row[row >= 0]] = weights[row >= 0]
        short = row < 0
        begin = self.begin[terms[short]]
        size = self.begin[terms[short] + 1] - begin
        hit = np.repeat(begin, size) + ranges(size)
        # without any hit bincount gives integers, whatever the weights
        got = np.bincount(np.repeat(own[short], size) * wide + self.at[hit], np.repeat(weights[short], size) * self.weight[hit], rows * wide).astype(float).reshape(rows, wide)
        if without is not None:
            mine = np.argsort(self.example)[without]
        bound = asked @ self.most + got.reshape(rows, self.blocks, BLOCK).max(2)
        read = np.zeros((rows, self.blocks), bool)
        todo = np.zeros((rows, self.blocks), bool)
        np.put_along_axis(todo, np.argpartition(-bound, min(FIRST, self.blocks) - 1, axis=1)[:, :FIRST], True, axis=1)
        for _ in range(2):
            for b in np.flatnonzero(todo.any(0)):
                some = np.flatnonzero(todo[:, b])
                got[some, b * BLOCK : (b + 1) * BLOCK] += asked[some] @ self.long[:, b * BLOCK : (b + 1) * BLOCK]
            read |= todo
            seen = np.where(np.repeat(read, BLOCK, axis=1), got, 0.0)
            if without is not None:
                seen[np.arange(rows), mine] = 0.0
            kth = -np.partition(-seen, min(k, wide) - 1, axis=1)[:, min(k, wide) - 1]
            todo = ~read & (bound > 0) & (bound >= kth[:, None] - 1e-12)
            if not todo.any():
                break
        out = []
        for i in range(rows):
            best = np.flatnonzero((seen[i] > 0) & (seen[i] >= kth[i] - 1e-12))
            cosines, ids = np.round(seen[i, best], 12), self.example[best]
            order = np.lexsort((ids, -cosines))[:k]
            out.append((ids[order], cosines[order]))
        return out


class Scorer:
    """What fit() learns, and how a vector is scored: bounded by EXAMPLES texts and their words."""

    def __init__(self, vocabulary, idf, index, labels, ids, class_weight, base) -> None:
        self.vocabulary, self.idf, self.index, self.labels, self.ids, self.class_weight, self.base = vocabulary, idf, index, labels, ids, class_weight, base
        self.slope, self.offset = 1.0, 0.0

    def odds(self, ids: np.ndarray, cosines: np.ndarray) -> float:
        """Log odds of label 1 by distance-weighted votes."""
        y = self.labels[ids]
        pull = self.class_weight[y] / (1.05 - np.minimum(cosines, 1))
        one, zero = pull[y == 1].sum(), pull[y == 0].sum()
        return float(np.log((one + self.base) / (zero + 1 - self.base)))

    def others(self, vectors: list, some: np.ndarray) -> np.ndarray:
        """What these examples get from the others."""
        own = np.repeat(np.arange(len(some)), [len(vectors[i][0]) for i in some])
        terms, weights = (np.concatenate([vectors[i][part] for i in some]) for part in (0, 1))
        return np.array([self.odds(*x) for x in self.index.nearest(own, terms, weights, len(some), NEIGHBOURS, some)])

    def score(self, own: np.ndarray, terms: np.ndarray, weights: np.ndarray, rows: int) -> tuple[np.ndarray, list[list[int]]]:
        """Scores, and the five nearest voters' ids, of so many rows; a row without a term gets the base rate."""
        scores, evidence = np.full(rows, self.base), []
        for i, (ids, cosines) in enumerate(self.index.nearest(own, terms, weights, rows, NEIGHBOURS)):
            if len(ids):
                scores[i] = 1 / (1 + np.exp(-(self.slope * self.odds(ids, cosines) + self.offset)))
            evidence.append([self.ids[j] for j in ids[:5]])
        return scores, evidence


def _vectors(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, term and weight of each vocabulary term in each text; without idf the count."""
    hashes, owner = words(data, offsets)
    at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
    hit = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
    cell, n = np.unique(owner[hit] * np.int64(max(1, len(vocabulary))) + at[hit], return_counts=True)
    own, term = cell // max(1, len(vocabulary)), cell % max(1, len(vocabulary))
    if idf is None:
        return own, term, n.astype(float)
    w = (1 + np.log(n)) * idf[term]
    size = np.sqrt(np.bincount(own, w * w, len(offsets) - 1))
    return own, term, w / size[own]


def _examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most EXAMPLES labelled rows of each class outside fold 2, by a fixed draw, with their texts."""
    usable = labels.where((fold() != 2) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic").distinct().withColumn("draw", draw())
    chosen = [usable.where(F.col("toxic") == y).orderBy("draw", "doc_id").limit(EXAMPLES) for y in (0, 1)]
    # bounded by EXAMPLES rows of a class
    return docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1]).select("doc_id", "toxic")), "doc_id")


def fit(docs: DataFrame, labels: DataFrame) -> Scorer | None:
    """Vocabulary, weights and index; None where there are no usable labels of both classes.

    Document frequencies are counted over all documents, and class weights over all usable labels.
    Null labels and ids, labels other than 0 and 1, and labels of no document are left out; a
    document that is labelled both ways is an example of each. doc_id must be of an integer type.
    """
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("toxicity: doc_id must be of an integer type")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in steps(offsets):
                hashes, owner = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                at = np.flatnonzero(new)
                counts = np.diff(np.append(at, len(hashes)))
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner[at], minlength=b - a))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[at].view(np.int64))), pa.ListArray.from_arrays(pa.array(ends), pa.array(counts.astype(np.int32)))], names=["doc_id", "toxic", "words", "counts"])

    usable = labels.where((fold() != 2) & F.col("toxic").isin(0, 1))
    there = {int(r["toxic"]): int(r["count"]) for r in usable.groupBy("toxic").count().collect()}
    rows = _examples(docs, labels).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(bags, "doc_id bigint, toxic int, words array<bigint>, counts array<int>").toArrow().sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
    y = rows["toxic"].to_numpy().astype(np.int64)
    if len(set(y.tolist())) < 2:
        return None
    each = [np.array(x, np.int64).view(np.uint64) for x in rows["words"].to_pylist()]
    counts = [np.array(x, float) for x in rows["counts"].to_pylist()]
    owner = np.repeat(np.arange(len(y)), [len(x) for x in each])
    vocabulary, inverse = np.unique(np.concatenate(each), return_inverse=True)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    a = np.bincount(inverse, y[owner] == 1, len(vocabulary))
    b = np.bincount(inverse, y[owner] == 0, len(vocabulary))
    total = n1 + n0
    explained = (a * (n0 - b) - b * (n1 - a)) ** 2 / np.maximum(1e-9, (a + b) * (total - a - b) * n1 * n0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            seen += len(offsets) - 1
            for a, b in steps(offsets):
                _, term, _ = _vectors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], vocabulary, None)
                df += np.bincount(term, minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], seen))], names=["term", "df"])

    # a row a term of the examples at most
    found = docs.select("text").mapInArrow(frequencies, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("n")).toArrow()
    n = np.zeros(len(vocabulary) + 1)
    n[found["term"].to_numpy()] = found["n"].to_numpy()
    idf = (np.log((1 + n[-1]) / (1 + n[:-1])) + 1) * (FLOOR + explained)
    vectors = []
    for hashes, n in zip(each, counts, strict=True):
        at = np.searchsorted(vocabulary, hashes)
        w = (1 + np.log(n)) * idf[at]
        order = np.argsort(at)
        vectors.append((at[order], (w / (np.sqrt((w * w).sum()) or 1))[order]))
    weight = np.array([there[0] / n0, there[1] / n1])
    bare = np.array([not len(t) for t, _ in vectors])
    base = float((weight[1] * (bare & (y == 1)).sum() + there[1] / (there[0] + there[1])) / (weight[y[bare]].sum() + 1))
    out = Scorer(vocabulary, idf, BlockMaxIndex(vectors, len(vocabulary)), y, rows["doc_id"].to_pylist(), weight / weight.max(), base)
    # calibration: a logistic curve over what each example gets from the others
    some = np.flatnonzero(~bare)
    if len(some):
        odds = np.concatenate([np.zeros(0), *(out.others(vectors, some[a : a + ROWS]) for a in range(0, len(some), ROWS))])
        sample = weight[y[some]]
        target = np.where(y[some] == 1, 1 - 1e-3, 1e-3)
        p = np.array([1.0, 0.0])
        x = np.stack([odds, np.ones(len(odds))], 1)
        for _ in range(60):
            z = 1 / (1 + np.exp(-x @ p))
            h = (x * (sample * z * (1 - z))[:, None]).T @ x + np.diag([1e-2 * sample.sum(), 1e-4 * sample.sum()])
            g = x.T @ (sample * (z - target)) + 1e-2 * sample.sum() * np.array([p[0] - 1, 0])
            p = p - np.clip(np.linalg.solve(h, g), -1, 1)
        out.slope, out.offset = float(max(p[0], 0.05)), float(p[1])
    return out


def score_toxicity(docs: DataFrame, model: Scorer | None) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier), predicted, evidence (ids of the nearest voters) for each row of (doc_id, text).

    Texts without a word of the examples, empty and null ones among them, get the base rate and no
    evidence. Without a model (no labels of both classes) scores are 0. Repeated rows repeat; an
    empty table gives an empty table; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by EXAMPLES texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets, rows=ROWS):
                scores, evidence = np.zeros(b - a), [[] for _ in range(b - a)]
                if m:
                    scores, evidence = m.score(*_vectors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], m.vocabulary, m.idf), b - a)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32)), pa.array(evidence, pa.list_(pa.int64()))], names=["doc_id", "score", "predicted", "evidence"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int, evidence array<bigint>")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt outside fold 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold() == 2).alias("held_out"), "score", "predicted", "evidence")
