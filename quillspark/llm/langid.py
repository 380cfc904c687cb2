"""Language identification by the nearest of several TF-IDF n-gram centroids of each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import draw, fold, steps, table, utf8
from quillspark.llm.features import LETTERS_ONLY, grams, unit

WIDTH = 4096  # hashed n-grams of 1 to 3 bytes
EXAMPLES = 800  # texts of each language that centroids are fitted on, at most
LANGUAGES = 1000  # values of lang, at most
CENTROIDS = 4  # of each language
SHARPNESS = 40.0  # of the score, over cosines
SPREAD = 6.0  # standard deviations below a centroid's mean cosine at which a text is rejected
ROWS = 512
UNKNOWN = "und"


def _tf(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.log1p(grams(LETTERS_ONLY[data], offsets, WIDTH).astype(np.float32))


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    count = np.concatenate([[0], np.cumsum(ascii_letter)])
    out = count[offsets[1:]] > count[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode()))
    return out


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the rows farthest from each other; empty clusters go."""
    centres = [unit(x.mean(0, keepdims=True))[0]]
    near = x @ centres[0]
    for _ in range(1, min(k, len(x))):
        centres.append(x[int(near.argmin())])
        near = np.maximum(near, x @ centres[-1])
    c = np.stack(centres)
    for _ in range(15):
        own = (x @ c.T).argmax(1)
        c = unit(np.stack([x[own == i].mean(0) for i in range(len(c)) if (own == i).any()]))
    return c


class Centroids:
    def __init__(self, names: list[str], idf: np.ndarray, centres: np.ndarray, language: np.ndarray, floor: np.ndarray) -> None:
        self.names, self.idf, self.centres, self.language, self.floor = names, idf, centres, language, floor

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The nearest language, whether it is near enough, a score of 0 to 1, and the cosine, of each text with letters."""
        cosines = unit(_tf(data, offsets) * self.idf) @ self.centres.T
        best = cosines.argmax(1)
        top = cosines[np.arange(len(best)), best]
        each = np.stack([cosines[:, self.language == i].max(1) for i in range(len(self.names))], 1)
        odds = np.exp(SHARPNESS * (each - top[:, None]))
        return [self.names[i] for i in self.language[best]], top >= self.floor[best], (1 / odds.sum(1)).astype(float), top.astype(float)


def fit(docs: DataFrame) -> Centroids | None:
    """Centroids from the texts and non-null lang of documents outside fold 2; None where there are none.

    Document frequencies are counted over all of them and summed before they are gathered; centroids
    come from EXAMPLES texts of each language at most, by a fixed draw, and are clustered in tasks.
    The driver gets WIDTH counts, and CENTROIDS vectors of each of at most LANGUAGES languages.
    """
    known = docs.where((fold() != 2) & F.col("lang").isNotNull() & (F.length("text") > 0))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} values of lang: that is no column of languages")
    if not sizes:
        return None
    # twice the share that gives EXAMPLES texts, so that the cut below decides
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2 * EXAMPLES / n))))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen = np.zeros(WIDTH, np.int64), 0
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in steps(offsets, rows=ROWS):
                df += (grams(LETTERS_ONLY[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a], WIDTH) > 0).sum(0)
                seen += b - a
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(WIDTH + 1)), pa.array(np.append(df, seen))], names=["place", "n"])

    counts = np.zeros(WIDTH + 1, np.int64)
    # WIDTH + 1 rows
    for r in known.select("text").mapInArrow(learn, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[r["place"]] = r["n"]
    idf = (np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1).astype(np.float32)
    order = W.partitionBy("lang").orderBy("drawn", F.xxhash64("text"))
    chosen = known.where(draw() < share[F.col("lang")]).select("lang", "text", draw().alias("drawn")).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= EXAMPLES)

    def cluster(key: tuple, rows: pa.Table) -> pa.Table:
        data, offsets = utf8(rows["text"])
        vectors = [np.zeros((0, WIDTH), np.float32), *(_tf(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in steps(offsets, rows=ROWS))]
        x = unit(np.concatenate(vectors) * idf)
        c = _cluster(x[np.lexsort(x[:, :8].T)], CENTROIDS)
        near = x @ c.T
        own = near.argmax(1)
        floors = [float(near[own == j, j].mean() - SPREAD * near[own == j, j].std()) if (own == j).sum() > 1 else 0.0 for j in range(len(c))]
        return pa.table({"lang": [key[0].as_py()] * len(c), "centre": pa.array([v.astype(np.float32).tobytes() for v in c], pa.binary()), "floor": pa.array(floors, pa.float64())})

    # a group is EXAMPLES texts at most
    rows = chosen.select("lang", "text").groupBy("lang").applyInArrow(cluster, "lang string, centre binary, floor double").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["lang"], r["centre"]))
    names = sorted({r["lang"] for r in rows})
    return Centroids(names, idf, np.stack([np.frombuffer(r["centre"], np.float32) for r in rows]), np.array([names.index(r["lang"]) for r in rows]), np.array([r["floor"] for r in rows]))


def identify(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """doc_id, lang_nearest, lang_pred, score, cosine for each row of (doc_id, text).

    lang_pred is lang_nearest, or `und` where the text is farther from its centroid than that
    centroid's own texts are (SPREAD), or has no letter; a null, empty or letterless text has
    lang_nearest `und` too, and score 0. Without a model everything is `und`. Repeated rows repeat,
    an empty table gives an empty table, other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x CENTROIDS x WIDTH numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets, rows=ROWS):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                lettered = _has_letter(part, at) & (m is not None)
                if m is None:
                    names, near, score, cosine = [UNKNOWN] * (b - a), np.ones(b - a, bool), np.zeros(b - a), np.zeros(b - a)
                else:
                    names, near, score, cosine = m.predict(part, at)
                nearest = [n if ok else UNKNOWN for n, ok in zip(names, lettered, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(nearest, pa.string()), pa.array([n if ok else UNKNOWN for n, ok in zip(nearest, near, strict=True)], pa.string()), pa.array(np.where(lettered, score, 0.0)), pa.array(np.where(lettered, cosine, 0.0))], names=["doc_id", "lang_nearest", "lang_pred", "score", "cosine"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_nearest string, lang_pred string, score double, cosine double")


def op4_langid(spark, sf_dir: str) -> DataFrame:
    """Every document's language, learnt outside fold 2; `rejected` marks what identify() calls too far."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs))
    return found.select("doc_id", (fold() == 2).alias("held_out"), F.col("lang_nearest").alias("lang_pred"), "score", (F.col("lang_pred") != F.col("lang_nearest")).alias("rejected"))
