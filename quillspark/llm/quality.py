"""Quality by co-training: a text-content and a page-metadata classifier teach each other, and both score all documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import draw, steps, stored, table, utf8
from quillspark.llm.features import LOWER, grams, unit

WIDTH = 1024  # hashed n-grams of the content view
LABELLED = 3000  # labelled rows of each class at most
ROUNDS = 4
TAUGHT = 150  # texts that a view labels for the other in a round, dealt to the classes by their share of the labelled rows
SURE = 1.0  # log odds from which a view's opinion is a pseudo-label
KEEP = 0.4  # quality from which a document stays
ROWS = 1024


def content_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed n-grams of what the text says, case apart, at length 1."""
    return unit(np.sqrt(grams(LOWER[data], offsets, WIDTH, (1, 2)).astype(np.float32)))


def metadata_view(data: np.ndarray, offsets: np.ndarray, source: list, lang: list, n_chars: list) -> np.ndarray:
    """What is known of a page apart from its words: source, declared language and size, and its layout."""
    n = np.diff(offsets).astype(float)
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    safe = np.maximum(n, 1)
    lines = total(data == 10) + 1
    spaces = total((data == 32) | (data == 10))
    upper, digit = total((data >= 65) & (data <= 90)), total((data >= 48) & (data <= 57))
    letter = total(((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128))
    declared = np.array([np.nan if c is None else float(c) for c in n_chars])
    gap = np.log1p(np.abs(np.nan_to_num(declared, nan=0.0) - n) / safe)
    numbers = np.stack([np.log1p(n) / 10, np.log1p(lines) / 5, np.log1p(n / lines) / 8, spaces / safe * 4, upper / safe * 4, digit / safe * 8, (n - letter - digit - spaces) / safe * 4, n / (spaces + 1) / 10, np.isnan(declared), np.minimum(gap, 3)], 1)
    hashed = np.zeros((len(n), 64), np.float32)
    for column, base, size in ((source, 0, 48), (lang, 48, 16)):
        seen: dict = {}
        for i, value in enumerate(column):
            if value not in seen:
                seen[value] = -1 if value is None else base + zlib.crc32(value.encode()) * size // (1 << 32)
            if seen[value] >= 0:
                hashed[i, seen[value]] = 0.5
    return np.concatenate([numbers.astype(np.float32), numbers.astype(np.float32) ** 2, hashed], 1)


class Logistic:
    """Ridge logistic regression, by damped gradient steps with momentum."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float = 4.0, rounds: int = 250, ridge: float = 1e-4) -> None:
        self.mean = x.mean(0)
        self.scale = 1 / (x.std(0) + 0.02)
        # one copy of x, changed in place: this runs on the driver
        z = x - self.mean
        z *= self.scale
        lengths = np.concatenate([np.sqrt((z[a : a + ROWS] ** 2).sum(1)) for a in range(0, len(z), ROWS)])
        self.size = max(1.0, float(lengths.mean()))
        z /= self.size
        w, b, v, vb = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0
        weight = (weight / weight.sum()).astype(np.float32)
        for _ in range(rounds):
            g = weight * (1 / (1 + np.exp(-(z @ w + b))) - y)
            v = 0.9 * v + z.T @ g + ridge * w
            vb = 0.9 * vb + g.sum()
            w, b = w - rate * v, b - rate * vb
        self.w, self.b = (w * self.scale / self.size).astype(np.float32), float(b - (self.mean * self.scale / self.size) @ w)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b


def _balanced(y: np.ndarray) -> np.ndarray:
    one = max(1.0, float((y > 0.5).sum()))
    return np.where(y > 0.5, len(y) / one, len(y) / max(1.0, len(y) - one)).astype(np.float32)


def _calibrate(odds: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve of y over the odds; a weak ridge keeps separable cases finite."""
    x, p = np.stack([odds, np.ones(len(odds))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        z = 1 / (1 + np.exp(-np.clip(x @ p, -50, 50)))
        g = x.T @ (weight * (z - np.clip(y, 1e-3, 1 - 1e-3))) + 1e-3 * p
        h = (x * (weight * z * (1 - z))[:, None]).T @ x + np.diag([1e-3, 1e-3])
        p = p - np.clip(np.linalg.solve(h, g), -2, 2)
    return float(max(p[0], 1e-3)), float(p[1])


class CoTrained:
    """Two views' classifiers, fitted to the labelled rows and to what the other view has taught, each calibrated and weighed.

    taught holds (text, meta, label) of pseudo-labels that each view has got so far.
    """

    def __init__(self, text: np.ndarray, meta: np.ndarray, y: np.ndarray, taught: list[tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None) -> None:
        # every fourth labelled row is kept for calibration
        held = np.arange(len(y)) % 4 == 3
        if not (len(set(y[held].tolist())) == 2 and len(set(y[~held].tolist())) == 2):
            held = np.zeros(len(y), bool)
        train_y = y[~held].astype(np.float32)
        self.share = float(train_y.mean())
        self.models = []
        for i, x in enumerate((text, meta)):
            own, ys = x[~held], train_y
            if taught is not None and len(taught[i][2]):
                own, ys = np.concatenate([own, taught[i][i]]), np.concatenate([ys, taught[i][2].astype(np.float32)])
            weight = _balanced(ys)
            weight[len(train_y) :] *= 0.5
            self.models.append(Logistic(own, ys, weight))
        use = held if held.any() else np.ones(len(y), bool)
        weight = np.ones(int(use.sum()))
        odds = [m.odds(x[use]) for m, x in zip(self.models, (text, meta), strict=True)]
        self.curves = [_calibrate(z, y[use].astype(float), weight) for z in odds]
        sides = [s * z + o for (s, o), z in zip(self.curves, odds, strict=True)]
        loss = [float(np.log1p(np.exp(-np.where(y[use] > 0.5, z, -z))).mean()) + 1e-3 for z in sides]
        self.trust = [1 / x / sum(1 / q for q in loss) for x in loss]

    def quotas(self) -> tuple[int, int]:
        """Pseudo-labels of 0 and of 1 that a view gives in a round, at most."""
        return max(1, round(TAUGHT * (1 - self.share))), max(1, round(TAUGHT * self.share))

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        odds = [np.clip(s * m.odds(x) + o, -30, 30) for (s, o), m, x in zip(self.curves, self.models, (text, meta), strict=True)]
        p = lambda z: 1 / (1 + np.exp(-z.astype(float)))
        return p(odds[0]), p(odds[1]), p(sum(t * z for t, z in zip(self.trust, odds, strict=True)))


def _views(batch: pa.RecordBatch, first: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(batch.column(first))
    source, lang, size = (batch.column(first + i).to_pylist() for i in (1, 2, 3))
    for a, b in steps(offsets, rows=ROWS):
        part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        yield a, b, content_view(part, at), metadata_view(part, at, source[a:b], lang[a:b], size[a:b])


def _labelled(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, list]:
    """Vectors of both views, labels and ids of at most LABELLED rows of each class, in a fixed order."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct().withColumn("draw", draw())
    chosen = [usable.where(F.col("quality") == y).orderBy("draw", "doc_id").limit(LABELLED) for y in (0, 1)]

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, text, meta in _views(batch, 2):
                both = np.concatenate([text, meta], 1).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([r.tobytes() for r in both], pa.binary())], names=["doc_id", "quality", "vector"])

    # bounded by LABELLED rows of a class
    picked = F.broadcast(chosen[0].union(chosen[1]).select("doc_id", "quality"))
    texts = docs.select("doc_id", "text", "source", "lang", "n_chars").join(picked, "doc_id")
    rows = texts.select("doc_id", "quality", "text", "source", "lang", "n_chars").mapInArrow(vectors, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, quality int, vector binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["vector"]))
    x = np.zeros((len(rows), len(rows[0]["vector"]) // 4 if rows else 0), np.float32)
    for i, r in enumerate(rows):  # a vector's bytes go once they are copied
        x[i] = np.frombuffer(r.pop("vector"), np.float32)
    return x, np.array([r["quality"] for r in rows], int), [r["doc_id"] for r in rows]


def _confident(docs: DataFrame, model: CoTrained, known: list) -> list[dict]:
    """Of all documents but the known ones, the texts of which each view is surest, its quota for each label, with their vectors.

    Each task keeps its own best; the best of those follow by a top-k, so what is gathered is bounded
    by the quotas. A text counts once, whatever its copies; ties go by the text's hash.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, frozenset(known)))

    def best(rows: list[tuple], quota: int) -> list[tuple]:
        out: dict = {}
        for r in sorted(rows, key=lambda r: r[:2]):
            out.setdefault(r[1], r)
            if len(out) == quota:
                break
        return list(out.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, skip = shared.value
        held: dict[tuple[int, int], list[tuple]] = {(view, label): [] for view in (0, 1) for label in (0, 1)}
        for batch in batches:
            new = np.array([i not in skip for i in batch.column(0).to_pylist()], bool)
            mark = batch.column(1).to_numpy()
            for a, b, text, meta in _views(batch, 2):
                for view, (classifier, x) in enumerate(zip(m.models, (text, meta), strict=True)):
                    odds = classifier.odds(x)
                    for label in (0, 1):
                        rank = odds if label == 0 else -odds
                        mine, quota = held[view, label], m.quotas()[label]
                        limit = min(-SURE, mine[-1][0] if len(mine) >= quota else -SURE)
                        sure = np.flatnonzero(new[a:b] & (rank <= limit))
                        if len(sure):
                            more = [(float(rank[i]), int(mark[a + i]), text[i].tobytes(), meta[i].astype(np.float32).tobytes()) for i in sure[np.argsort(rank[sure], kind="stable")][: 8 * quota]]
                            held[view, label] = best(mine + more, quota)
        rows = [(view, label, *r) for (view, label), rs in held.items() for r in rs]
        for a in range(0, len(rows), 64):
            view, label, rank, mark, text, meta = zip(*rows[a : a + 64], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(view, pa.int32()), pa.array(label, pa.int32()), pa.array(rank, pa.float64()), pa.array(mark, pa.int64()), pa.array(text, pa.binary()), pa.array(meta, pa.binary())], names=["view", "label", "rank", "mark", "text", "meta"])

    sources = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text", "source", "lang", "n_chars")
    local = stored(sources.mapInArrow(run, "view int, label int, rank double, mark bigint, text binary, meta binary"), "confident")
    out = []
    for view in (0, 1):
        for label in (0, 1):
            quota = model.quotas()[label]
            own = local.where((F.col("view") == view) & (F.col("label") == label)).groupBy("mark").agg(F.min(F.struct("rank", "text", "meta")).alias("r"))
            out += [{"view": view, "label": label, **r.asDict()} for r in own.select("mark", "r.*").orderBy("rank", "mark").limit(quota).collect()]
    return out


def fit(docs: DataFrame, labels: DataFrame) -> CoTrained | None:
    """The two classifiers, from at most LABELLED rows of each class, and ROUNDS rounds over all other documents.

    In a round each view scores all documents, and the texts that it is surest of (TAUGHT) become
    pseudo-labels of the other view. None where labels of a class are missing; null ids and other
    labels are left out.
    """
    x, y, ids = _labelled(docs, labels)
    if len(set(y.tolist())) < 2:
        return None
    text, meta = x[:, :WIDTH], x[:, WIDTH:]
    got: list[dict[int, tuple]] = [{}, {}]  # by view that learns: text's hash -> vectors and label
    model = CoTrained(text, meta, y)
    for _ in range(ROUNDS):
        before = [len(g) for g in got]
        for r in _confident(docs, model, ids):
            vectors = (np.frombuffer(r["text"], np.float32), np.frombuffer(r["meta"], np.float32), r["label"])
            got[1 - r["view"]].setdefault(r["mark"], vectors)
        if [len(g) for g in got] == before:
            break
        taught = [tuple(np.stack([v[i] for v in g.values()]) if g else np.zeros((0, w), np.float32) for i, w in enumerate((text.shape[1], meta.shape[1]))) + (np.array([v[2] for v in g.values()]),) for g in got]
        model = CoTrained(text, meta, y, taught)
    return model


def score_quality(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """docs with score_text, score_meta and quality (0 to 1, all three) added.

    A null text counts as empty; null source, lang and n_chars are values of their own. Without a
    model (labels of one class only, or none) all three are 1. Repeated rows repeat; an empty table
    gives an empty table; further columns pass through; a column that has one of the added names raises.
    """
    if {c.lower() for c in docs.columns} & {"score_text", "score_meta", "quality"}:
        raise ValueError("the columns score_text, score_meta and quality are added, so docs must not have them")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH numbers and a few

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = [*docs_columns, "score_text", "score_meta", "quality"]
        for batch in batches:
            own = pa.RecordBatch.from_arrays([batch.column(docs_columns.index(c)) for c in ("text", "source", "lang", "n_chars")], names=["text", "source", "lang", "n_chars"])
            for a, b, text, meta in _views(own, 0):
                got = m.score(text, meta) if m else (np.ones(b - a),) * 3
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *map(pa.array, got)], names=names)

    docs_columns = docs.columns
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*(StructField(f.name, f.dataType) for f in docs.schema.fields), *(StructField(n, DoubleType()) for n in ("score_text", "score_meta", "quality"))])
    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of quality KEEP or more: doc_id, text, lang, source and n_chars of each.

    Nulls in any column, empty texts and repeated rows are scored like others; an empty table gives an
    empty table; without labels of both classes all stay.
    """
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    kept = score_quality(base, fit(base, labels)).where(F.col("quality") >= KEEP)
    return kept.select("doc_id", "text", "lang", "source", "n_chars")


def op9_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's quality by both views and together, and whether it stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    scored = score_quality(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "score_text", "score_meta", F.col("quality").alias("score"), (F.col("quality") >= KEEP).alias("keep"))
