"""Near-duplicates by the Jaccard similarity of word shingle sets: links of SimHash fingerprints and a MinHash index find candidates, the sets verify them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import join_unique, steps, stored, tidy, utf8
from quillspark.llm.components import components
from quillspark.llm.features import LOWER, runs, spans_hash

WORDS = 5  # of a shingle
SIMILARITY = 0.8  # Jaccard
BANDS, ROWS = 32, 5  # a pair of exactly 0.8 has no band alike with a probability of (1 - 0.8 ** 5) ** 32, 3 in a million
SKETCH = BANDS * ROWS // 16  # longs of a set's sketch: four bits of each least hash
STARS = 6  # rounds at most in which buckets are compared with one member only, before all that is left is
CROWD = 4000  # members of a bucket, or rows of a shingle in prefixes, from which its pairs are dealt to several tasks
SHARED_NODES = 500_000  # nodes up to which their keys are broadcast to fetch texts; more are joined by a shuffle
SPARSE = 1000  # pairs left for each row of the index, up to which all are compared at once

_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_RANDOM = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text as hashes, and where each text's begin (and the last's end).

    Words are what blanks part, ASCII lower-cased; a text of fewer than size words is one shingle.
    """
    starts, ends, owner = runs(_WORD[data], offsets)
    words = spans_hash(LOWER[data], starts, ends)
    docs = len(offsets) - 1
    of = np.bincount(owner, minlength=docs)
    first = np.cumsum(of) - of
    h, own = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        if len(words) >= size:
            n = len(words) - size + 1
            h = np.zeros(n, np.uint64)
            for i in range(size):
                h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
            inside = owner[:n] == owner[size - 1 :]
            h, own = h[inside], owner[:n][inside]
        for d in np.flatnonzero((of > 0) & (of < size)).tolist():
            x = np.uint64(of[d])
            for w in words[first[d] : first[d] + of[d]]:
                x = x * np.uint64(0x9E3779B97F4A7C15) + w
            h, own = np.append(h, x), np.append(own, d)
    h = _mixed(h)
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    h, own = h[new], own[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=docs))]).astype(np.int64)


def signatures(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of each text's set (0: empty), and BANDS keys and a sketch of those that have one."""
    some = np.diff(at) > 0
    node, begin = np.zeros(len(at) - 1, np.uint64), at[:-1][some]
    keys, sketch = np.zeros((len(begin), BANDS), np.uint64), np.zeros((len(begin), SKETCH), np.uint64)
    if not len(begin):
        return node, keys, sketch
    with np.errstate(over="ignore"):
        node[some] = _mixed(np.add.reduceat(_mixed(h ^ np.uint64(0x5851F42D4C957F2D)), begin) + np.diff(at)[some].astype(np.uint64))
        for i in range(BANDS * ROWS):
            least = np.minimum.reduceat((h ^ _RANDOM[0, i]) * _RANDOM[1, i], begin)
            keys[:, i // ROWS] = _mixed(keys[:, i // ROWS] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(i))
            sketch[:, i // 16] |= (_mixed(least) & np.uint64(15)) << np.uint64(4 * (i % 16))
    return node, keys, sketch


def set_fingerprints(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The SimHash fingerprint of each set, as uint64: a bit is 1 if set in over half of its shingles. Empty sets give 0."""
    out, some = np.zeros(len(at) - 1, np.uint64), np.diff(at) > 0
    if some.any():
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, at[:-1][some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * sums > np.diff(at)[some][:, None], axis=1).view(">u8").astype(np.uint64).ravel()
    return out


def signed(df: DataFrame, size: int = WORDS, row: str | None = None) -> DataFrame:
    """doc_id, row (that column, or a hash of both), node (a hash of the text's shingle set; null and empty texts: 0), n (its shingles), fp (its fingerprint), keys (one a band) and sketch of each row."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in steps(offsets):
                h, at = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                node, *parts = signatures(h, at)
                lists = []
                for part in parts:
                    ends = np.concatenate([[0], np.cumsum(np.where(np.diff(at) > 0, part.shape[1], 0))]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(part.ravel().view(np.int64))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(node.view(np.int64)), pa.array(np.diff(at)), pa.array(set_fingerprints(h, at).view(np.int64)), *lists], names=["doc_id", "row", "node", "n", "fp", "keys", "sketch"])

    mark = F.xxhash64("doc_id", "text") if row is None else F.col(row)
    return df.select("doc_id", mark.alias("row"), "text").mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, row bigint, node bigint, n bigint, fp bigint, keys array<bigint>, sketch array<bigint>")


_SKETCH = [f"s{i}" for i in range(SKETCH)]


def _apart(asked: str, other: str) -> Column:
    """How many bits of the sketches differ; each is columns of longs, which keeps the join's condition small enough to be compiled."""
    out = F.lit(0)
    for name in _SKETCH:
        out = out + F.bit_count(F.col(asked + name).bitwiseXOR(F.col(other + name)))
    return out


def most_apart(similarity: float) -> float:
    """Bits of sketches that differ in a pair of this similarity, at most: the mean and five and a half deviations.

    A least hash that differs (1 - similarity of them do) has two of its four bits differ, on average; the
    square has a mean of five.
    """
    n, p = 16 * SKETCH, 1 - similarity
    return 2 * n * p + 5.5 * (n * (5 * p - 4 * p * p)) ** 0.5


def parities(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SKETCH longs of each set: 64 * SKETCH bits, each of whether an odd number of its shingles fall there.

    Two sets differ in as many shingles as bits at least, since each shingle that one of them holds turns one bit.
    """
    wide, rows = 64 * SKETCH, len(at) - 1
    own = np.repeat(np.arange(rows), np.diff(at))
    odd = np.bincount(own * wide + (h % np.uint64(wide)).astype(np.int64), minlength=rows * wide) & 1
    return np.packbits(odd.astype(np.uint8).reshape(rows, wide), axis=1).view(np.int64)


def _sets(df: DataFrame, size: int) -> DataFrame:
    """node, its shingles, and the longs of their parities, of (node, text)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets):
                h, at = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                odd = np.ascontiguousarray(parities(h, at).T)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64))), *map(pa.array, odd)], names=["node", "shingles", *_SKETCH])

    return df.select("node", "text").mapInArrow(run, f"node bigint, shingles array<bigint>, {', '.join(f'{name} bigint' for name in _SKETCH)}")


def prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """node, n, key (a shingle) and at of the shingles by which sets (node, shingles) can be joined without losing a pair of this similarity.

    Shingles stand in order of how many of the sets hold them, rarest first; at is the place in its set.
    Of two sets so similar the first shingle in common is within the first n - similarity * n + 1 of
    both. One that a single set holds is in no pair, so it takes a place but no row: a text with
    that many edits of its own has no rows.
    """
    each = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    often = each.groupBy("key").agg(F.count("*").alias("f")).where("f > 1")
    common = each.join(often, "key").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("f", "key"))).alias("common"))
    alone = F.col("n") - F.size("common")
    places = F.col("n") - F.ceil(similarity * F.col("n") - 1e-9).cast("int") + 1
    rows = common.select("node", "n", alone.alias("alone"), F.posexplode(F.slice("common", F.lit(1), F.greatest(places - alone, F.lit(0)))).alias("i", "s"))
    return rows.select("node", "n", F.col("s.key").alias("key"), (F.col("alone") + F.col("i")).alias("at"))


def _unjoined(held: DataFrame, now: DataFrame) -> DataFrame:
    """The rows of held whose key is in more than one component of now, with c, the key's rows, and m, those of its largest component, most."""
    placed = held.join(now, "node")
    part = placed.groupBy("key", "c").agg(F.count("*").alias("m"))
    mixed = part.groupBy("key").agg(F.sum("m").alias("rows"), F.max(F.struct("m", "c")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    return placed.join(mixed.select("key", "rows", F.col("top.m").alias("m"), F.col("top.c").alias("most")), "key")


def _linked(nodes: DataFrame, links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs (a, b) of nodes: those that stand for two linked fingerprints, and each other node with the one that stands for its fingerprint."""
    known = nodes.where("n > 0").select("node", "fp")
    lead = stored(known.groupBy("fp").agg(F.min("node").alias("lead")), "fingerprints")
    one, two = (lead.select(F.col("fp").alias(x), F.col("lead").alias("lead_" + x)) for x in "ab")
    far = links(lead.select("fp")).join(one, "a").join(two, "b").select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b"))
    return far.union(known.join(lead, "fp").where("node <> lead").select("node", "lead"))


def _joined(now: DataFrame, pairs: DataFrame, sets: DataFrame, similarity: float, tasks: int) -> DataFrame:
    """now (node and component c), the components of those pairs (a, b, and their components ca, cb) joined whose sets are so similar."""
    one, two = (sets.select(F.col("node").alias(x), F.col("shingles").alias("s" + x)) for x in "ab")
    rows_of = pairs.repartition(tasks, "a", "b").join(one, "a").join(two, "b")
    both = rows_of.select("ca", "cb", F.size(F.array_intersect("sa", "sb")).alias("both"), (F.size("sa") + F.size("sb")).alias("sizes"))
    good = stored(both.where(F.col("both") >= similarity * (F.col("sizes") - F.col("both"))).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "similar")
    roots = components(good).select(F.col("node").alias("c"), "root")
    return stored(now.join(roots, "c", "left").select("node", F.coalesce("root", "c").alias("c")), "places")


def similar(df: DataFrame, size: int = WORDS, similarity: float = SIMILARITY, row: str | None = None, links: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """doc_id, row, node, root and component_id for each row of (doc_id, text): rows are in a component if a chain of pairs of this Jaccard similarity or more joins them.

    component_id is the smallest doc_id reachable (null where none is known); root names the component,
    also where ids repeat. row is the column that tells rows apart, a hash of both where none is
    given. Equal sets are one node; null and empty texts are one. An empty table gives an empty table.
    links, where given, takes a table of different fingerprints (fp) and gives the pairs (a, b) of
    those that are near; the sets of such pairs, and of equal fingerprints, are verified and joined
    first. Fingerprints see only the nearest pairs, so a second index follows for the others, whose
    candidates share a key of a band. While buckets are large each is compared with one member, which
    joins a large group of copies in as many pairs as it has rows; sketches within that join drop pairs
    that are far from alike. In the end all sets of buckets that are in two components are joined by
    their rarest shingles (prefixes) and compared by parities, which both leave out no pair of the
    similarity, and few others: a group whose members are all a little too far apart has candidates
    by the square of its size, but hardly a rare shingle in common. What is left is verified by the
    sets. Found pairs are links between components, so a round works on those only.
    """
    rows = stored(signed(df, size, row), "signed")
    # the row that stands for a node is one of a smallest hash, so its text can be fetched by a key that no other node has
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.min(F.struct("row", "n", "fp", "keys", "sketch")).alias("s"))
    nodes = stored(nodes.select("node", "least", "copies", "s.row", "s.n", "s.fp", "s.keys", "s.sketch"), "nodes")
    index = nodes.select("node", F.explode("keys").alias("key"))
    shared = index.join(index.groupBy("key").count().where("count > 1").select("key"), "key")
    held = stored(shared.join(nodes.select("node", "n", *(F.get("sketch", F.lit(i)).alias(name) for i, name in enumerate(_SKETCH))), "node"), "buckets")
    wanted = held.select("node")
    if links is not None:
        linked = stored(_linked(nodes, links), "linked")
        wanted = wanted.union(linked.select("a")).union(linked.select("b"))
    chosen = stored(nodes.join(wanted.distinct(), "node", "left_semi").select("row", "node"), "chosen")
    now = chosen.select("node", F.col("node").alias("c"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not chosen.isEmpty():
        mark = F.xxhash64("doc_id", "text") if row is None else F.col(row)
        near = F.broadcast(chosen) if chosen.count() <= SHARED_NODES else chosen
        again = df.select(mark.alias("row"), "text").join(near, "row").select("node", "text")
        sets = stored(_sets(again, size), "shingles")
        if sets.count() > chosen.count():  # rows that are alike gave a node's set more than once
            sets = stored(sets.dropDuplicates(["node"]), "sets")
        if links is not None and not linked.isEmpty():
            now = _joined(now, linked.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb")), sets, similarity, tasks)
    last = held.isEmpty()
    turn = 0
    while not last:
        placed = stored(_unjoined(held, now), "placed")
        weight = placed.groupBy("key").agg(F.first("rows").alias("rows"), F.first("m").alias("m")).agg(F.sum(F.col("rows") * (F.col("rows") - F.col("m"))), F.sum("rows")).first()
        if not weight[1]:
            break
        last = turn == STARS or (turn > 0 and weight[0] <= SPARSE * weight[1])
        names = [F.col("node").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"), *(F.col(name).alias("other_" + name) for name in _SKETCH)]
        # sets of sizes further apart can't be so similar
        fits = (F.col("c") != F.col("cb")) & (F.least("n", "nb") >= similarity * F.greatest("n", "nb"))
        if last:
            some = sets.join(placed.select("node").distinct(), "node", "left_semi")
            placed = stored(_unjoined(prefixes(some, similarity).join(sets.select("node", *_SKETCH), "node"), now), "prefixes")
            names.append(F.col("at").alias("at_b"))
            # both sets hold as many shingles from their first common one on, at most, and differ in as many as their parities, at least
            most, sizes = F.least(F.col("n") - F.col("at"), F.col("nb") - F.col("at_b")), F.col("n") + F.col("nb")
            fits = fits & ((1 + similarity) * most >= similarity * sizes - 1e-6) & ((1 + similarity) * _apart("", "other_") <= (1 - similarity) * sizes + 1e-6)
            deal = F.ceil(F.col("rows") / CROWD).cast("long")
            other = placed.where("c <> most").select("key", F.pmod(F.xxhash64("node"), deal).alias("deal"), *names)
            asked = placed.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), deal - 1)))
        else:
            fits = fits & (_apart("", "other_") <= most_apart(similarity))
            lead = placed.groupBy("key").agg(F.min_by(F.struct(*names), F.xxhash64("node", F.lit(turn))).alias("l"))
            other = lead.select("key", F.lit(0).cast("long").alias("deal"), "l.*")
            asked = placed.withColumn("deal", F.lit(0).cast("long"))
        # little data, much work: both are dealt to all tasks, whatever their bytes
        pairs = asked.repartition(tasks, "key", "deal").join(other.repartition(tasks, "key", "deal"), ["key", "deal"]).where(fits)
        pairs = stored(pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"), F.least("c", "cb").alias("ca"), F.greatest("c", "cb").alias("cb")).distinct(), "pairs")
        now = _joined(now, pairs, sets, similarity, tasks)
        turn += 1
    every = nodes.join(now, "node", "left").select("node", "least", "copies", F.coalesce("c", "node").alias("root"))
    named = every.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    placed = join_unique(every, named, "root", nodes.count()).select("node", "root", "component_id", F.col("copies").alias("n"))
    return join_unique(rows.select("doc_id", "row", "node"), stored(placed, "places"), "node", rows.count()).select("doc_id", "row", "node", "root", "component_id")
