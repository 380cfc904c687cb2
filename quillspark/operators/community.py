"""Communities of a graph by distributed local moving, and what they are about."""

from __future__ import annotations

import random
import warnings

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.text import truthy
from quillspark.session import stored

#: Bounds that a run isn't meant to reach: it ends when nothing moves and modularity no longer rises, and warns otherwise.
LEVELS, SWEEPS = 20, 60
SMALL = 200_000  # edges of a level's graph up to which one task finishes it; larger levels are swept by all
STARTS, LAZY = 8, 6  # orders that such a task tries, of which the best is taken; sweeps in which half of the nodes stay
IDLE = 3  # sweeps without a move in a row that end a level
LABELS, TITLES = 15, 8  # of a community's description


def _stored(df: DataFrame) -> DataFrame:
    return stored(df, "community")


def _by_shuffle(rows: DataFrame, other: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join without a broadcast: those of the sweeps are many, and each would go through the driver."""
    return rows.join(other.hint("merge"), key, how)


def modularity(edges: DataFrame, labels: DataFrame) -> float:
    """Of (a, b, w) edges, each pair once, loops with their whole weight, under labels (node, c)."""
    la, lb = labels.select(F.col("node").alias("a"), F.col("c").alias("ca")), labels.select(F.col("node").alias("b"), F.col("c").alias("cb"))
    both = _by_shuffle(_by_shuffle(edges, la, "a"), lb, "b")
    m, inside = both.agg(F.sum("w"), F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w")))).first()
    if not m:
        return 0.0
    inside = inside or 0.0
    ends = both.select(F.col("ca").alias("c"), "w").union(both.select("cb", "w")).groupBy("c").agg(F.sum("w").alias("d"))
    return float(inside / m - (ends.agg(F.sum(F.col("d") * F.col("d"))).first()[0] / (4 * m * m)))


def _local_moves(edges: DataFrame, sweeps: int) -> DataFrame:
    """Labels (node, c) after sweeps in which half of the nodes, by a fixed draw, move to the neighbouring community of the greatest gain."""
    arcs = _stored(edges.where("a <> b").select("a", "b", "w").union(edges.where("a <> b").select("b", "a", "w")).union(edges.where("a = b").select("a", "b", (2 * F.col("w")).alias("w"))).toDF("u", "v", "w"))
    degree = _stored(arcs.groupBy("u").agg(F.sum("w").alias("k")))
    two_m = degree.agg(F.sum("k")).first()[0]
    labels = degree.select(F.col("u").alias("node"), F.col("u").alias("c"), "k")
    idle = 0
    for sweep in range(sweeps):
        totals = labels.groupBy(F.col("c").alias("to")).agg(F.sum("k").alias("t"))
        toward = _by_shuffle(arcs.where("u <> v"), labels.select(F.col("node").alias("v"), F.col("c").alias("to")), "v").groupBy("u", "to").agg(F.sum("w").alias("w"))
        options = _by_shuffle(_by_shuffle(toward, totals, "to"), labels.select(F.col("node").alias("u"), "c", "k"), "u")
        # the node's own weight doesn't count in its own community
        other = F.col("t") - F.when(F.col("to") == F.col("c"), F.col("k")).otherwise(0.0)
        gain = F.round(F.col("w") - F.col("k") * other / two_m, 9)
        best = options.select("u", "c", "to", gain.alias("g")).groupBy("u").agg(F.max_by(F.struct("to", "g"), F.struct("g", F.col("to") == F.col("c"), -F.xxhash64("to"))).alias("b"), F.max(F.when(F.col("to") == F.col("c"), F.col("g"))).alias("own"), F.first("c").alias("c"))
        stay = F.coalesce("own", F.lit(0.0))
        moves = best.where((F.col("b.to") != F.col("c")) & (F.col("b.g") > stay + 1e-9) & (F.pmod(F.xxhash64("u", F.lit(sweep)), F.lit(2)) == 0)).select(F.col("u").alias("node"), F.col("b.to").alias("next"))
        labels = _stored(_by_shuffle(labels, moves, "node", "left").select("node", F.coalesce("next", "c").alias("c"), "k", F.col("next").isNotNull().alias("moved")))
        moved = labels.where("moved").count()
        labels = labels.drop("moved")
        # each node's turn comes in one of any few sweeps, so one idle sweep isn't the end
        idle = 0 if moved else idle + 1
        if idle == IDLE:
            break
    else:
        warnings.warn(f"nodes still move after {sweeps} sweeps", stacklevel=2)
    return labels.drop("k")


def _in_order(edges: list[tuple], seed: int) -> dict:
    """node -> community of weighted edges (a, b, w), loops with their whole weight: nodes move to where modularity gains most, level by level, until none does.

    The seed draws the order of the nodes, and in which of the first sweeps half of them stay: early
    moves are made on little knowledge.
    """
    draw = random.Random(seed)
    m = sum(w for *_, w in edges)
    weight = {(a, b): w for a, b, w in edges}
    place: dict = {}
    while True:
        around: dict = {}
        degree: dict = {}
        for (a, b), w in weight.items():
            for x in (a, b):  # a loop counts at both of its ends
                degree[x] = degree.get(x, 0.0) + w
            if a != b:
                around.setdefault(a, []).append((b, w))
                around.setdefault(b, []).append((a, w))
        order = sorted(degree)
        own, total = {x: x for x in order}, dict(degree)
        draw.shuffle(order)
        ever, moved, sweep = False, True, 0
        while moved:
            moved, sweep = False, sweep + 1
            for x in order:
                if sweep <= LAZY and draw.random() < 0.5:
                    moved = True
                    continue
                home, k = own[x], degree[x]
                total[home] -= k
                toward = {home: 0.0}
                for y, w in around.get(x, ()):
                    toward[own[y]] = toward.get(own[y], 0.0) + w
                gain = {c: w - k * total[c] / (2 * m) for c, w in toward.items()}
                best = min(gain, key=lambda c: (-round(gain[c], 9), c != home, c))
                if best != home and gain[best] > gain[home] + 1e-9:
                    own[x], moved, ever = best, True, True
                total[own[x]] += k
        place = {x: own[c] for x, c in place.items()} if place else own
        if not ever:
            return place
        merged: dict = {}
        for (a, b), w in weight.items():
            key = min(own[a], own[b]), max(own[a], own[b])
            merged[key] = merged.get(key, 0.0) + w
        weight = merged


def _gain(edges: list[tuple], place: dict) -> float:
    """Modularity."""
    m, inside, ends = sum(w for *_, w in edges), 0.0, {}
    for a, b, w in edges:
        inside += w * (place[a] == place[b])
        for x in (place[a], place[b]):
            ends[x] = ends.get(x, 0.0) + w
    return inside / m - sum(d * d for d in ends.values()) / (4 * m * m)


def _finish(edges: DataFrame) -> DataFrame:
    """Labels (node, c) of a graph of at most SMALL edges, by one task."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(rows: pa.Table) -> pa.Table:
        every = sorted(zip(*(rows[c].to_pylist() for c in ("a", "b", "w")), strict=True))
        place = max((_in_order(every, seed) for seed in range(STARTS)), key=lambda p: _gain(every, p))
        return pa.table({"node": pa.array(list(place), rows.schema.field("a").type), "c": pa.array(list(place.values()), rows.schema.field("a").type)})

    return edges.select("a", "b", F.col("w").cast("double").alias("w"), F.lit(0).alias("_all")).groupBy("_all").applyInArrow(run, f"node {kind}, c {kind}")


def communities(edges: DataFrame, levels: int = LEVELS, sweeps: int = SWEEPS) -> DataFrame:
    """(node, community_id) of an undirected simple graph (a, b): local moving, then the same over communities as nodes.

    A level whose graph has at most SMALL edges is finished by one task, in order of the nodes; larger
    levels are swept by all. It follows modularity at resolution 1, with draws that are a function of the node, so a run repeats.
    A level that doesn't better modularity is not taken. Ids are 0, 1, ... by the least node. No edges, no communities.
    """
    base = _stored(edges.select("a", "b", F.lit(1.0).alias("w")))
    if base.isEmpty():
        return base.select(F.col("a").alias("node"), F.lit(0).cast("long").alias("community_id")).limit(0)
    now, labels, best = base, None, -1.0
    for _ in range(levels):
        small = now.count() <= SMALL
        moved = _stored(_finish(now)) if small else _local_moves(now, sweeps)
        tried = moved if labels is None else _stored(_by_shuffle(labels, moved.toDF("c", "c2"), "c").select("node", F.col("c2").alias("c")))
        q = modularity(base, tried)
        if q <= best + 1e-6:
            break
        labels, best = tried, q
        if small:
            break
        x, y = moved.toDF("a", "ca"), moved.toDF("b", "cb")
        now = _stored(_by_shuffle(_by_shuffle(now, x, "a"), y, "b").groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("w").alias("w")))
    else:
        warnings.warn(f"modularity still rises after {levels} levels", stacklevel=2)
    names = labels.groupBy("c").agg(F.min("node").alias("first"))
    return labels.join(_numbered(names, "first", "community_id"), "c").select("node", "community_id")


def _numbered(rows: DataFrame, by: str, name: str) -> DataFrame:
    """rows with 0, 1, ... in order of a column: places within ranges of it, after the counts of the ranges before."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _stored(rows.repartitionByRange(parts, by).withColumn("_part", F.spark_partition_id()))
    # a row a range
    before = dealt.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    inside = F.row_number().over(W.partitionBy("_part").orderBy(by)) - 1
    return dealt.withColumn("_inside", inside).join(before, "_part").select(*rows.columns, (F.col("_before") + F.col("_inside")).cast("long").alias(name))


def label_propagation(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """(node, c): each node takes the most frequent label around it, ties by the least label."""
    arcs = _stored(edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v"))
    labels = arcs.select(F.col("u").alias("node")).distinct().withColumn("c", F.col("node"))
    for _ in range(rounds):
        votes = arcs.join(labels, arcs.v == labels.node).groupBy("u", "c").count()
        labels = _stored(votes.groupBy(F.col("u").alias("node")).agg(F.max_by("c", F.struct("count", -F.xxhash64("c"))).alias("c")))
    return labels


def describe(assigned: DataFrame, documents: DataFrame) -> DataFrame:
    """(community_id, topic_labels, representative_documents, summary): names and titles in order, the first 15 and 8."""
    titles = documents.select(F.concat(F.lit("doc:"), "id").alias("node"), F.coalesce(truthy("title_en", "title_ar"), "id").alias("title"))
    rows = assigned.join(titles, "node", "left").select("community_id", F.when(F.col("node").startswith("topic:"), F.substring("node", 7, 1 << 30)).alias("label"), "title")
    # the first of each community's labels and titles: the limit applies before the shuffle, so no community is gathered whole
    firsts = [
        rows.where(F.col(c).isNotNull()).select("community_id", F.col(c).alias("value")).withColumn("nth", F.row_number().over(W.partitionBy("community_id").orderBy("value"))).where(F.col("nth") <= n)
        .groupBy("community_id").agg(F.array_sort(F.collect_list("value")).alias(name)) for c, n, name in (("label", LABELS, "labels"), ("title", TITLES, "titles"))
    ]
    none = F.array().cast("array<string>")
    gathered = rows.select("community_id").distinct().join(firsts[0], "community_id", "left").join(firsts[1], "community_id", "left").select("community_id", F.coalesce("labels", none).alias("labels"), F.coalesce("titles", none).alias("titles"))
    join = lambda c, n, by: F.array_join(F.slice(c, 1, n), by)
    summary = F.when(F.size("labels") > 0, F.concat(F.lit("Community around "), join("labels", 5, ", "), F.lit("."))).when(F.size("titles") > 0, F.concat(F.lit("Community around documents: "), join("titles", 3, "; "), F.lit("."))).otherwise("Sparse community with insufficient topic or document labels.")
    return gathered.select("community_id", F.slice("labels", 1, 15).alias("topic_labels"), F.slice("titles", 1, 8).alias("representative_documents"), summary.alias("summary"))


def assignments(assigned: DataFrame, described: DataFrame) -> DataFrame:
    """(node, community_id, topic_labels, community_summary): a row a node, with its community's first ten labels."""
    facts = described.select("community_id", F.slice("topic_labels", 1, 10).alias("topic_labels"), F.col("summary").alias("community_summary"))
    return assigned.join(facts, "community_id").select("node", "community_id", "topic_labels", "community_summary")
