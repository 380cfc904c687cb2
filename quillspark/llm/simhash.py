"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import free, join_unique, steps, stored, table, utf8
from quillspark.llm.components import components
from quillspark.llm.shingle_sets import SIMILARITY, WORDS, similar

SHINGLE = 3
SEED = 42
RADIUS = 3
CROWD = 1000  # fingerprints with one key from which the key is split by the bytes of the other segment
DROPPED = 500_000  # dropped rows up to which they are broadcast; more are joined by a shuffle
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_bits(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text, as uint64."""
    counts = np.zeros(len(texts), np.int64)
    digests: list[bytes] = []
    digest = xxhash.xxh64_digest
    for i, text in enumerate(texts):
        words = text.translate(LOWER).split()
        n = len(words)
        if not n:
            continue
        joined = b" ".join(words)
        if n <= size:
            digests.append(digest(joined, SEED))
            counts[i] = 1
            continue
        starts = [0]
        at = 0
        for w in words:
            at += len(w) + 1
            starts.append(at)
        digests += [digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[size:], strict=False)]
        counts[i] = n - size + 1
    sums = np.zeros((len(texts), 64), np.int64)
    if digests:
        bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
        some = counts > 0
        at = np.cumsum(counts[some]) - counts[some]
        sums[some] = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    return np.packbits(2 * sums > counts[:, None], axis=1).view(">u8").astype(np.uint64).ravel()


def fingerprints(df: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (a long of the same bits) of each row's whole text; null and empty texts give 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets):
                raw = data[offsets[a] : offsets[b]].tobytes()
                at = (offsets[a : b + 1] - offsets[a]).tolist()
                bits = fingerprint_bits([raw[x:y] for x, y in zip(at, at[1:], strict=False)], size)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(bits.view(np.int64))], names=["doc_id", "fp"])

    return df.select("doc_id", "text").mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, fp bigint")


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column fp) that differ in RADIUS bits or fewer, each once.

    Multi-index hashing with two segments of 32 bits: of three differing bits, one segment holds at
    most one. Each fingerprint is in a table by each segment; it asks the table for its own segment
    and for those with one more bit set (of two that differ in a bit, one has it unset). A match is
    verified over all 64 bits, and counts for the second segment only where the first can't find it.
    """
    low = F.lit(0xFFFFFFFF)
    segments = [F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(low)]
    second = F.lit(1 << 32)  # marks keys of the second segment
    held = fps.select(F.col("fp").alias("b"), F.explode(F.array(segments[0], segments[1].bitwiseOR(second))).alias("key"))
    one_more = F.array(*(F.lit(1 << i) for i in range(32)))

    def ball(segment):
        return F.concat(F.array(segment), F.transform(F.filter(one_more, lambda m: segment.bitwiseAND(m) == 0), lambda m: segment.bitwiseOR(m)))

    asked = fps.select(F.col("fp").alias("a"), F.explode(F.concat(ball(segments[0]), F.transform(ball(segments[1]), lambda x: x.bitwiseOR(second)))).alias("key"))
    part = F.shiftrightunsigned("key", 32)
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.bit_count(F.shiftrightunsigned(differ, 32))
    own = F.when(part == 0, F.shiftrightunsigned("a", 32)).otherwise(F.col("a").bitwiseAND(low))
    exact = own == F.col("key").bitwiseAND(low)
    once = (~exact | (F.col("a") < F.col("b"))) & ((part == 0) | (first > 1))
    near = (F.col("a") != F.col("b")) & (F.bit_count(differ) <= RADIUS) & once
    crowded = held.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("key", F.lit(True).alias("crowded"))
    pairs = [side.join(crowded, "key", "left") for side in (asked, held)]
    # of the four bytes of the other segment three differing bits leave one alike; a pair counts by its first
    byte = lambda c, i: F.shiftrightunsigned(F.when(part == 0, F.col(c).bitwiseAND(low)).otherwise(F.shiftrightunsigned(c, 32)), 8 * i).bitwiseAND(F.lit(255))
    split = [rows.withColumn("sub", F.explode(F.when(F.col("crowded"), F.array(*(F.lit(i << 8).bitwiseOR(byte(c, i)) for i in range(4)))).otherwise(F.array(F.lit(-1).cast("long"))))).drop("crowded") for rows, c in zip(pairs, "ab", strict=True)]
    earlier = F.lit(False)
    for i in range(3):
        earlier = earlier | ((F.shiftright("sub", 8) > i) & (byte("a", i) == byte("b", i)))
    return split[0].join(split[1], ["key", "sub"]).where(near & ~((F.col("sub") >= 0) & earlier)).select("a", "b")


def near_duplicates(df: DataFrame) -> DataFrame:
    """doc_id, fp and component_id for each row of (doc_id, text): rows are in a component if a chain of links joins them.

    component_id is the smallest doc_id reachable. Rows without words have fingerprint 0 and link
    like others; equal texts share a fingerprint, which is one node whatever its rows; a null doc_id
    gets the smallest known id of its component, or null. An empty table gives an empty table;
    further columns are not read. Each fingerprint is linked once for all its rows, so a group of
    copies costs one node.
    """
    signed = stored(fingerprints(df), "fingerprints")
    nodes = stored(signed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    roots = components(links(nodes.select("fp")))
    linked = stored(roots.join(nodes, roots.node == nodes.fp).select("fp", "root", "least"), "roots")
    sizes = linked.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("n"))
    named = join_unique(linked, sizes, "root", linked.count()).select("fp", "component")
    every = nodes.join(named, "fp", "left").select("fp", "n", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component")).alias("component_id"))
    return join_unique(signed, stored(every, "components"), "fp", signed.count()).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group of near-duplicates stays. Columns are those of docs, which must have doc_id and text.

    Near-duplicates are texts whose sets of shingles of so many words have this Jaccard similarity or
    more, and chains of such (shingle_sets.similar). Fingerprints of the same shingles are linked by
    multi-index hashing, and what links is verified by the sets. At 0.8 about ten of 64 bits differ,
    beyond what RADIUS and segments reach, so a second index finds the pairs beyond. Rows are told apart by doc_id and a
    hash of all columns, so an id that stands on several texts loses none that is no duplicate. The
    survivor of a group is the row of the smallest doc_id, then the smallest hash; of rows that are
    alike in every column one stays. Null and empty texts are one group. Rows without a doc_id can't
    be named as the survivor and stay. Texts are never shuffled but for rows that are alike, and
    beyond DROPPED dropped rows.
    """
    row, gone_id, gone_row = (free(name, docs.columns) for name in ("_row", "_gone_id", "_gone_row"))
    marked = docs.withColumn(row, F.xxhash64(*docs.columns))
    rows = stored(similar(marked, size, similarity, row, links), "components")
    known = rows.where("doc_id IS NOT NULL")
    keep = known.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("k")).select("k.doc_id", "k.row")
    each = known.groupBy("doc_id", "row").agg(F.count("*").alias("n"))
    # a row that stays, but stands there several times, is dropped with the rest and put back once
    keep = keep.withColumn("kept", F.lit(True))
    gone = stored(each.join(keep, ["doc_id", "row"], "left").where("kept IS NULL OR n > 1").select(F.col("doc_id").alias(gone_id), F.col("row").alias(gone_row), "kept"), "dropped")
    small = F.broadcast if gone.count() <= DROPPED else lambda x: x
    same = lambda x: (marked["doc_id"] == x[gone_id]) & (marked[row] == x[gone_row])
    once = gone.where("kept")
    out = marked.join(small(gone), same(gone), "left_anti")
    if not once.isEmpty():
        out = out.unionByName(marked.join(small(once), same(once), "left_semi").dropDuplicates(["doc_id", row]))
    return out.select(*docs.columns)


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    near = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
