"""Benchmark decontamination by template windows: numbers, units and names are typed slots, whose values must agree.

A window of WINDOW words is hashed under three readings: as a template in which a capitalised word
that opens a sentence is a word, as one in which it is a name, and as plain lower-cased words. Items
that are short, or dense with slots, also have the template and the words of the whole item.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import free, steps, stored, table, utf8
from quillspark.llm.features import LETTER, LOWER, runs, spans_hash

WINDOW = 5  # words
LITERALS = 3  # words of a template window that are no slots, at least
WHOLE = 4  # words of an item whose whole template is searched, at least
SIMILARITY = 0.8  # share of an item's windows that a document has
AGREEMENT = 0.8  # share of slot values that map to one value
SHARED_WINDOWS = 2_000_000  # benchmark hashes up to which documents are filtered by a broadcast table of them
SHARED_KEYS = 500_000  # rows of benchmark windows up to which they are broadcast; more are joined by a shuffle

# Words that count as units after a number, and words that are numbers.
UNITS = """kg g mg km m cm mm lb lbs oz mile miles foot feet inch inches hour hours minute minutes second seconds day days
week weeks month months year years dollar dollars euro euros cent cents percent litre litres liter liters degree degrees
kwh watt watts volt volts pound pounds ton tons""".split()
NUMBERS = """zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen""".split()
NUMBER, UNIT, NAME = (np.uint64(i) for i in (1, 2, 3))
PLAIN, TEMPLATE, WHOLE_PLAIN, WHOLE_TEMPLATE = range(4)  # kinds of keys

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WORD = LETTER | _DIGIT
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:\n|")] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SIGN = np.random.default_rng(8).integers(1, 1 << 62, 256, dtype=np.uint64)  # of a sign between words
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = runs(_WORD[data], np.array([0, len(data)]))
    return np.sort(spans_hash(data, starts, ends))


_UNITS, _NUMBERS = _hashes(UNITS), _hashes(NUMBERS)


def _among(value: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    return sorted_[np.minimum(np.searchsorted(sorted_, value), len(sorted_) - 1)] == value


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """The words of some texts: the text of each, its value's hash, the signs before it, and its slot type under both readings of openers."""

    owner: np.ndarray
    value: np.ndarray
    signs: np.ndarray
    strict: np.ndarray
    loose: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words are runs of letters and digits, lower-cased; a point or comma between digits belongs to its number.

    One that begins with a digit, or is one of NUMBERS, is a number; a unit is one of UNITS after a
    number; a name is a capitalised word. Openers are names in the loose reading only.
    """
    lower, upper = LOWER[data], _UPPER[data]
    word = _WORD[data]
    if len(data) > 1:
        # capital letters of Latin-1 in UTF-8
        second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        lower[1:][second] += 0x20
        upper[:-1] |= second
        digit = _DIGIT[data]
        word[1:-1] |= digit[:-2] & digit[2:] & ((data[1:-1] == 46) | (data[1:-1] == 44))
    starts, ends, owner = runs(word, offsets)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return Words(np.zeros(0, np.int64), none, none, none, none)
    value = spans_hash(lower, starts, ends)
    number = _DIGIT[data[starts]] | _among(value, _NUMBERS)
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    unit = np.concatenate([[False], number[:-1]]) & ~first & _among(value, _UNITS)
    stops = np.concatenate([[0], np.cumsum(_STOP[data], dtype=np.int32)])
    before = np.concatenate([[0], ends[:-1]])
    opens = first | (stops[starts] > stops[before])
    capitals = np.concatenate([[0], np.cumsum(upper, dtype=np.int32)])
    name = upper[starts] & (capitals[ends] - capitals[starts] == 1) & (ends - starts > 1)
    with np.errstate(over="ignore"):
        sign = np.concatenate([[np.uint64(0)], np.cumsum(np.where(word | _BLANK[data], np.uint64(0), _SIGN[data]))])
        signs = sign[starts] - sign[before]
    strict, loose = (np.select([number, unit, n], [NUMBER, UNIT, NAME], np.uint64(0)) for n in (name & ~opens, name))
    return Words(owner, value, signs, strict, loose)


def _rolling(code: np.ndarray, size: int) -> np.ndarray:
    n = len(code) - size + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = out * _BASE + (code[i : i + n] ^ (code[i : i + n] >> np.uint64(31)))
    return _mixed(out)


def windows(w: Words, lengths: tuple[int, ...] = ()) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, size, first word, hash, slot types): windows of WINDOW words under each reading, and windows of these lengths as whole items.

    Signs count within a whole template only, where few literal words would say too little.
    """
    readings = [(PLAIN, None), (TEMPLATE, w.loose), (TEMPLATE, w.strict)]
    if lengths:
        readings += [(WHOLE_PLAIN, None), (WHOLE_TEMPLATE, w.loose), (WHOLE_TEMPLATE, w.strict)]
    for kind, slots in readings:
        code = w.value if slots is None else np.where(slots > 0, slots, w.value)
        literal = None if slots is None else np.concatenate([[0], np.cumsum(slots == 0)])
        for size in (WINDOW,) if kind in (PLAIN, TEMPLATE) else lengths:
            n = len(code) - size + 1
            if n < 1 or (kind == WHOLE_TEMPLATE and size < WHOLE):
                continue
            good = w.owner[:n] == w.owner[size - 1 :]
            if literal is not None:
                good &= literal[size:] - literal[:n] >= (LITERALS if kind == TEMPLATE else 1)
            first = np.flatnonzero(good)
            if kind == WHOLE_TEMPLATE:
                h = _whole(code, w.signs, size)[first]
            else:
                h = _rolling(code, size)[first]
            with np.errstate(over="ignore"):
                yield kind, size, first, _mixed(h + np.uint64(kind * 1000003 + size)), slots


def _whole(code: np.ndarray, signs: np.ndarray, size: int) -> np.ndarray:
    """Hashes of so many words and the signs between them."""
    n = len(code) - size + 1
    out = code[:n].copy()
    with np.errstate(over="ignore"):
        for i in range(1, size):
            out = (out ^ (out >> np.uint64(31))) * _BASE + (code[i : i + n] + _mixed(signs[i : i + n]))
    return _mixed(out)


def template_windows(texts: DataFrame, key: str, wanted: np.ndarray | None = None, lengths: tuple[int, ...] = (), items: bool = False) -> DataFrame:
    """Rows (key, part, kind, pos, hash, slots, words): a window's kind, first word, hash, and the values' hashes of its slots.

    part tells apart rows of equal key, words is the text's count. With wanted (sorted hashes) only
    windows with such a hash are given. items: whole windows are those of each text's own length.
    Null and empty texts have no windows; repeated rows repeat theirs; an empty table gives an empty table.
    """
    shared = texts.sparkSession.sparkContext.broadcast(wanted)  # at most SHARED_WINDOWS hashes
    schema = f"k {texts.schema[key].dataType.simpleString()}, part bigint, kind int, pos bigint, hash bigint, slots array<bigint>, words bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = shared.value
        if want is not None:
            quick = np.zeros(1 << 22, bool)
            quick[(want >> np.uint64(42)).astype(np.int64)] = True
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in steps(offsets, rows=1 if items else 1 << 30):
                w = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                of = np.bincount(w.owner, minlength=b - a)
                begin, shaped = np.cumsum(of) - of, np.zeros(0, np.int64)
                for kind, size, first, hashes, slots in windows(w, (len(w.owner),) * (len(w.owner) > 0) if items else lengths):
                    if items and kind == TEMPLATE and slots is w.loose:
                        shaped = first
                    elif items and kind == TEMPLATE:  # a window that only its opener makes literal enough finds no other name there
                        keep = np.isin(first, shaped)
                        first, hashes = first[keep], hashes[keep]
                    if want is not None:
                        maybe = np.flatnonzero(quick[(hashes >> np.uint64(42)).astype(np.int64)])
                        keep = maybe[_among(hashes[maybe], want)] if len(want) else maybe[:0]
                        first, hashes = first[keep], hashes[keep]
                    if not len(first):
                        continue
                    owner = w.owner[first]
                    if slots is None:
                        lists = pa.ListArray.from_arrays(pa.array(np.zeros(len(first) + 1, np.int32)), pa.array([], pa.int64()))
                    else:
                        cells = first[:, None] + np.arange(size)
                        slot = slots[cells] > 0
                        ends = np.concatenate([[0], np.cumsum(slot.sum(1))]).astype(np.int32)
                        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(w.value[cells][slot].view(np.int64)))
                    take = pa.array(owner + a)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(np.full(len(first), kind, np.int32)), pa.array(first - begin[owner]), pa.array(hashes.view(np.int64)), lists, pa.array(of[owner])], names=["k", "part", "kind", "pos", "hash", "slots", "words"])

    rows = texts.select(F.col(key).alias("k"), F.xxhash64("text").alias("part"), "text")
    return rows.mapInArrow(run, schema).withColumnRenamed("k", key)


def item_keys(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_part, kind, pos, hash, item_slots, windows): the keys by which each item is searched.

    By kind, windows is how many different windows the item has. Template windows are used where at
    least half of the item's windows have one; other items of WHOLE words or more have their whole
    template. Items of fewer than WINDOW words have their whole words; those of one or two words too,
    and a document holds them where they are all its words.
    """
    rows = template_windows(benchmark.where("item_id IS NOT NULL").select("item_id", "text"), "item_id", items=True).withColumnRenamed("part", "item_part")
    item = ["item_id", "item_part"]
    rows = stored(rows.dropDuplicates([*item, "kind", "pos", "hash"]), "item_rows")
    sizes = rows.groupBy(*item).agg(F.count_distinct(F.when(F.col("kind") == TEMPLATE, F.col("pos"))).alias("templates"))
    rows = rows.join(sizes, item)
    dense = F.col("templates") * 2 < F.col("words") - (WINDOW - 1)
    short = F.col("words") < WINDOW
    use = F.when(F.col("kind") == PLAIN, True).when(F.col("kind") == TEMPLATE, ~dense).when(F.col("kind") == WHOLE_PLAIN, short).otherwise(short | dense)
    rows = rows.where(use)
    count = rows.groupBy(*item, "kind").agg(F.count_distinct("pos").alias("windows"))
    return stored(rows.join(count, [*item, "kind"]).select(*item, "kind", "pos", "hash", F.col("slots").alias("item_slots"), "windows", "words"), "item_keys")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds: doc_id, item_id, similarity, agreement, reparameterised, part.

    similarity is the share of the item's windows that the document has (SIMILARITY or more), as plain
    words or as templates; agreement the share of slot values that go where most of the same item value
    go (AGREEMENT or more), in the occurrence of each window that agrees best. reparameterised tells
    that the item is there as a template only; where its words are there too it is false and
    agreement 1. part is the text's hash, which tells apart rows of one doc_id. Null and empty texts
    hold nothing, null items are not searched, repeated rows are one pair, empty tables give an empty
    table, other columns are not read.

    A document that has so many of an item's windows has one at least among any fifth and one of
    them, so pairs are sought by the item's rarest windows only, and all windows are compared for the
    pairs that are found. A beginning that many items share is no such window.
    """
    items = item_keys(benchmark)
    hashes = items.select("hash").distinct()
    wanted = None
    if hashes.count() <= SHARED_WINDOWS:
        wanted = np.sort(np.array([r.hash for r in hashes.toLocalIterator()], np.int64).view(np.uint64))
    # lengths of items, at most as many as the longest item has words
    lengths = tuple(sorted(r.words for r in items.where(F.col("kind") >= WHOLE_PLAIN).select("words").distinct().collect()))
    seen = template_windows(docs.select("doc_id", "text"), "doc_id", wanted, lengths)
    seen = stored(seen.groupBy("doc_id", "part", "kind", "hash", "words").agg(F.collect_set("slots").alias("held")), "seen_windows")
    item, doc = ["item_id", "item_part"], ["doc_id", "part"]
    often = items.groupBy("kind", "hash").agg(F.count_distinct("item_id").alias("often"))
    rare = items.join(often, ["kind", "hash"]).groupBy(*item, "kind", "windows", "pos").agg(F.sum("often").alias("often"), F.collect_set("hash").alias("hs"))
    nth = F.row_number().over(W.partitionBy(*item, "kind").orderBy("often", "pos"))
    # a window is a task's group of one item, which is one text
    rare = rare.withColumn("nth", nth).where(F.col("nth") <= F.floor(F.col("windows") * (1 - SIMILARITY) + 1e-9) + 1).select(*item, "kind", F.explode("hs").alias("hash")).distinct()
    rare, keys = stored(rare, "rare_windows"), items.select(*item, "kind", "pos", "hash", "item_slots", "windows", F.col("words").alias("item_words"))
    few = F.broadcast if items.count() <= SHARED_KEYS else lambda x: x
    pairs = seen.join(few(rare), ["kind", "hash"]).select(*doc, *item, "kind").distinct()
    pairs = stored(pairs, "candidate_pairs")
    same_doc = [seen[c].eqNullSafe(pairs[c]) for c in (*doc, "kind")]
    both = seen.join(pairs, same_doc[0] & same_doc[1] & same_doc[2]).select(*(pairs[c] for c in (*doc, *item, "kind")), "hash", "held", "words")
    found = both.join(few(keys), [*item, "kind", "hash"])
    # one or two words must be the whole document
    found = found.where((F.col("item_words") > 2) | (F.col("words") == F.col("item_words")))
    found = stored(found.select(*doc, *item, "kind", "pos", "windows", "item_slots", "held"), "matched_windows")
    pair = [*doc, *item]
    covered = found.groupBy(*pair, "kind").agg(F.count_distinct("pos").alias("n"), F.first("windows").alias("windows")).withColumn("similarity", F.col("n") / F.col("windows")).where(F.col("similarity") >= SIMILARITY)
    plain = covered.where(F.col("kind").isin(PLAIN, WHOLE_PLAIN)).groupBy(*pair).agg(F.max("similarity").alias("similarity"))
    template = covered.where(F.col("kind").isin(TEMPLATE, WHOLE_TEMPLATE)).select(*pair, "kind", "similarity")
    good = _null_safe(found, template, [*pair, "kind"])
    # (item's value, document's value) of each slot of each occurrence; the value that most go to is right
    each = good.select(*pair, "kind", "similarity", "pos", F.explode("held").alias("slots"), "item_slots").where(F.size("slots") == F.size("item_slots"))
    each = stored(each.withColumn("occurrence", F.xxhash64("slots", "item_slots")), "occurrences")
    values = each.select(*pair, "kind", "pos", "occurrence", F.explode(F.arrays_zip("item_slots", "slots")).alias("s")).select(*pair, "kind", "pos", "occurrence", F.col("s.item_slots").alias("v"), F.col("s.slots").alias("w"))
    votes = values.groupBy(*pair, "kind", "v", "w").agg(F.count_distinct("pos").alias("n"))
    most = votes.groupBy(*pair, "kind", "v").agg(F.max_by("w", F.struct("n", F.col("w") == F.col("v"), "w")).alias("to"))
    judged = _null_safe(values, most, [*pair, "kind", "v"]).groupBy(*pair, "kind", "pos", "occurrence").agg(F.count_if(F.col("w") == F.col("to")).alias("right"), F.count("*").alias("all"))
    best = judged.groupBy(*pair, "kind", "pos").agg(F.max_by(F.struct("right", "all"), F.col("right") / F.col("all")).alias("b"))
    agree = best.groupBy(*pair, "kind").agg((F.sum("b.right") / F.sum("b.all")).alias("agreement"))
    shaped = _null_safe(template, agree, [*pair, "kind"], "left").withColumn("agreement", F.coalesce("agreement", F.lit(1.0))).where(F.col("agreement") >= AGREEMENT)
    verbatim = plain.select(*pair, "similarity", F.lit(1.0).alias("agreement"), F.lit(False).alias("reparameterised"))
    out = verbatim.unionByName(shaped.select(*pair, "similarity", "agreement", F.lit(True).alias("reparameterised")))
    out = out.groupBy(*doc, "item_id").agg(F.min_by(F.struct("similarity", "agreement", "reparameterised"), F.struct("reparameterised", -F.col("similarity"), -F.col("agreement"))).alias("b"))
    return out.select("doc_id", "part", "item_id", "b.similarity", "b.agreement", "b.reparameterised")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by keys that may be null; columns of left, and what right has besides."""
    r = right.select(*(F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns))
    on = F.lit(True)
    for c in keys:
        on = on & left[c].eqNullSafe(r[f"_{c}"])
    return left.join(r, on, how).drop(*(f"_{c}" for c in keys))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with the columns of docs.

    A row goes if its own doc_id and text do, so other texts of an id stay; null ids and texts are
    rows like others. An empty table of either kind changes nothing.
    """
    bad_id, bad_part = (free(name, docs.columns) for name in ("_bad_id", "_bad_part"))
    bad = stored(contaminated(docs, benchmark).select(F.col("doc_id").alias(bad_id), F.col("part").alias(bad_part)).distinct(), "contaminated")
    near = F.broadcast(bad) if bad.count() <= SHARED_KEYS else bad
    return docs.join(near, docs["doc_id"].eqNullSafe(bad[bad_id]) & (F.xxhash64(docs["text"]) == bad[bad_part]), "left_anti")


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds, as it is or with other values."""
    found = contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), F.max("agreement").alias("agreement"), F.min("reparameterised").alias("reparameterised"))
