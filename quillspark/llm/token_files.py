"""Token ids in ORC: integer run-length encoding, row indexes, and Bloom filters on document ids."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import scratch, steps, stored, table, utf8

END_ID = 1
STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1000
CACHE_CHUNKS = 600_000  # chunks whose ids a worker keeps
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


#: Chunks of these alone are cut into pre-tokens here: letters are in composed form, and there is no apostrophe.
PLAIN = re.compile(rb"(?:[\x21-\x26\x28-\x7e]|\xc3[\x80-\xbf])+")
PIECE = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, others follow from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + rest.index(b)) for b in range(256)]


class ChunkEncoder:
    """A lower-casing word-level BPE of the tokenizers library, asked once for each chunk between ASCII white space.

    The vocabulary drops white space, so a text's ids are its chunks' ids end to end. Chunks of
    plain letters, digits and signs are cut into pre-tokens here, each of which the library's model
    encodes once; other chunks, and texts that may hold special tokens, go to the library as they are.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def _ids(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            spelt = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
            got = self.pieces[piece] = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        return got

    def _learn(self, words: set[bytes]) -> None:
        if len(self.known) + len(words) > CACHE_CHUNKS:
            self.known.clear()
        if len(self.pieces) > CACHE_CHUNKS:
            self.pieces.clear()
        for w in words:
            self.known[w] = b"".join(map(self._piece, PIECE.findall(w.decode().lower()))) if PLAIN.fullmatch(w) else self._ids(w.decode())

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        out = []
        for text in texts:
            if b"<|" in text:
                out.append(self._ids(text.decode()))
                continue
            words = text.translate(LOWER).split()
            parts = list(map(self.known.get, words))
            if None in parts:
                holes = [i for i, p in enumerate(parts) if p is None]
                self._learn({words[i] for i in holes})
                for i in holes:
                    parts[i] = self.known[words[i]]
            out.append(b"".join(parts))
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def write_token_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Encodes each row's whole text (null: empty) and writes ORC files in ascending doc_id order.

    Columns: part (the file's place in the order), row (the place in the file), doc_id, ids (with the
    end id last). Files are ranges of doc_id of about equal row counts, by quantiles of the ids
    alone; rows without an id come first. Equal ids stand together in some fixed order. Stripes hold
    their columns' least and greatest values and a Bloom filter of doc_id, so a reader that looks
    for some ids skips the rest, and stripes of one file are read by different tasks. An empty table
    gives a folder without rows; columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    cuts = sorted(set(docs.select("doc_id").dropna().approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    bounds = F.array(*(F.lit(int(c)) for c in cuts)) if cuts else F.array().cast("array<bigint>")
    part = F.size(F.filter(bounds, lambda c: c <= F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder(vocabulary), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in steps(offsets):
                raw = data[offsets[a] : offsets[b]].tobytes()
                at = (offsets[a : b + 1] - offsets[a]).tolist()
                ids = enc.encode([raw[x:y] for x, y in zip(at, at[1:], strict=False)])
                sizes = np.array([len(x) // 4 + 1 for x in ids])
                flat = np.frombuffer(end.join([*ids, b""]), "<i4")
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.arange(row, row + b - a)), batch.column(1).slice(a, b - a), lists], names=["part", "row", "doc_id", "ids"])
                row += b - a

    dealt = docs.select(part.cast("int").alias("part"), "doc_id", "text").repartitionById(len(cuts) + 1, F.col("part"))
    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    encoded = ordered.mapInArrow(run, f"part int, row bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")
    encoded.write.option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", INDEX_STRIDE).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path)


def read_token_ids(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None, id_type: str = "bigint") -> DataFrame:
    """Rows of write_token_ids; with doc_ids, only stripes and row groups that may hold them are read."""
    df = spark.read.schema(f"part int, row bigint, doc_id {id_type}, ids array<int>").orc(path)
    return df if doc_ids is None else df.where(F.col("doc_id").isin(*doc_ids))


def token_digests(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            raw = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            at = ((ends - ends[0]) * 4).tolist()
            sums = pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(ends).astype(np.int64)), sums], names=["part", "row", "doc_id", "n_tokens", "ids_crc32"])

    kind = files.schema["doc_id"].dataType.simpleString()
    each = stored(files.select("part", "row", "doc_id", "ids").mapInArrow(run, f"part int, row bigint, doc_id {kind}, n_tokens bigint, ids_crc32 bigint"), "token_counts")
    # one row a file: its total, and with that what lies before it
    before = each.groupBy("part").agg(F.sum("n_tokens").alias("total")).select("part", F.coalesce(F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(W.partitionBy("part").orderBy("row").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n_tokens")
    return each.withColumn("inside", inside).join(before, "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def op6_orc(spark, sf_dir: str) -> DataFrame:
    """All documents' ids written to ORC in the shared folder, and read back."""
    import public_tokenizers

    path = scratch(spark, "tokens")
    write_token_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_digests(read_token_ids(spark, path))
