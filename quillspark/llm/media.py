"""Media columns: FLAC streams written from byte payloads, and read back as PCM blocks with sample offsets."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import flac
from quillspark.llm.common import steps, table, utf8

STEP = 2 << 20  # bytes of texts whose frames go through the codec together
UNIT = 64  # payloads are filled with bytes 0 up to a positive multiple of this


def payloads(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(offsets)
    ends = np.concatenate([[0], np.cumsum(np.maximum(1, -(-sizes // UNIT)) * UNIT)])
    out = np.zeros(ends[-1], np.uint8)
    out[np.arange(len(data)) + np.repeat(ends[:-1] - offsets[:-1], sizes)] = data
    return out, ends


def encode_flac(df: DataFrame, column: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each value's UTF-8 bytes (null: empty) as a FLAC stream of 8-bit samples: keys, n_bytes, media.

    The bytes are filled with 0 up to a positive multiple of 64; sample = byte - 128. A row for each
    input row: empty and null values give 64 samples, repeated rows repeat, an empty table gives an
    empty table, and columns other than the keys and the value are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(len(keys)))
            for a, b in steps(offsets, STEP):
                raw, ends = payloads(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                media, at = flac.encode((raw ^ 0x80).view(np.int8), ends)
                whole = media.tobytes()
                out = pa.array([whole[at[i] : at[i + 1]] for i in range(b - a)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(len(keys))), pa.array(np.diff(offsets[a : b + 1])), out], schema=schema)

    picked = df.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.col(column).alias("value"))
    fields = [f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(picked.schema.fields[:-1])]
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([*((f"k{i}", to_arrow_type(f.dataType)) for i, f in enumerate(picked.schema.fields[:-1])), ("n_bytes", pa.int64()), ("media", pa.binary())])
    out = picked.mapInArrow(run, ", ".join([*fields, "n_bytes bigint", "media binary"]))
    return out.toDF(*keys, "n_bytes", "media")


def decode_flac(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """PCM blocks of FLAC streams: key, block, sample_offset, n_samples, pcm (signed 8-bit).

    A frame is a block; every header, frame and stream checksum is verified, and a wrong one fails
    the query with its cause. Null streams give no blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets, STEP):
                pcm, ends, blocks = flac.decode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                raw = pcm.tobytes()
                rows = [(i, j, int(s), int(n)) for i, t in enumerate(blocks) for j, (s, n) in enumerate(t)]
                keys = batch.column(0).slice(a, b - a).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()), pa.array([raw[ends[i] + s : ends[i] + s + n] for i, _, s, n in rows], pa.binary())], names=["k", "block", "sample_offset", "n_samples", "pcm"])

    picked = media.select(F.col(key).alias("k"), F.col("media").alias("media")).where("media IS NOT NULL")
    kind = picked.schema["k"].dataType.simpleString()
    return picked.mapInArrow(run, f"k {kind}, block bigint, sample_offset bigint, n_samples bigint, pcm binary").withColumnRenamed("k", key)


def features(pcm: np.ndarray, ends: np.ndarray) -> list[str]:
    """Mean, root mean square, zero crossings a sample and peak of each range of samples, as text."""
    at, n = ends[:-1], np.diff(ends)
    x = pcm.astype(np.int64)
    mean, power = np.add.reduceat(x, at) / n, np.add.reduceat(x * x, at) / n
    cross = (np.signbit(pcm[1:]) != np.signbit(pcm[:-1])).astype(np.int64)
    cross = np.concatenate([cross, [0]])
    cross[ends[1:] - 1] = 0
    rate, peak = np.add.reduceat(cross, at) / n, np.maximum.reduceat(np.abs(x), at)
    return [f"mean={m:.4f};rms={p**0.5:.4f};zcr={z:.4f};peak={k}" for m, p, z, k in zip(mean.tolist(), power.tolist(), rate.tolist(), peak.tolist(), strict=True)]


def media_digests(media: DataFrame) -> DataFrame:
    """Decodes streams of encode_flac and describes what they hold; see op1_flac for the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in steps(offsets, STEP):
                part = data[offsets[a] : offsets[b]]
                at = offsets[a : b + 1] - offsets[a]
                pcm, ends, blocks = flac.decode(part, at)
                stored, raw = part.tobytes(), (pcm.view(np.uint8) ^ 0x80).tobytes()
                whole = [raw[ends[i] : ends[i + 1]] for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a),
                    batch.column(1).slice(a, b - a),
                    pa.array([len(x) for x in whole], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in whole]),
                    pa.array([zlib.crc32(x[-UNIT:]) for x in whole], pa.int64()),
                    pa.array(np.diff(at)),
                    pa.array([hashlib.sha256(stored[at[i] : at[i + 1]]).hexdigest() for i in range(b - a)]),
                    pa.array(features(pcm, ends)),
                    pa.array([len(t) for t in blocks], pa.int64()),
                ], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "blocks"])

    kind = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, blocks bigint")


def op1_flac(spark, sf_dir: str) -> DataFrame:
    """All documents' texts through FLAC and back: digests of payload and stream, and features of the samples."""
    return media_digests(encode_flac(table(spark, sf_dir, "documents").select("doc_id", "text")))
