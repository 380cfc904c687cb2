"""SentencePiece encoding and decoding by a weighted transducer, with exact results for models trained by pair merges.

The transducer is normaliser o pieces: spaces become the space mark (one before the text), runs of
letters that are a piece become its id, and a letter without a piece becomes its UTF-8 bytes' ids.
A model of merges is no sum of weights of pieces. But its segmentation is the only path in which
each two neighbours, taken alone, stay as they are; so arcs join only such neighbours, each arc
weighs one, and the tropical shortest path through the text is the model's own. Since each prefix of
a text has one such path, a position's state is its last piece.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.common import steps, table, tidy, utf8

MARK = "▁"
CACHE_CHUNKS = 400_000  # chunks whose ids a task keeps
CACHE_PAIRS = 1_000_000
LETTER = 1 << 21


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            value = raw[at : at + size]
            at += size
        yield tag >> 3, value


class Transducer:
    """Compiled from a model file: pieces with their ranks, the bytes' ids, and the normaliser's switches."""

    def __init__(self, path: str) -> None:
        import struct

        with open(path, "rb") as f:
            raw = f.read()
        self.spelt: list[bytes] = []  # what each id decodes to
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        self.prefix, self.unknown = True, 0
        for field, value in _fields(raw):
            if field == 1:
                piece, score, kind = "", 0.0, 1
                for f, v in _fields(value):
                    if f == 1:
                        piece = v.decode()
                    elif f == 2:
                        score = struct.unpack("<f", v)[0]
                    elif f == 3:
                        kind = v
                me = len(self.spelt)
                if kind == 6:
                    self.byte[int(piece[3:5], 16)] = me
                    self.spelt.append(bytes([int(piece[3:5], 16)]))
                elif kind == 1:
                    self.id[piece], self.rank[piece] = me, score
                    self.spelt.append(piece.replace(MARK, " ").encode())
                else:
                    self.unknown = me if kind == 2 else self.unknown
                    self.spelt.append(b" \xe2\x81\x87 " if kind == 2 else b"")
            elif field == 2:
                trainer = {f: v for f, v in _fields(value)}
                if trainer.get(3, 1) != 2:
                    raise ValueError("only models of pair merges are compiled")
            elif field == 3:
                rules = {f: v for f, v in _fields(value)}
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("only the identity normaliser that keeps spaces is compiled")
                self.prefix = bool(rules.get(3, 1))
        # pieces hold the mark in front only, and never a line's end: chunks between those are apart
        if any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in self.id):
            raise ValueError("pieces cross the ends of words")
        # a trie of the pieces that are whole by themselves; key 0 of a node holds the piece that ends there
        self.trie: dict = {}
        for piece, me in self.id.items():
            if len(piece) == 1 or len(self.merged(piece)) == 1:
                node = self.trie
                for c in piece:
                    node = node.setdefault(c, {})
                node[0] = me
        # neighbours that some piece holds: between others a chunk can be cut
        self.inner = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.piece = {me: piece for piece, me in self.id.items()}
        self.newline = self._path("\n")

    def merged(self, text: str) -> list[str]:
        """The model's own segmentation, by merges of the best pair; used on pieces and pairs of them."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r > best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stays(self, left: int, right: int) -> bool:
        """Whether two states that follow each other stay apart; a letter without a piece is state LETTER + its code."""
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()
        x, y = (chr(i - LETTER) if i >= LETTER else self.piece[i] for i in (left, right))
        got = self.pairs[left << 22 | right] = self.merged(x + y) == [x, y]
        return got

    def _path(self, chunk: str) -> bytes:
        """The shortest path through a chunk, as little-endian unsigned 32-bit ids.

        A place keeps the least weight of the arcs that reach it, and its last arc; arcs that can't lessen it are not tried.
        """
        n = len(chunk)
        state, start, weight = [-1] * (n + 1), [0] * (n + 1), [0] + [n + 1] * n
        pairs, root = self.pairs, self.trie
        for i in range(n):
            before, w = state[i], weight[i] + 1
            if i and before < 0:
                continue
            node, j = root, i
            while j < n:
                node = node.get(chunk[j])
                j += 1
                if node is None:
                    if j > i + 1:
                        break
                    me = LETTER + ord(chunk[i])
                else:
                    me = node.get(0, -1)
                    if me < 0 and j == i + 1:
                        me = LETTER + ord(chunk[i])
                if me >= 0 and w < weight[j]:
                    stays = pairs.get(before << 22 | me) if i else True
                    if stays is None:
                        stays = self._stays(before, me)
                    if stays:
                        state[j], start[j], weight[j] = me, i, w
                if node is None:
                    break
        out: list[int] = []
        j = n
        while j:
            me = state[j]
            if me < LETTER:
                out.append(me)
            elif self.byte:
                out += [self.byte[b] for b in reversed(chr(me - LETTER).encode())]
            else:
                out.append(self.unknown)
            j = start[j]
        return array("I", out[::-1]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        got = self.known.get(chunk)
        if got is None:
            if len(self.known) > CACHE_CHUNKS:
                self.known.clear()
            cuts = [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in self.inner]
            if cuts:
                got = b"".join(self._chunk(chunk[a:b]) for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True))
            else:
                got = self._path(chunk)
            self.known[chunk] = got
        return got

    def forget(self) -> None:
        """Frees the chunks' ids and the pairs. A worker outlives its task, and what it keeps takes memory from other operators."""
        self.known.clear()
        self.pairs.clear()

    def encode(self, text: str) -> bytes:
        """Ids of the text, as little-endian unsigned 32-bit integers. The empty text has none."""
        if not text:
            return b""
        out: list[bytes] = []
        get, chunk = self.known.get, self._chunk
        # a text's own mark is the same letter as a space's
        lines = (MARK + text if self.prefix else text).replace(" ", MARK).split("\n")
        for n, line in enumerate(lines):
            if n:
                out.append(self.newline)
            if not line:
                continue
            words = line.replace(MARK, " " + MARK).split(" ")
            if not words[0]:
                del words[0]
            if MARK in words:  # runs of marks belong to the word after them
                joined, held = [], ""
                for w in words:
                    if w == MARK:
                        held += w
                    else:
                        joined.append(held + w)
                        held = ""
                words = [*joined, held] if held else joined
            ids = list(map(get, words))
            if None in ids:
                ids = [chunk(w) if i is None else i for w, i in zip(words, ids, strict=True)]
            out += ids
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of such ids."""
        raw = b"".join(map(self.spelt.__getitem__, array("I", ids)))
        if self.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode(errors="replace")


_COMPILED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32, n_chars, round_trip for each row of (doc_id, text).

    round_trip: decoding the ids gives the text back. A null or empty text has no ids. model is a path
    that every executor has. Repeated rows repeat; an empty table gives an empty table; other columns
    are not read.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets):
                raw = data[offsets[a] : offsets[b]].tobytes()
                at = (offsets[a : b + 1] - offsets[a]).tolist()
                texts = [raw[x:y].decode() for x, y in zip(at, at[1:], strict=False)]
                ids = [t.encode(x) for x in texts]
                columns = {"doc_id": batch.column(0).slice(a, b - a)}
                ends = [0]
                for x in ids:
                    ends.append(ends[-1] + len(x) // 4)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))]))
                columns["n_tokens"] = pa.array([len(x) // 4 for x in ids], pa.int64())
                columns["ids_crc32"] = pa.array([zlib.crc32(x) for x in ids], pa.int64())
                columns["n_chars"] = pa.array(list(map(len, texts)), pa.int64())
                columns["round_trip"] = pa.array([t.decode(x) == y for x, y in zip(ids, texts, strict=True)])
                yield pa.RecordBatch.from_pydict(columns)
        t.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, n_tokens bigint, ids_crc32 bigint, n_chars bigint, round_trip boolean")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text for each row of (doc_id, ids); null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            texts = [t.decode(array("I", x or []).tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def op7_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every document's ids, their counts and checksums, and whether they decode to its text."""
    import public_tokenizers

    return encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
