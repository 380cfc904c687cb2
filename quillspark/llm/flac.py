"""A FLAC codec for 8-bit mono, in numpy: all frames of a batch go through each step together.

The encoder tries constant and verbatim subframes, the fixed predictors of order 0-4 and a
quantised linear predictor, and codes residuals in Rice partitions. The decoder walks all frames
of a batch in lockstep, one sample a step, restores the predictors the same way, and verifies the
CRC-8 of each header, the CRC-16 of each frame and the MD5 of the samples.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

from quillspark.llm.common import ranges

BLOCK = 1024  # samples a frame
PARTITIONS = 2  # log2 of the Rice partitions of a full frame
LPC_ORDER = 4
PRECISION = 12
SAMPLE_RATE = 8000

# Fixed values of the format: coefficients of its fixed predictors by order.
FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


def _crc_table(poly: int, width: int, bits: int) -> np.ndarray:
    """For each value of so many leading bits: what `bits` shifts make of it."""
    x = np.arange(1 << bits, dtype=np.int64) << (width - bits)
    for _ in range(bits):
        x = np.where(x >> (width - 1) & 1, (x << 1) ^ poly, x << 1) & ((1 << width) - 1)
    return x.astype(np.int32)


CRC8 = _crc_table(0x07, 8, 8)
CRC16 = _crc_table(0x8005, 16, 8)
CRC16_PAIR = _crc_table(0x8005, 16, 16)
LEADING = np.full(1 << 16, 16, np.uint8)
for _z in range(15, -1, -1):
    LEADING[1 << (15 - _z) : 1 << (16 - _z)] = _z


def crc8(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    crc = np.zeros(len(starts), np.int32)
    for i in range(int(lengths.max(initial=0))):
        on = lengths > i
        crc[on] = CRC8[crc[on] ^ buf[starts[on] + i]]
    return crc


def crc16(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Longest first, so that the ranges still running are a prefix."""
    order = np.argsort(-lengths, kind="stable")
    s, n = starts[order], lengths[order]
    crc = np.zeros(len(s), np.int32)
    wide = buf.astype(np.int32)
    pair = (wide[:-1] << 8) | wide[1:] if len(buf) > 1 else np.zeros(0, np.int32)
    live = np.searchsorted(-(n // 2), -np.arange(1, int(n.max(initial=0)) // 2 + 1), "right")
    for i, m in enumerate(live):
        crc[:m] = CRC16_PAIR[crc[:m] ^ pair[s[:m] + 2 * i]]
    odd = (n & 1) == 1
    crc[odd] = ((crc[odd] << 8) & 0xFFFF) ^ CRC16[(crc[odd] >> 8) ^ buf[s[odd] + n[odd] - 1]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


class _Bits:
    """Gathers (bit position, value, width <= 16) and adds them into bytes at once; fields don't overlap."""

    def __init__(self) -> None:
        self.fields: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def put(self, at: np.ndarray, value: np.ndarray, width: np.ndarray | int) -> None:
        at = np.asarray(at, np.int64)
        self.fields.append((at, np.broadcast_to(np.asarray(value, np.int32), at.shape), np.broadcast_to(np.asarray(width, np.int32), at.shape)))

    def bytes(self, size: int) -> np.ndarray:
        out = np.zeros(size + 3)
        for at, value, width in self.fields:
            if not len(at):
                continue
            first = at >> 3
            word = (value & ((1 << width) - 1)) << (24 - width - (at & 7).astype(np.int32))
            low, span = int(first.min()), int(first.max() - first.min()) + 1
            first -= low
            for k in range(3):
                out[low + k : low + k + span] += np.bincount(first, (word >> (16 - 8 * k)) & 255, span)
        return out[:size].astype(np.uint8)


def _rice(u: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best parameter and its bits for each partition; u has so many values of each, end to end."""
    at = np.cumsum(each) - each
    cost = np.stack([np.add.reduceat(u >> k, at).astype(np.int64) + each * (k + 1) for k in range(11)])
    k = cost.argmin(0)
    return k.astype(np.int32), cost[k, np.arange(len(each))]


def _lpc(x: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients and shifts by autocorrelation, for rows of samples."""
    f = x.astype(np.float32)
    r = np.stack([np.einsum("ij,ij->i", f[:, lag:], f[:, : f.shape[1] - lag]) for lag in range(order + 1)], 1).astype(np.float64)
    a, err = np.zeros((len(x), order)), r[:, 0] * (1 + 1e-9) + 1e-9
    for i in range(order):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / err
        a[:, :i] = a[:, :i] - k[:, None] * a[:, :i][:, ::-1]
        a[:, i] = k
        err = np.maximum(err * (1 - k * k), 1e-9)
    top = (1 << (PRECISION - 1)) - 1
    shift = np.clip(np.floor(np.log2(top / np.maximum(np.abs(a).max(1), 1e-6))), 0, 15).astype(np.int64)
    return np.clip(np.round(a * (1 << shift)[:, None]), -top, top).astype(np.int64), shift


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each range of signed samples (int8) as a FLAC stream. Ranges are of 16 samples or more.

    Returns the bytes of all streams and their offsets.
    """
    sizes = np.diff(offsets)
    docs = len(sizes)
    frames = -(-sizes // BLOCK)
    total = int(frames.sum())
    of_doc, number = np.repeat(np.arange(docs), frames), ranges(frames)
    start = offsets[:-1][of_doc] + number * BLOCK
    n = np.minimum(BLOCK, offsets[1:][of_doc] - start)
    column = np.arange(BLOCK)
    inside = column < n[:, None]
    x = np.where(inside, data[np.minimum(start[:, None] + column, len(data) - 1)], 0).astype(np.int32)

    best, residual, order = np.abs(x, dtype=np.int32).sum(1), x, np.zeros(total, np.int64)
    d = x
    for o in range(1, 5):
        d = np.concatenate([np.zeros((total, 1), np.int32), d[:, 1:] - d[:, :-1]], 1)
        d[:, :o] = 0
        d[~inside] = 0
        weight = np.abs(d).sum(1)
        better = np.flatnonzero(weight < best)
        if len(better):
            if residual is x:
                residual = x.copy()
            residual[better], best[better], order[better] = d[better], weight[better], o
    coefs, shift = _lpc(x, LPC_ORDER)
    predicted = np.zeros_like(x)
    for j in range(LPC_ORDER):
        predicted[:, j + 1 :] += coefs[:, j : j + 1].astype(np.int32) * x[:, : BLOCK - j - 1]
    predicted >>= shift[:, None].astype(np.int32)
    other = x - predicted
    other[:, :LPC_ORDER] = 0
    other[~inside] = 0
    linear = np.abs(other).sum(1) + 2 * PRECISION * LPC_ORDER < best
    residual = np.where(linear[:, None], other, residual)
    warm = np.where(linear, LPC_ORDER, order)

    # a full frame has Rice partitions; others have one
    depth = np.where(n == BLOCK, PARTITIONS, 0)
    first_part = np.concatenate([[0], np.cumsum(1 << depth)])
    coded = inside & (column >= warm[:, None])
    u = ((residual << 1) ^ (residual >> 31))[coded]
    per_row = n - warm
    each = np.repeat(n >> depth, 1 << depth)
    each[first_part[:-1]] -= warm
    k, cost = _rice(u, each)
    bits_of = np.add.reduceat(cost, first_part[:-1]) + 6 + 4 * (1 << depth) + 8 * warm + linear * (9 + PRECISION * LPC_ORDER)
    same = (np.where(inside, x, x[:, :1]) == x[:, :1]).all(1)
    kind = np.select([same, 8 * n <= bits_of, ~linear], [0, 1, 2], 3)
    body = np.select([kind == 0, kind == 1], [np.full(total, 8), 8 * n], bits_of) + 8

    wide = np.select([number < 0x80, number < 0x800, number < 0x10000], [1, 2, 3], 4)
    head = 7 + wide  # with the CRC-8
    length = head + (body + 7) // 8 + 2
    meta = 4 + 4 + 34 + 4 + 18 * frames
    media = meta + np.bincount(of_doc, length, docs).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(media)])
    before = np.cumsum(length) - length
    first = np.cumsum(frames) - frames
    in_doc = before - before[first[of_doc]]
    at = ends[:-1][of_doc] + meta[of_doc] + in_doc

    bits = _Bits()
    bits.put(at * 8, 0xFFF8, 16)
    bits.put(at * 8 + 16, 0x7002, 16)
    for w in (1, 2, 3, 4):
        on = wide == w
        for j in range(w):
            low = number[on] >> (6 * (w - 1 - j))
            bits.put((at[on] + 4 + j) * 8, low & 0x7F if w == 1 else (low | (0xF00 >> w & 0xFF)) if j == 0 else 0x80 | (low & 0x3F), 8)
    bits.put((at + 4 + wide) * 8, n - 1, 16)
    sub = (at + head) * 8
    bits.put(sub, np.select([kind == 0, kind == 1, kind == 2], [0, 2, (8 + order) << 1], (32 + LPC_ORDER - 1) << 1), 8)
    sub = sub + 8
    bits.put(sub[kind == 0], x[kind == 0, 0] & 255, 8)
    row, col = np.nonzero(inside & (kind == 1)[:, None])
    bits.put(sub[row] + 8 * col, x[row, col] & 255, 8)
    soft = kind >= 2
    row, col = np.nonzero((column[:4] < warm[:, None]) & soft[:, None])
    bits.put(sub[row] + 8 * col, x[row, col] & 255, 8)
    base = sub + 8 * warm
    on = kind == 3
    bits.put(base[on], PRECISION - 1, 4)
    bits.put(base[on] + 4, shift[on], 5)
    for j in range(LPC_ORDER):
        bits.put(base[on] + 9 + PRECISION * j, coefs[on, j], PRECISION)
    base = base + on * (9 + PRECISION * LPC_ORDER)
    bits.put(base[soft], depth[soft], 6)
    if soft.any():
        kk = np.repeat(k, each)
        size = (u >> kk) + 1 + kk
        opens = np.cumsum(each) - each  # the first residual of each partition
        step = size.astype(np.int64)
        step[opens] += 4
        run = np.cumsum(step)
        lead = np.cumsum(per_row) - per_row
        end = np.repeat(base + 6 - (run[lead] - step[lead]), per_row) + run
        part_soft = np.repeat(soft, 1 << depth)
        bits.put((end[opens] - size[opens] - 4)[part_soft], k[part_soft], 4)
        code = (1 << kk) | (u & ((1 << kk) - 1))
        if not soft.all():
            keep = np.repeat(soft, per_row)
            end, kk, code = end[keep], kk[keep], code[keep]
        bits.put(end - kk - 1, code, kk + 1)
    out = bits.bytes(int(ends[-1]))

    out[at + head - 1] = crc8(out, at, head - 1)
    check = crc16(out, at, length - 2)
    out[at + length - 2], out[at + length - 1] = check >> 8, check & 255
    raw = data.tobytes()
    points = np.zeros(total, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")]))
    points["sample"], points["offset"], points["count"] = number * BLOCK, in_doc, n
    for d in range(docs):
        a, lo, hi = int(ends[d]), int(first[d]), int(first[d] + frames[d])
        size = int(sizes[d])
        info = (min(BLOCK, max(16, size)).to_bytes(2, "big") * 2 + int(length[lo:hi].min()).to_bytes(3, "big") + int(length[lo:hi].max()).to_bytes(3, "big")
                + (SAMPLE_RATE << 44 | 7 << 36 | size).to_bytes(8, "big") + hashlib.md5(raw[offsets[d] : offsets[d + 1]]).digest())
        seek = points[lo:hi].tobytes()
        out[a : a + int(meta[d])] = np.frombuffer(b"fLaC\x00\x00\x00\x22" + info + b"\x83" + len(seek).to_bytes(3, "big") + seek, np.uint8)
    return out, ends


@dataclass
class Info:
    """What the metadata blocks of a stream say."""

    samples: int
    block: int
    bits: int
    md5: bytes
    frames_at: int
    seek: np.ndarray  # rows of (sample, offset from the first frame, count)


def read_info(media: bytes) -> Info:
    if media[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, info, seek = 4, None, np.zeros((0, 3), np.int64)
    while True:
        kind, size = media[at], int.from_bytes(media[at + 1 : at + 4], "big")
        block = media[at + 4 : at + 4 + size]
        if kind & 127 == 0:
            packed = int.from_bytes(block[10:18], "big")
            if (packed >> 41) & 7:
                raise ValueError("only mono streams are read")
            info = (packed & ((1 << 36) - 1), int.from_bytes(block[2:4], "big"), ((packed >> 36) & 31) + 1, block[18:34])
        elif kind & 127 == 3:
            t = np.frombuffer(block, np.dtype([("s", ">u8"), ("o", ">u8"), ("n", ">u2")]))
            t = t[t["s"] != np.uint64(0xFFFFFFFFFFFFFFFF)]
            seek = np.stack([t["s"].astype(np.int64), t["o"].astype(np.int64), t["n"].astype(np.int64)], 1)
        at += 4 + size
        if kind & 128 or at >= len(media):
            break
    if info is None:
        raise ValueError("no stream info")
    return Info(*info, at, seek)


def decode_frames(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Frames that begin at these bytes: samples (a column each, int32), their counts, and the byte after each frame.

    Raises ValueError where a header or a checksum is wrong.
    """
    total = len(starts)
    buf = np.concatenate([buf, np.zeros(16, np.uint8)])
    wide = buf.astype(np.int64)
    word = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]

    def peek(at: np.ndarray) -> np.ndarray:
        """The next 16 bits."""
        return (word[at >> 3] >> (16 - (at & 7))) & 0xFFFF

    if (peek(starts * 8) & 0xFFFE != 0xFFF8).any():
        raise ValueError("a frame doesn't begin with its sync code")
    code, lead = buf[starts + 2] >> 4, buf[starts + 4].astype(np.int64)
    wide_number = np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC, lead < 0xFE], [1, 2, 3, 4, 5, 6], 7)
    after = starts + 4 + wide_number
    n = np.select([code == 6, code == 7, code == 1, code < 6], [buf[after] + 1, peek(after * 8) + 1, 192, 576 << np.maximum(code.astype(int) - 2, 0)], 256 << np.maximum(code.astype(int) - 8, 0)).astype(np.int64)
    rate = buf[starts + 2] & 15
    head = after - starts + np.select([code == 6, code == 7], [1, 2], 0) + np.select([rate == 12, (rate == 13) | (rate == 14)], [1, 2], 0)
    if (crc8(buf, starts, head) != buf[starts + head]).any():
        raise ValueError("CRC-8 of a frame header is wrong")
    if (buf[starts + 3] >> 4).any() or ((buf[starts + 3] >> 1 & 7) > 1).any():
        raise ValueError("only 8-bit mono frames are read")

    at = (starts + head + 1) * 8
    kind = (peek(at) >> 9) & 63
    if (peek(at) >> 8 & 1).any():
        raise ValueError("wasted bits are not read")
    at = at + 8
    order = np.select([(kind >= 8) & (kind <= 12), kind >= 32], [kind - 8, kind - 31], 0)
    most = int(n.max(initial=0))
    x = np.zeros((most, total), np.int32)
    eight = lambda p: ((peek(p) >> 8) ^ 0x80) - 0x80
    same, plain = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    x[:, same] = eight(at[same])
    for i in range(int(n[plain].max(initial=0))):
        on = plain[n[plain] > i]
        x[i, on] = eight(at[on] + 8 * i)
    at[same] += 8
    at[plain] += 8 * n[plain]
    soft = np.flatnonzero(kind >= 8)
    for i in range(int(order.max(initial=0))):
        on = soft[order[soft] > i]
        x[i, on] = eight(at[on])
        at[on] += 8
    coefs, shift = np.zeros((int(order.max(initial=0)), total), np.int32), np.zeros(total, np.int32)
    for o in range(1, min(4, len(coefs)) + 1):
        coefs[:o, np.flatnonzero(kind == 8 + o)] = np.array(FIXED[o])[:, None]
    lpc = np.flatnonzero(kind >= 32)
    if len(lpc):
        precision = (peek(at[lpc]) >> 12) + 1
        shift[lpc] = (peek(at[lpc] + 4) >> 11 ^ 16) - 16
        at[lpc] += 9
        for i in range(int(order[lpc].max())):
            on = order[lpc] > i
            p = precision[on]
            value = peek(at[lpc[on]]) >> (16 - p)
            coefs[i, lpc[on]] = (value ^ (1 << (p - 1))) - (1 << (p - 1))
            at[lpc[on]] += p

    # residuals: longest frames first, so that those still running are a prefix
    soft = soft[np.argsort(-n[soft], kind="stable")]
    if len(soft):
        p, size, warm = at[soft], n[soft], order[soft]
        method, depth = peek(p) >> 14, (peek(p) >> 10) & 15
        if method.any():
            raise ValueError("only 4-bit Rice parameters are read")
        p = p + 6
        k = np.zeros(len(soft), np.int64)
        each = size >> depth
        turns = set(warm.tolist())
        for d, s in set(zip(depth.tolist(), size.tolist(), strict=True)):
            turns.update(range(0, s, max(1, s >> d)))
        live = np.searchsorted(-size, -np.arange(most), "left")
        out = np.zeros((most, len(soft)), np.int32)
        begun = int(warm.max())
        for i in range(most):
            m = int(live[i])
            if not m:
                break
            if i in turns:
                new = np.flatnonzero((i == warm[:m]) | ((i > warm[:m]) & (i % each[:m] == 0)))
                k[new] = peek(p[new]) >> 12
                if (k[new] == 15).any():
                    raise ValueError("escaped partitions are not read")
                p[new] += 4
            if i < begun:
                on = np.flatnonzero(i >= warm[:m])
                got, p[on] = _code(word, peek, p[on], k[on])
                out[i, on] = got
            else:
                out[i, :m], p[:m] = _code(word, peek, p[:m], k[:m])
        # predictors
        live_cols = np.arange(most)[:, None] >= warm
        for o in sorted(set(warm.tolist())):
            cols = np.flatnonzero(warm == o)
            xs = x[:, soft[cols]]
            rs = np.where(live_cols[:, cols], out[:, cols], 0)
            if o == 0:
                xs = rs
            else:
                c, sh = coefs[:o, soft[cols]], shift[soft[cols]]
                for i in range(o, most):
                    guess = c[0] * xs[i - 1]
                    for j in range(1, o):
                        guess += c[j] * xs[i - 1 - j]
                    xs[i] = rs[i] + (guess >> sh)
            x[:, soft[cols]] = xs
        at[soft] = p
    end = (at + 7) // 8
    if (crc16(buf, starts, end - starts) != (buf[end].astype(np.int32) << 8 | buf[end + 1])).any():
        raise ValueError("CRC-16 of a frame is wrong")
    return x, n, end + 2


def _code(word: np.ndarray, peek, p: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One Rice code at each position: its signed value, and the position after it."""
    window = word[p >> 3] << (p & 7)
    q = LEADING[(window >> 16) & 0xFFFF]
    used = k + q
    if int(used.max(initial=0)) <= 24 and int(q.max(initial=0)) < 16:
        low = (window >> (31 - used)) & ((1 << k) - 1)
        u = (q.astype(np.int64) << k) | low
        return (u >> 1) ^ -(u & 1), p + 1 + used
    q = q.astype(np.int64)
    long = np.flatnonzero(q == 16)
    p = p + q
    while len(long):
        z = LEADING[peek(p[long])].astype(np.int64)
        q[long] += z
        p[long] += z
        if (q[long] > 1 << 20).any():
            raise ValueError("a Rice code doesn't end")
        long = long[z == 16]
    u = (q << k) | (peek(p + 1) >> (16 - k))
    return (u >> 1) ^ -(u & 1), p + 1 + k


def decode(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The samples (int8) of all streams, their offsets, and each stream's table of (sample offset, count) by block.

    With a seek point for each frame all frames are decoded together; otherwise a frame of each stream at a time.
    """
    raw = buf.tobytes()
    infos = [read_info(raw[offsets[d] : offsets[d + 1]][: 1 << 24]) for d in range(len(offsets) - 1)]
    sizes = np.array([i.samples for i in infos], np.int64)
    out_ends = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(out_ends[-1]), np.int8)
    blocks: list[np.ndarray] = [i.seek[:, [0, 2]] for i in infos]
    quick = [d for d, i in enumerate(infos) if len(i.seek) and i.seek[:, 2].sum() == i.samples and i.seek[0, 0] == 0]

    def place(x: np.ndarray, n: np.ndarray, to: np.ndarray) -> None:
        col = np.repeat(np.arange(len(n)), n)
        row = ranges(n)
        out[to[col] + row] = x[row, col]

    if quick:
        at = np.concatenate([offsets[d] + infos[d].frames_at + infos[d].seek[:, 1] for d in quick])
        to = np.concatenate([out_ends[d] + infos[d].seek[:, 0] for d in quick])
        x, n, _ = decode_frames(buf, at)
        if (n != np.concatenate([infos[d].seek[:, 2] for d in quick])).any():
            raise ValueError("a frame's size isn't that of its seek point")
        place(x, n, to)
    slow = [d for d in range(len(infos)) if d not in set(quick) and infos[d].samples]
    for d in slow:
        blocks[d] = np.zeros((0, 2), np.int64)
    at = {d: int(offsets[d] + infos[d].frames_at) for d in slow}
    done = dict.fromkeys(slow, 0)
    while slow:
        x, n, end = decode_frames(buf, np.array([at[d] for d in slow]))
        place(x, n, np.array([out_ends[d] + done[d] for d in slow]))
        for i, d in enumerate(slow):
            blocks[d] = np.vstack([blocks[d], [[done[d], int(n[i])]]])
            done[d], at[d] = done[d] + int(n[i]), int(end[i])
        slow = [d for d in slow if done[d] < infos[d].samples]
    pcm = out.tobytes()
    for d, i in enumerate(infos):
        if i.md5 != bytes(16) and hashlib.md5(pcm[out_ends[d] : out_ends[d + 1]]).digest() != i.md5:
            raise ValueError("MD5 of the samples is wrong")
    return out, out_ends, blocks


def read_samples(media: bytes, start: int, count: int) -> bytes:
    """So many samples from an offset on, through the seek table: only frames that hold them are decoded."""
    info = read_info(media)
    end = min(info.samples, start + count)
    if start >= end:
        return b""
    buf = np.frombuffer(media, np.uint8)
    need = info.seek[(info.seek[:, 0] < end) & (info.seek[:, 0] + info.seek[:, 2] > start)]
    if info.seek[:, 2].sum() != info.samples:
        samples, _, _ = decode(buf, np.array([0, len(media)]))
        return samples[start:end].tobytes()
    x, n, _ = decode_frames(buf, info.frames_at + need[:, 1])
    flat = np.concatenate([x[: n[i], i] for i in range(len(n))]).astype(np.int8)
    return flat[start - need[0, 0] : end - need[0, 0]].tobytes()
