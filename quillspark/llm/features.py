"""Numeric features of UTF-8 texts, computed for all texts of a step at once."""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: For n-grams of letters: lower-cased, anything else a space.
LETTERS_ONLY = np.where(LETTER, LOWER, 32).astype(np.uint8)
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def grams(data: np.ndarray, offsets: np.ndarray, width: int, sizes: tuple[int, ...] = (1, 2, 3)) -> np.ndarray:
    """Counts of byte n-grams of these sizes, hashed into so many columns (a power of two), a row each text."""
    docs = len(offsets) - 1
    owner = np.repeat(np.arange(docs, dtype=np.int64), np.diff(offsets)) * width
    wide = data.astype(np.uint32)
    total = np.zeros(docs * width, np.int64)
    shift = np.uint32(32 - int(width).bit_length() + 1)
    for n in sizes:
        if len(wide) < n:
            continue
        code = np.full(len(wide) - n + 1, n, np.uint32)
        for i in range(n):
            code = code * np.uint32(257) + wide[i : len(wide) - n + 1 + i]
        code = (code * np.uint32(2654435761)) >> shift
        own = owner[: len(code)]
        if n > 1:
            inside = own == owner[n - 1 :]
            code, own = code[inside], own[inside]
        total += np.bincount(own + code, minlength=docs * width)
    return total.reshape(docs, width)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    size = ((size >> 18) + 1) << 18
    if size not in _POWERS:
        _POWERS.clear()
        with np.errstate(over="ignore"):
            _POWERS[size] = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, m, np.uint64))]) for m in (MULTIPLIER, INVERSE))
    return _POWERS[size]


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range: differences of one running polynomial sum, moved to a common power."""
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        run = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
        h = (run[ends] - run[starts]) * down[starts]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at the offsets, and the range that each run is in."""
    n = len(mask)
    edge = np.zeros(n + 1, bool)
    edge[1:n] = mask[1:] != mask[:-1]
    edge[0] = edge[n] = True
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = mask[starts] if n else np.zeros(len(starts), bool)
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word (a run of letters, ASCII lower-cased; bytes from 128 on count as letters), and the text it is in."""
    starts, ends, owner = runs(LETTER[data], offsets)
    return spans_hash(LOWER[data], starts, ends), owner


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; rows of zeros stay."""
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(size > 0, size, 1)
