"""Words and rolling hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Rabin-Karp hashes modulo 2^64 of any span of a sequence, from prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.back = powers(INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(BASE, n), out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]


def word_spans(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes, and the number of words before each text; bounds are the texts' offsets."""
    gap = separator[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    word = ~gap
    begins = word & (np.r_[True, gap[:-1]] | edge[:-1]) if len(data) else word
    finishes = word & (np.r_[gap[1:], True] | edge[1:]) if len(data) else word
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, by their bytes and lengths."""
    rolling = Rolling(data.astype(np.uint64) + np.uint64(1))
    return mixed(rolling.spans(starts, ends) + (ends - starts).astype(np.uint64))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    buffer = column.buffers()[2]
    whole = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]
