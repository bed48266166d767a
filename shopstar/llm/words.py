"""Words and word windows of whole texts as 64-bit hashes, computed a column at a time.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Its hash is a polynomial over its bytes, taken from a running sum, so that
neither words nor texts are visited one by one in Python. Windows hash alike over words.
Memory follows the pieces a column is cut into, and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
FOLDED = _EXACT.copy()
FOLDED[65:91] = _EXACT[97:123]
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, base: np.uint64, size: int) -> np.ndarray:
    if len(_powers[which]) < size:
        factors = np.full(max(size, 2 * len(_powers[which])), base, np.uint64)
        factors[0] = 1
        _powers[which] = np.cumprod(factors)
    return _powers[which][:size]


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power("up", _BASE, len(values)), out=out[1:])
    return out


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of the values; equal spans hash alike wherever they stand."""
    sums = _sums(values)
    turned = (sums[ends] - sums[starts]) * _power("down", _INVERSE, len(values) + 1)[starts]
    return mix(turned + (ends - starts).astype(np.uint64))


class Texts:
    """The words of a few consecutive texts."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, breaks: np.ndarray = _SPACES):
        """data: bytes of the texts end to end; bounds: where each begins, and the end.

        breaks: which of the 256 byte values part words.
        """
        self.data = data
        self.bounds = bounds
        size = len(data)
        word = ~breaks[data]
        before, after = np.ones(size, bool), np.ones(size, bool)
        before[1:], after[:-1] = ~word[:-1], ~word[1:]
        before[bounds[:-1][bounds[:-1] < size]] = True
        after[bounds[1:][bounds[1:] > 0] - 1] = True
        self.starts = np.flatnonzero(word & before)
        self.ends = np.flatnonzero(word & after) + 1
        # First word of each text, and the end.
        self.first = np.searchsorted(self.starts, bounds)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def hashes(self, fold: bool = False) -> np.ndarray:
        """One hash for each word; with fold, A-Z count as a-z."""
        return spans_hash((FOLDED if fold else _EXACT)[self.data], self.starts, self.ends)

    def word(self, at: int) -> bytes:
        return self.data[self.starts[at] : self.ends[at]].tobytes()

    def words(self, text: int) -> list[bytes]:
        return self.data[self.bounds[text] : self.bounds[text + 1]].tobytes().split()


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of this many words within one text, and each text's first run."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], counts)
    return spans_hash(hashes, at, at + size), begin


def texts(column: pa.Array, breaks: np.ndarray = _SPACES) -> Iterator[tuple[int, Texts]]:
    """The texts of a column in pieces of bounded size, each with its first row.

    A null is an empty text. A text above the size is a piece of its own.
    """
    whole = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(whole):
        end = int(np.searchsorted(offsets, offsets[row] + PIECE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(whole))
        yield row, Texts(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], breaks)
        row = end
