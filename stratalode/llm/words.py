"""Words of Arrow text columns as arrays of positions and hashes.

The UTF-8 bytes of a column are looked at in place; a word is a run of bytes of a
given set, and A-Z count as a-z. Memory follows the piece of rows in hand: a few
MB of text, or one document where that is longer.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20

_bytes = np.arange(256)
#: Runs of digits, letters and everything beyond ASCII.
ALPHANUMERIC = ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes | 0x20) >= 0x61) & ((_bytes | 0x20) <= 0x7A) | (_bytes >= 0x80)
#: Runs of anything but white space.
UNSPACED = ~((_bytes == 0x20) | (_bytes >= 0x09) & (_bytes <= 0x0D))

LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes | 0x20, _bytes).astype(np.uint8)
_values = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER] * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEPS = np.cumprod(np.full(64, 0xD1342543DE82EF95, dtype=np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


@dataclass(frozen=True)
class Words:
    """Words of some rows. Row ``i`` has the words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
        """64-bit hashes of the words, and of their first bytes for each length in ``prefixes``."""
        out = [np.empty(len(self.starts), dtype=np.uint64) for _ in range(1 + len(prefixes))]
        i, n = 0, len(self.starts)
        while i < n:
            a = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.starts, a + PIECE)))
            b = self.ends[j - 1]
            power, inverse = _powers(1 << max(int(np.ceil(np.log2(b - a + 1))), 20))
            sums = np.zeros(b - a + 1, dtype=np.uint64)
            np.cumsum(_values[self.data[a:b]] * power[: b - a], out=sums[1:])
            s, e = self.starts[i:j] - a, self.ends[i:j] - a
            out[0][i:j] = mixed((sums[e] - sums[s]) * inverse[s])
            for k, length in enumerate(prefixes, 1):
                out[k][i:j] = mixed((sums[np.minimum(s + length, e)] - sums[s]) * inverse[s] + np.uint64(length))
            i = j
        return out

    def text(self, word: int) -> bytes:
        return LOWER[self.data[self.starts[word] : self.ends[word]]].tobytes()


def combined(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` words from each position in ``at``."""
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        total += hashes[at + k] * _STEPS[k % 64]
    return mixed(total + np.uint64(n))


def window_starts(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``n`` words start, and how many each row has."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    before = np.cumsum(counts) - counts
    return np.repeat(first[:-1] - before, counts) + np.arange(counts.sum()), counts


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row begins; NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``size`` bytes: (from, to, bytes, row starts within them)."""
    data, at = utf8(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1))
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def find_words(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> Words:
    inside = kind[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = at[1:] > at[:-1]
    edges = at[:-1][filled]
    begins[edges] = inside[edges]
    edges = at[1:][filled] - 1
    ends[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at))
