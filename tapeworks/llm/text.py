"""Words, lines and hashes of whole texts, for code that runs inside tasks.

A *word* is a maximal run of characters other than the space and U+0009 to
U+000D (``[^\\x20\\x09-\\x0D]+``).  On UTF-8 bytes that is exactly what
``bytes.split()`` returns, so texts are handled as bytes and never decoded
unless characters are needed.  A null text has no words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def utf8_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes per row, None for null."""
    return utf8(batch.column(batch.schema.get_field_index(name)))


def utf8(col: pa.Array) -> list[bytes | None]:
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return col.cast(kind).to_pylist()


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
    values[_SPACES] = 0
    return values


_BYTE = _byte_values()
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class WordHasher:
    """64-bit hashes of all words of a text at once: a polynomial of random
    byte values over the whole text, differenced at the words' ends and
    finalised.  Keeps tables of powers as long as the longest text seen."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def bounds(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets of the words: starts and ends."""
        inside = np.zeros(len(text) + 2, np.int8)
        np.logical_not(_SPACES[np.frombuffer(text, np.uint8)], out=inside[1:-1].view(bool))
        turn = np.diff(inside)
        return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)

    def pieces(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the parts of a text between these offsets."""
        size = len(text)
        if size > len(self.up):
            self.up = _powers(_BASE, size + size // 2)
            self.down = _powers(pow(_BASE, -1, 2**64), size + size // 2)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[np.frombuffer(text, np.uint8)] * self.up[:size], out=total[1:])
        return mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def __call__(self, text: bytes | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint64)
        return self.pieces(text, *self.bounds(text))


MIX_FACTORS = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all their bits depend on all bits given."""
    h = h.astype(np.uint64, copy=True)
    for factor in MIX_FACTORS:
        h ^= h >> np.uint64(33)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(33)
    return h


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every ``n`` consecutive words, given the words' hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = words[:count].copy()
    for k in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out += words[k:k + count]
    return mix(out)


def windows_repeated(ids: np.ndarray, n: int) -> np.ndarray:
    """For each window of ``n`` integers, whether the same window occurs at
    another place of the array.  Exact: windows are named by ranks (prefix
    doubling), no hashing."""
    count = len(ids) - n + 1
    if count <= 1:
        return np.zeros(max(count, 0), bool)
    names = {1: np.asarray(ids, np.int64)}
    length = 1
    while length < n:
        step = min(length, n - length)
        left, right = names[length][: len(ids) - length - step + 1], names[step][length:]
        pair = left * (int(right.max()) + 1) + right
        length += step
        names[length] = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    return np.bincount(names[n])[names[n]] > 1


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Mark the positions that windows of length ``n`` with these starts cover."""
    edge = np.bincount(starts, minlength=size + 1) - np.bincount(np.minimum(starts + n, size), minlength=size + 1)
    return np.cumsum(edge[:size]) > 0
