"""Words, word hashes and window hashes of whole Arrow batches, in numpy.

The operators that need every word of every text run in ``mapInArrow`` and
work on the batch's UTF-8 buffer directly: one vectorised pass finds the
words of many texts at once, prefix sums of a polynomial give the 64-bit
hash of any word and of any run of words in constant time.

A word is a maximal run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return (``[^\\x20\\x09-\\x0D]+``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITESPACE = b" \t\n\x0b\x0c\r"
CHUNK_BYTES = 1 << 19  # texts handled at once; a longer text is one chunk of its own

_U = np.uint64
_P = 0x9E3779B97F4A7C15  # odd multipliers: powers have inverses modulo 2**64
_Q = 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1

IS_WORD = np.ones(256, bool)
IS_WORD[list(WHITESPACE)] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits (in place on a copy)."""
    x = x.copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(_P))
_BYTES_LOWER = _BYTES.copy()
_BYTES_LOWER[65:91] = _BYTES[97:123]


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def __reduce__(self):
        return _Powers, (self.base,)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base & _MASK, _U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_P), _Powers(_Q)


def prefix_sums(values: np.ndarray, powers: _Powers = _WORD_POWERS) -> np.ndarray:
    up, _ = powers.get(len(values))
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up, out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, powers: _Powers = _WORD_POWERS) -> np.ndarray:
    """Hashes of the value runs [start, end) from their prefix sums."""
    _, down = powers.get(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


class Words:
    """The words of some texts: byte spans, owners and hashes.

    ``first[d]:first[d + 1]`` are text d's words. ``breaks`` marks further
    positions at which a new word starts."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool = False, breaks: np.ndarray | None = None):
        self.buf, self.offsets = buf, offsets
        word = IS_WORD[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[offsets] = True  # a text's border ends a word
        if breaks is not None:
            edge[:-1] |= breaks
        before = np.zeros(len(buf), bool)
        before[1:] = word[:-1]
        before &= ~edge[:-1]
        after = np.zeros(len(buf), bool)
        after[:-1] = word[1:]
        after &= ~edge[1:]
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        table = _BYTES_LOWER if lower else _BYTES
        self.hash = range_hash(prefix_sums(table[buf], _BYTE_POWERS), self.start, self.end, _BYTE_POWERS)

    def __len__(self) -> int:
        return len(self.start)

    def owner(self) -> np.ndarray:
        """The text index of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(lo, hi, bytes, offsets)`` of consecutive rows; a null text is empty.

    A chunk holds at most ``limit`` bytes or one row, so the working memory
    does not follow the batch."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def to_int64(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed longs (same bits)."""
    return np.ascontiguousarray(x).view(np.int64)
