"""What the operators of this subpackage share: scratch tables, free column names, byte kernels.

The byte kernels work on a whole Arrow string array at once: they see the UTF-8 buffer and
the offsets, never one Python string per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..scratch import saved, scratch_dir, scratch_path  # noqa: F401  the operators' way to them


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it none of the table's columns."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        out.append(name)
    return out


# --- byte kernels ---------------------------------------------------------------------

#: One odd 64-bit multiplier and a table of 256 words, both from a fixed seed: a string's
#: hash is the sum of TABLE[byte] * STEP**position, taken modulo 2**64 and then mixed.
_rng = np.random.Generator(np.random.PCG64(20240607))
STEP = np.uint64(int(_rng.integers(0, 2**63)) * 2 + 1)
TABLE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(n: int, base: np.uint64 = STEP) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


class Powers:
    """powers() of a base and of its inverse, kept and lengthened on demand."""

    def __init__(self, base: np.uint64 = STEP):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 2**64))
        self.up = self.down = np.empty(0, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = powers(n, self.base), powers(n, self.inverse)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the public murmur3 finalizer)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of an Arrow string array; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        width = np.int32
    else:
        width = np.int64
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Consecutive rows, split so that each run has at most `most` bytes or one row."""
    out, first, n = [], 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        out.append((first, last))
        first = last
    return out


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start[0], start[0] + 1, .. of each of the ranges, one after another."""
    if not len(start):
        return np.empty(0, np.int64)
    return np.repeat(start - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())


#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry membership table of inclusive byte ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Words of 0-9, a-z (after lower-casing) and everything beyond ASCII.
ALNUM = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Words of everything but ASCII white space.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))


class Words:
    """The words of some documents: byte spans, 64-bit hashes, and where each document's begin.

    `data` holds the lower-cased bytes of the documents, `offsets` their n + 1 bounds, and
    `first` the n + 1 bounds of their words. Lower-casing and the word classes are decided
    byte by byte, which UTF-8 allows since both keep bytes above 0x7F.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, steps: Powers):
        self.data, self.offsets = LOWER[data], offsets
        inside = table[self.data]
        begins, n = inside.copy(), len(data)
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        bounds = np.unique(offsets)
        heads, tails = bounds[bounds < n], bounds[bounds > 0] - 1
        begins[heads] = inside[heads]
        ends[tails] = inside[tails]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        steps.need(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(TABLE[self.data] * steps.up[:n], out=total[1:])
        self.total, self.steps = total, steps
        self.hash = mix((total[self.end] - total[self.start]) * steps.down[self.start])

    def prefix_hash(self, n: int) -> np.ndarray:
        """The hashes of the words' first n bytes (of whole words where they are shorter)."""
        end = np.minimum(self.start + n, self.end)
        return mix((self.total[end] - self.total[self.start]) * self.steps.down[self.start])

    def document(self) -> np.ndarray:
        """Each word's document."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))

    def text(self, a: int, b: int) -> list[bytes]:
        """Words a to b."""
        raw = self.data[self.start[a] : self.end[b - 1]].tobytes() if b > a else b""
        at = int(self.start[a]) if b > a else 0
        return [raw[s - at : e - at] for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist(), strict=True)]


#: Multiplier that joins the hashes of consecutive words.
JOIN = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k consecutive words at each word, and which of them stay in one document."""
    h, n = words.hash, len(words.hash)
    m = max(0, n - k + 1)
    out, step = np.zeros(m, np.uint64), np.uint64(1)
    for j in range(k):
        out += h[j : j + m] * step
        step = np.uint64((int(step) * int(JOIN)) & 0xFFFFFFFFFFFFFFFF)
    last = np.repeat(words.first[1:], np.diff(words.first))
    return mix(out), (np.arange(m) + k <= last[:m])
