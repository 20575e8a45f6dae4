"""Jaro-Winkler similarity of UTF-8 bytes.

Spark has no such function, so an Arrow UDF scores whole batches of what native bounds can't settle: equal
strings are 1, empty ones 0, and for a threshold, pairs whose lengths rule it out are never
sent to Python. The UDF is declared non-deterministic, which keeps the optimizer from
evaluating it a second time in a pushed-down filter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The boost for a common prefix, its longest length, and from where it applies.
WEIGHT, PREFIX, BOOST_FROM = 0.1, 4, 0.7


def _finished(n: int, m: int, same: int, moved: int, common: int) -> float:
    """From the lengths, the matching bytes, those of them in another order, and the common prefix."""
    if not same:
        return 0.0
    j = (same / n + same / m + (same - moved // 2) / same) / 3
    return j if j <= BOOST_FROM else math.fma(common * WEIGHT, 1.0 - j, j)  # rounded once, as engines compiled with contraction do


def jaro_winkler_score(a: str, b: str) -> float:
    """The similarity of two strings, byte by byte; 0 if either is empty."""
    x, y = a.encode(), b.encode()
    n, m = len(x), len(y)
    reach = max(0, max(n, m) // 2 - 1)
    free, left = [True] * m, bytearray()
    for i, c in enumerate(x):
        j = y.find(c, max(0, i - reach), i + reach + 1)
        while j >= 0 and not free[j]:
            j = y.find(c, j + 1, i + reach + 1)
        if j >= 0:
            free[j] = False
            left.append(c)
    right = bytes(c for c, f in zip(y, free, strict=True) if not f)
    moved = sum(p != q for p, q in zip(left, right, strict=True))
    common = next((k for k, (p, q) in enumerate(zip(x[:PREFIX], y[:PREFIX], strict=False)) if p != q), min(n, m, PREFIX))
    return _finished(n, m, len(left), moved, common)


def _matrix(strings: list[bytes], size: np.ndarray, fill: int) -> np.ndarray:
    """A row of bytes for each string, filled up with a number that is no byte."""
    width = int(size.max(initial=0))
    out = np.full((len(strings), max(width, PREFIX)), fill, np.int16)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer(b"".join(strings), np.uint8)
    return out


def _ordered(chars: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen bytes of each row, moved to its beginning."""
    out = np.full(chars.shape, -3, np.int16)
    row, column = np.nonzero(chosen)
    out[row, (np.cumsum(chosen, 1) - 1)[row, column]] = chars[row, column]
    return out


def _bins(strings: list[bytes], size: np.ndarray) -> np.ndarray:
    """How many bytes of each string fall in each of 64 bins."""
    chars = np.frombuffer(b"".join(strings), np.uint8) & 63
    return np.bincount(np.repeat(np.arange(len(strings)) * 64, size) + chars, minlength=64 * len(strings)).reshape(-1, 64)


def _at_most(x: list[bytes], y: list[bytes], n: np.ndarray, m: np.ndarray, common: np.ndarray) -> np.ndarray:
    """What no pair's similarity is above: that of as many matching bytes as both have, none of them moved."""
    same = np.minimum(_bins(x, n), _bins(y, m)).sum(1)
    j = (same / np.maximum(n, 1) + same / np.maximum(m, 1) + 1) / 3
    return np.where(j <= BOOST_FROM, j, j + WEIGHT * common * (1 - j))


def _rows(x: list[bytes], y: list[bytes], least: float = 0.0) -> list[float]:
    """The similarity of each pair, or 0 where it can't reach `least`; all pairs move along x together, one byte at a time."""
    n, m = np.array(list(map(len, x)), np.int64), np.array(list(map(len, y)), np.int64)
    a, b = _matrix(x, n, -1), _matrix(y, m, -2)
    if least > 0:
        near = np.flatnonzero(_at_most(x, y, n, m, np.logical_and.accumulate(a[:, :PREFIX] == b[:, :PREFIX], 1).sum(1)) >= least - 1e-9)
        if len(near) < len(x):
            out = np.zeros(len(x))
            out[near] = _rows([x[i] for i in near.tolist()], [y[i] for i in near.tolist()])
            return out.tolist()
    reach = np.maximum(0, np.maximum(n, m) // 2 - 1)[:, None]
    free, hit, place = np.ones(b.shape, bool), np.zeros(a.shape, bool), np.arange(b.shape[1])
    row = np.arange(len(x))
    for i in range(int(n.max(initial=0))):
        fits = (b == a[:, i : i + 1]) & free & (np.abs(place - i) <= reach)
        first = fits.argmax(1)
        some = fits[row, first]
        hit[:, i] = some
        free[row[some], first[some]] = False
    left, right = _ordered(a, hit), _ordered(b, ~free)
    width = min(left.shape[1], right.shape[1])
    moved = (left[:, :width] != right[:, :width]).sum(1)
    common = np.logical_and.accumulate(a[:, :PREFIX] == b[:, :PREFIX], 1).sum(1)
    return list(map(_finished, n.tolist(), m.tolist(), hit.sum(1).tolist(), moved.tolist(), common.tolist()))


#: Bytes of a block's matrices at most, and the longest strings that go there.
BLOCK, LONGEST = 1 << 22, 512


def scores(a: Sequence[str], b: Sequence[str], least: float = 0.0) -> list[float]:
    """The similarities of pairs, in blocks of pairs of about the same length; long strings go one by one.
    Pairs that can't reach `least` may be 0."""
    x, y = [s.encode() for s in a], [s.encode() for s in b]
    size = np.array([max(len(p), len(q)) for p, q in zip(x, y, strict=True)], np.int64)
    out: list[float] = [0.0] * len(x)
    order = np.argsort(size, kind="stable")
    short = order[: np.searchsorted(size[order], LONGEST, "right")]
    at = 0
    while at < len(short):
        many = max(1, BLOCK // max(1, int(size[short[min(len(short) - 1, at + 4095)]])) // 8)
        block = short[at : at + min(many, 4096)].tolist()
        for i, score in zip(block, _rows([x[i] for i in block], [y[i] for i in block], least), strict=True):
            out[i] = score
        at += len(block)
    for i in order[len(short) :].tolist():
        out[i] = jaro_winkler_score(a[i], b[i])
    return out


#: Scores that a worker keeps from batch to batch for each threshold: of so many pairs, with so many characters each.
KEPT, KEPT_LENGTH = 1 << 16, 200
_kept: dict[float, dict[tuple[str, str], float]] = {}


def _score_all(a: pa.Array, b: pa.Array, least: float = 0.0) -> pa.Array:
    """Each distinct pair of a batch is scored once, and not again where the worker still knows it."""
    both = pc.and_(a.is_valid(), b.is_valid())
    x, y = a.filter(both).dictionary_encode(), b.filter(both).dictionary_encode()
    p, q = x.dictionary.to_pylist(), y.dictionary.to_pylist()
    code, at = np.unique(x.indices.to_numpy().astype(np.int64) * len(q) + y.indices.to_numpy(), return_inverse=True)
    pairs = [(p[c // len(q)], q[c % len(q)]) for c in code.tolist()]
    kept = _kept.setdefault(least, {})
    new = [k for k in pairs if k not in kept]
    fresh = dict(zip(new, scores([k[0] for k in new], [k[1] for k in new], least), strict=True))
    found = np.array([fresh[k] if k in fresh else kept[k] for k in pairs], np.float64)
    if len(kept) + len(fresh) > KEPT:
        kept.clear()
    kept.update((k, v) for k, v in fresh.items() if len(k[0]) + len(k[1]) <= KEPT_LENGTH)
    out, some = np.zeros(len(a)), both.to_numpy(zero_copy_only=False)
    out[some] = found[at]
    return pa.array(out, pa.float64(), mask=~some)


def _scored(a: Column, b: Column, least: float) -> Column:
    def score(a: pa.Array, b: pa.Array) -> pa.Array:
        return _score_all(a, b, least)

    return F.arrow_udf(score, "double").asNondeterministic()(a, b)


def _best(a: Column, b: Column) -> Column:
    """No pair of these lengths is more similar: all of the shorter matches, and the prefix is whole."""
    n, m = F.octet_length(a).cast("double"), F.octet_length(b).cast("double")
    j = (F.least(n, m) / n + F.least(n, m) / m + 1) / 3
    return j + WEIGHT * PREFIX * (1 - j)


def jaro_winkler(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """The similarity; null if either is null, and 0 where it can't reach `threshold`."""
    settled = F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).when(_best(a, b) < threshold - 1e-9, 0.0)
    hard = F.when(a.isNull() | b.isNull() | settled.isNotNull(), None)
    ask = lambda s: F.when(settled.isNull() & a.isNotNull() & b.isNotNull(), s)  # noqa: E731  null elsewhere, so Python skips it
    return F.when(a.isNull() | b.isNull(), hard.cast("double")).otherwise(F.coalesce(settled, _scored(ask(a), ask(b), threshold)))
