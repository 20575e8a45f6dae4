"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each present or absent, hashed into 2**`bits` coordinates: words, word
stems (the first four and five bytes), pairs of neighbours and pairs with one word between.
Training is FTRL-proximal with per-coordinate rates and L1 sparsity on a bounded sample of
labelled documents, in one task; what it returns is the few coordinates with a weight other
than 0. Scoring broadcasts these and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, JOIN, Powers, Words, groups, mix, utf8

CHUNK = 1 << 18


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 1.0
    epochs: int = 4
    #: Labelled documents that are learned from at most: those with the smallest id hashes.
    sample: int = 8192


@dataclass
class Model:
    """Sparse weights; 12 bytes a coordinate, 2**bits coordinates at most."""

    bits: int
    bias: float
    coordinate: np.ndarray
    weight: np.ndarray
    _dense: np.ndarray | None = field(default=None, repr=False)

    def dense(self) -> np.ndarray:
        if self._dense is None:
            self._dense = np.zeros(1 << self.bits, np.float32)
            self._dense[self.coordinate] = self.weight
        return self._dense

    def __getstate__(self):
        return self.__dict__ | {"_dense": None}


def coordinates(words: Words, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Lists of (position of a word, coordinate), one for each kind of feature."""
    h, shift = words.hash, np.uint64(64 - bits)
    last = np.repeat(words.first[1:], np.diff(words.first))
    at = np.arange(len(h))
    out = [(at, h >> shift)]
    for n in (4, 5):
        out.append((at, mix(words.prefix_hash(n) + np.uint64(n)) >> shift))
    for gap in (1, 2):
        first = np.flatnonzero(at + gap < last)
        out.append((first, mix(h[first] * JOIN + h[first + gap] + np.uint64(gap)) >> shift))
    return out


def _features(column: pa.Array, bits: int, steps: Powers) -> Iterator[np.ndarray]:
    """The distinct coordinates of each text."""
    data, offsets = utf8(column)
    for a, b in groups(offsets, CHUNK):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ALNUM, steps)
        document = words.document()
        code = np.concatenate([(document[at].astype(np.uint64) << np.uint64(bits)) | c for at, c in coordinates(words, bits)])
        code = np.unique(code)
        split = np.searchsorted(code, np.arange(1, b - a, dtype=np.uint64) << np.uint64(bits))
        for part in np.split(code & np.uint64((1 << bits) - 1), split):
            yield part.astype(np.int32)


def fit(examples: list[tuple[np.ndarray, int]], s: Settings) -> Model:
    """FTRL-proximal in the given order, `epochs` times. Without both classes there is only a bias."""
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    zb = nb = 0.0
    if len({y for _, y in examples}) < 2:
        rate = (sum(y for _, y in examples) + 0.0) / max(1, len(examples))
        return Model(s.bits, float(np.log((rate + 1e-3) / (1 - rate + 1e-3))), np.empty(0, np.int32), np.empty(0, np.float32))

    def weight(zi, ni):
        return np.where(np.abs(zi) <= s.l1, 0.0, -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for at, y in examples:
            zi, ni = z[at], n[at]
            w = weight(zi, ni)
            wb = -zb / ((s.beta + nb**0.5) / s.alpha)
            g = 1 / (1 + np.exp(-np.clip(wb + w.sum(), -35, 35))) - y
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / s.alpha * w
            n[at] = grown
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / s.alpha * wb
            nb += g * g
    w = weight(z, n)
    at = np.flatnonzero(w)
    return Model(s.bits, float(-zb / ((s.beta + nb**0.5) / s.alpha)), at.astype(np.int32), w[at].astype(np.float32))


def _fit_task(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    steps, examples = Powers(), []
    for batch in batches:
        examples += zip(_features(batch.column(0), s.bits, steps), batch.column(1).to_pylist(), strict=True)
    model = fit(examples, s)
    yield pa.RecordBatch.from_arrays([pa.array([model.bias]), pa.array([model.coordinate.tobytes()]), pa.array([model.weight.tobytes()])], ["bias", "coordinate", "weight"])


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", settings: Settings = Settings()) -> Model:
    """A model of `label` (0 or 1), learned from at most `settings.sample` labelled documents.

    Defined cases: labels that are null or neither 0 nor 1, and null ids, are ignored; an id
    with both labels counts as 1; of documents with the same id the least text is learned from;
    null texts are empty; without examples of both classes every score is the same.
    """
    chosen = labels.select(F.col(doc_id).alias("i"), F.col(label).alias("y")).where("i is not null and y in (0, 1)").groupBy("i").agg(F.max("y").cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("i"), "i").limit(settings.sample)
    rows = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).join(F.broadcast(chosen), F.col("d") == F.col("i"))
    rows = rows.groupBy("i").agg(F.min("t").alias("t"), F.max("y").alias("y"))  # so that the sample's size is a bound
    one = rows.repartition(1).sortWithinPartitions(F.xxhash64("i"), "i").select("t", "y")
    got = one.mapInArrow(lambda batches: _fit_task(batches, settings), "bias double, coordinate binary, weight binary").first()
    if got is None:  # no task ran
        return fit([], settings)
    return Model(settings.bits, got.bias, np.frombuffer(bytes(got.coordinate), np.int32), np.frombuffer(bytes(got.weight), np.float32))


def scores(model: Model, column: pa.Array) -> np.ndarray:
    """The probability of label 1 for each text."""
    data, offsets = utf8(column)
    steps, dense, out = Powers(), model.dense(), np.full(len(offsets) - 1, model.bias)
    for a, b in groups(offsets, CHUNK):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ALNUM, steps)
        document = words.document()
        codes = []
        for at, c in coordinates(words, model.bits):
            hit = np.flatnonzero(dense[c.astype(np.int64)])
            codes.append((document[at[hit]] << model.bits) | c[hit].astype(np.int64))
        code = np.unique(np.concatenate(codes))  # a feature counts once in a document
        out[a:b] += np.bincount(code >> model.bits, dense[code & ((1 << model.bits) - 1)], b - a)
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def score(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """The score of each text of `docs`, 0 to 1; null and empty texts get the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(scores(shared.value, column), pa.float64())

    return scored(docs[text])
