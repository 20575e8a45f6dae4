"""Benchmark decontamination: a prefix-filtered set join of documents and item windows.

Every benchmark item is cut into windows of `window` consecutive words (an item of fewer
words is one window), and every window is a set of word shingles. One pass over all
documents counts in how many documents each of these shingles occurs; that orders them by
rarity. A window can be contained in a document only if one of its
``n - ceil(containment * n) + 1`` rarest shingles occurs there, so only these prefix tokens
are looked for. An occurrence is a candidate if the window, laid over it at the shingle's
offset, lies within the document (length and positional bounds), and is confirmed on the
words themselves.

The index of item windows is broadcast, in blocks of at most `block_bytes` of item text; a
larger benchmark takes one pass for each block. Documents are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, Powers, Words, groups, ranges, saved, shingles, unused, utf8

#: Bytes of document text that one round of the kernel takes.
CHUNK = 1 << 18
#: Candidates whose words are compared at a time.
CONFIRM = 1 << 13

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.LongType())),
        T.StructField("runs", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())), ("runs", pa.list_(pa.list_(pa.int64())))])


class Index:
    """The distinct windows of some items and, once the shingles' frequencies are known, their prefix tokens.

    A window is `size` words from the word `begin` of all items' words on; windows of the same
    words are one, with all items that have it. A window's shingles are those of `width` words.
    """

    def __init__(self, items: list[tuple[int, str]], window: int, k: int, containment: float):
        self.containment = containment
        self.ids, which = np.unique(np.array([i for i, _ in items], np.int64), return_inverse=True)  # rows of one item id count once
        data = [t.encode() for _, t in items]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
        words = Words(np.frombuffer(b"".join(data), np.uint8), offsets, ALNUM, Powers())
        count = np.diff(words.first)
        size = np.minimum(count, window)
        many = np.where(count > 0, count - size + 1, 0)
        row = np.repeat(np.arange(len(items)), many)
        begin = words.first[:-1][row] + ranges(np.zeros(len(items), np.int64), many)
        seen: dict[bytes, int] = {}
        spelt = words.text(0, len(words.start))
        same = np.array([seen.setdefault(b" ".join(spelt[a : a + n]), len(seen)) for a, n in zip(begin.tolist(), size[row].tolist(), strict=True)], np.int64)
        first = np.unique(same, return_index=True)[1]
        self.begin, self.size = begin[first], size[row][first]
        self.width = np.minimum(self.size, k)  # a window of under k words is one shingle
        pairs = np.unique(same * max(1, len(self.ids)) + which[row])  # window and item, sorted by window
        self.items = pairs % max(1, len(self.ids))
        self.of = np.searchsorted(pairs, np.arange(len(first) + 1) * max(1, len(self.ids)))
        self.data, self.start, self.length, self.hash = words.data, words.start, words.end - words.start, words.hash
        self.widths = sorted(set(self.width.tolist()))
        self.shingle = {n: shingles(words, n)[0] for n in self.widths}
        self.keys = {n: np.unique(self.shingle[n][ranges(self.begin[self.width == n], (self.size - n + 1)[self.width == n])]) for n in self.widths}
        self.tokens: dict[int, tuple] = {}

    def shingles_of(self, w: int) -> np.ndarray:
        """The distinct shingles of window w."""
        n, a = int(self.width[w]), int(self.begin[w])
        return np.unique(self.shingle[n][a : a + int(self.size[w]) - n + 1])

    def order(self, frequency: dict[int, np.ndarray]) -> None:
        """Keep each window's prefix: its rarest distinct shingles, and where in it they are."""
        found: dict[int, list] = {n: [] for n in self.widths}
        for w, (a, m, n) in enumerate(zip(self.begin.tolist(), self.size.tolist(), self.width.tolist(), strict=True)):
            distinct, first = np.unique(self.shingle[n][a : a + m - n + 1], return_index=True)
            most = len(distinct) - math.ceil(self.containment * len(distinct) - 1e-9) + 1
            rarity = frequency[n][np.searchsorted(self.keys[n], distinct)]
            for j in np.lexsort((distinct, rarity))[: min(most, len(distinct))]:
                found[n].append((int(distinct[j]), w, int(first[j])))
        for n, rows in found.items():
            rows.sort()
            key = np.array([r[0] for r in rows], np.uint64)
            token, first = np.unique(key, return_index=True)
            self.tokens[n] = (token, np.append(first, len(rows)), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64))
        self.shingle, self.keys = ({} if self.containment >= 1 else self.shingle), {}

    def same_words(self, words: Words, start: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Whether window w stands at the document's word `start`: equal hashes first, then equal bytes."""
        out = np.zeros(len(start), bool)
        for a in range(0, len(start), CONFIRM):
            s, x = start[a : a + CONFIRM], w[a : a + CONFIRM]
            here, there, size = ranges(s, self.size[x]), ranges(self.begin[x], self.size[x]), self.size[x]
            length = self.length[there]
            equal = (words.hash[here] == self.hash[there]) & (words.end[here] - words.start[here] == length)
            good = np.logical_and.reduceat(equal, np.append(0, np.cumsum(size)[:-1]))
            each = np.flatnonzero(np.repeat(good, size))
            length = length[each]
            bytes_ = words.data[ranges(words.start[here[each]], length)] == self.data[ranges(self.start[there[each]], length)]
            if not bytes_.all():
                wrong = each[np.searchsorted(np.cumsum(length), np.flatnonzero(~bytes_), "right")]
                good[np.searchsorted(np.cumsum(size), wrong, "right")] = False
            out[a : a + CONFIRM] = good
        return out


def _among(h: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of `h` that hold one of the sorted `keys`, and which."""
    maybe = np.zeros(1 << 20, bool)
    maybe[keys >> np.uint64(44)] = True
    at = np.flatnonzero(maybe[h >> np.uint64(44)])
    if not len(at):
        return at, at
    i = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
    same = keys[i] == h[at]
    return at[same], i[same]


def _count(index: Index, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each of the index's shingles: (width, position among the keys, documents)."""
    steps, total = Powers(), {n: np.zeros(len(index.keys[n]), np.int64) for n in index.widths}
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for a, b in groups(offsets, CHUNK):
            words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ALNUM, steps)
            document = words.document()
            for n in index.widths:
                h, whole = shingles(words, n)
                at, key = _among(h, index.keys[n])
                at, key = at[whole[at]], key[whole[at]]
                once = np.unique(document[at] * np.int64(len(index.keys[n])) + key) % len(index.keys[n])
                total[n] += np.bincount(once, minlength=len(total[n]))
    for n in index.widths:
        at = np.flatnonzero(total[n])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n), pa.int32()), pa.array(at, pa.int64()), pa.array(total[n][at], pa.int64())], ["width", "key", "n"])


def _windows(index: Index, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Confirmed (first word, window) of all occurrences of windows, each once."""
    starts, windows = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    document = words.document()
    for n in index.widths:
        h, whole = shingles(words, n)
        token, first, window, offset = index.tokens[n]
        at, key = _among(h, token)
        at, key = at[whole[at]], key[whole[at]]
        if not len(at):
            continue
        many = first[key + 1] - first[key]
        row = ranges(first[key], many)
        at, w, off = np.repeat(at, many), window[row], offset[row]
        low, high = words.first[document[at]], words.first[document[at] + 1]
        size = index.size[w]
        if index.containment >= 1:
            start = at - off
            fits = (start >= low) & (start + size <= high)
            start, w = start[fits], w[fits]
            same = index.same_words(words, start, w)
            starts.append(start[same])
            windows.append(w[same])
        else:
            tried = {(s, x): m for p, x, m, lo, hi in zip(at.tolist(), w.tolist(), size.tolist(), low.tolist(), high.tolist(), strict=True) for s in range(max(lo, p - m + n), min(p, hi - m) + 1)}
            distinct = {x: index.shingles_of(x) for _, x in tried}
            hit = [(s, x) for (s, x), m in tried.items() if np.isin(distinct[x], h[s : s + m - n + 1]).sum() >= index.containment * len(distinct[x]) - 1e-9]
            starts.append(np.array([s for s, _ in hit], np.int64))
            windows.append(np.array([x for _, x in hit], np.int64))
    return np.concatenate(starts), np.concatenate(windows)


def _lists(values: np.ndarray, of: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))


def find(index: Index, column: pa.Array) -> pa.Array:
    """RESULT of each text: its words, those hit, the ids of its items, and the runs of
    hit words as [first, end)."""
    data, offsets = utf8(column)
    steps, parts = Powers(), []
    ids, most = index.ids, np.int64(max(1, len(index.size)))
    for a, b in groups(offsets, CHUNK):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ALNUM, steps)
        n, document, m = b - a, words.document(), len(words.start)
        start, window = _windows(index, words)
        size = index.size[window]
        cover = np.zeros(m + 1, np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + size, -1)
        hit = np.cumsum(cover)[:m] > 0
        held = np.unique(document[start] * most + window) if len(start) else np.empty(0, np.int64)  # windows of each document
        many = (index.of[1:] - index.of[:-1])[held % most]
        pairs = np.unique(np.repeat(held // most, many) * len(ids) + index.items[ranges(index.of[held % most], many)])
        edge = np.ones(m, bool)
        edge[words.first[:-1][words.first[:-1] < m]] = False  # a run ends with its document
        begins = hit & ~(np.append(False, hit[:-1]) & edge)
        head = np.flatnonzero(begins)
        tail = np.flatnonzero(hit & ~(np.append(hit[1:], False) & np.append(edge[1:], False))) + 1
        base = words.first[document[head]] if len(head) else head
        runs = pa.FixedSizeListArray.from_arrays(pa.array(np.stack([head - base, tail - base], 1).ravel(), pa.int64()), 2).cast(pa.list_(pa.int64()))
        parts.append(
            pa.StructArray.from_arrays(
                [
                    pa.array(np.diff(words.first), pa.int64()),
                    pa.array(np.bincount(document[hit], minlength=n), pa.int64()),
                    _lists(ids[pairs % max(1, len(ids))], pairs // max(1, len(ids)), n, pa.int64()),
                    _lists(runs, document[head] if len(head) else head, n, pa.int64()),
                ],
                fields=list(_ARROW),
            )
        )
    return pa.concat_arrays(parts) if parts else pa.array([], _ARROW)


def _finder(shared):
    @F.arrow_udf(RESULT)
    def found(column: pa.Array) -> pa.Array:
        return find(shared.value, column)

    return found


def _blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items with an id and a text, in blocks whose size is bounded."""
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes)
    for b in range(n):
        block = rows.where(F.pmod(F.xxhash64("i"), F.lit(n)) == b) if n > 1 else rows
        yield sorted((r.i, r.t) for r in block.collect())


def contamination(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, shingle: int = 5, containment: float = 1.0, block_bytes: int = 4 << 20, into: str = "contamination") -> DataFrame:
    """`docs` with a struct column `into`: n_words, n_hit, items (sorted item ids) and runs
    ([first word, end word) of each maximal run of hit words).

    containment: the share of a window's distinct shingles that must lie within as many
    consecutive words of a document; at 1 the words themselves must agree, in order.
    Item ids are integers. Defined cases: a null or empty text has no words; an item without words, id or text has
    no windows; equal item ids count once; without items nothing is hit; other columns of
    `docs` stay, one named like `into` is replaced.
    """
    texts = docs.select(F.col(text))
    columns = []
    for b, block in enumerate(_blocks(items, item_id, item_text, block_bytes)):
        index = Index(block, window, shingle, containment)
        frequency = {n: np.zeros(len(index.keys[n]), np.int64) for n in index.widths}
        counted = texts.mapInArrow(lambda batches, index=index: _count(index, batches), "width int, key long, n long")
        for r in counted.groupBy("width", "key").agg(F.sum("n").alias("n")).collect():  # one row at most for each shingle of the block
            frequency[r.width][r.key] = r.n
        index.order(frequency)
        columns.append(_finder(docs.sparkSession.sparkContext.broadcast(index)))
    if not columns:
        columns.append(_finder(docs.sparkSession.sparkContext.broadcast(Index([], window, shingle, containment))))
    if len(columns) == 1:
        return docs.withColumn(into, columns[0](F.col(text)))
    # One pass for each block; rows are told apart by their text, of which only a hash is kept.
    key = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    hits = None
    for f in columns:
        part = saved(docs.select(key.alias("k"), f(F.col(text)).alias("x")).where("x.n_hit > 0").groupBy("k").agg(F.first("x").alias("x")), "contamination")
        hits = part if hits is None else hits.unionByName(part)
    flat = lambda name: F.flatten(F.collect_list(f"x.{name}"))  # noqa: E731  one row a block
    hits = hits.groupBy("k").agg(F.sort_array(F.array_distinct(flat("items"))).alias("items"), F.sort_array(flat("runs")).alias("all"))
    joined = F.aggregate("all", F.array().cast("array<array<bigint>>"), lambda acc, r: F.when((F.size(acc) > 0) & (F.element_at(F.element_at(acc, -1), -1) >= r[0]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.array(F.element_at(acc, -1)[0], F.greatest(F.element_at(acc, -1)[1], r[1]))))).otherwise(F.concat(acc, F.array(r))))
    own, other, found, covered = unused(docs, "__key", "__k", "__items", "__runs")
    hits = hits.select(F.col("k").alias(other), F.col("items").alias(found), joined.alias(covered))
    count = F.size(F.expr(r"regexp_extract_all(lower(coalesce(`%s`, '')), '[0-9a-z\\x{80}-\\x{10FFFF}]+', 0)" % text)).cast("long")
    empty = F.array().cast("array<bigint>")
    sized = F.aggregate(F.col(covered), F.lit(0).cast("long"), lambda acc, r: acc + r[1] - r[0])
    answer = F.struct(count.alias("n_words"), F.coalesce(sized, F.lit(0).cast("long")).alias("n_hit"), F.coalesce(found, empty).alias("items"), F.coalesce(covered, F.array().cast("array<array<bigint>>")).alias("runs"))
    return docs.withColumn(own, key).join(hits, F.col(own) == F.col(other), "left").withColumn(into, answer).drop(own, other, found, covered)


def is_contaminated(column: str = "contamination"):
    """A document is contaminated if a twentieth of its words or more are hit."""
    return (F.col(f"{column}.n_hit") > 0) & (20 * F.col(f"{column}.n_hit") >= F.col(f"{column}.n_words"))
