"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

Distinct fingerprints are cut into tiles by population count (bands one wider than the
radius, so that only equal and neighbouring bands can link) and by hash within a band. Every
remaining pair of tiles is one row: numpy sorts both sides by the population counts of their
four 16-bit lanes, skips all pairs of blocks whose counts differ by more than the radius,
and compares the rest by exclusive-or and bit counts. A task returns a spanning star for
each of its classes, never the pairs of a group; alternating large and small stars join
them across tiles. Comparisons grow with the square of the distinct fingerprints, divided by
what the population counts skip; all else grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, unused, utf8

SEED = 42


def fingerprint(raw: bytes, k: int) -> int:
    """The SimHash of a text's UTF-8 bytes, from the XXH64 of its k-word shingles."""
    words = raw.lower().split()  # of bytes: A-Z only, and white space 09-0D and 20 only
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - k + 1)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = [0, *(end[: n - 1] + 1).tolist()]
    last = end[min(k, len(words)) - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)], strict=False)], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for part in range(0, len(bits), 255):
            ones += bits[part : part + 255].sum(0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fingerprint", k: int = 4) -> DataFrame:
    """`docs` with the SimHash of each text as a long; null and empty texts get 0."""

    @F.arrow_udf("bigint")
    def of(column: pa.Array) -> pa.Array:
        data, offsets = utf8(column)
        bounds = offsets.tolist()
        out = [fingerprint(data[a:b].tobytes(), k) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.array(np.array(out, np.uint64).view(np.int64), pa.int64())

    return docs.withColumn(into, of(F.col(text)))


class Classes:
    """Disjoint classes of 0 .. n-1, joined by whole arrays of links; the label is the least member."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[u], label[v]
            differ = a != b
            if not differ.any():
                return
            u, v, a, b = u[differ], v[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(nearer := label[label], label):
                label = nearer
            self.label = label


def _lanes(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def stars(a: np.ndarray, b: np.ndarray | None, radius: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(least, member) for the classes of the links between a and b, or within a where b is None."""
    own = b is None
    a = a[np.lexsort(_lanes(a).T[::-1])]
    b = a if own else b[np.lexsort(_lanes(b).T[::-1])]

    def bounds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lanes, first = _lanes(x), np.arange(0, len(x), block)
        return np.minimum.reduceat(lanes, first), np.maximum.reduceat(lanes, first)

    (low_a, high_a), (low_b, high_b) = bounds(a), bounds(b)
    classes, shift = Classes(len(a) if own else len(a) + len(b)), 0 if own else len(a)
    for i in range(len(low_a)):
        gap = np.maximum(0, np.maximum(low_a[i] - high_b, low_b - high_a[i])).sum(1)
        near = np.flatnonzero(gap <= radius)
        near = near[near >= i] if own else near
        x = a[i * block : (i + 1) * block]
        for part in range(0, len(near), 16):
            at = (near[part : part + 16, None] * block + np.arange(block)).ravel()
            at = at[at < len(b)]
            u, v = np.nonzero(np.bitwise_count(x[:, None] ^ b[at][None, :]) <= radius)
            u, v = u + i * block, at[v]
            if own:
                u, v = u[u < v], v[u < v]
            if len(u):
                classes.join(u, v + shift)
    whole = a if own else np.concatenate([a, b])
    member = np.flatnonzero(classes.label != np.arange(len(whole)))
    return whole[classes.label[member]], whole[member]


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in zip(batch.column(0), batch.column(1), strict=True):
            other = np.array(b.values, np.int64).view(np.uint64) if b.is_valid else None
            u, v = stars(np.array(a.values, np.int64).view(np.uint64), other, radius)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])


def links(unique: DataFrame, radius: int = 4, tile: int = 1 << 15, tiles: int = 2048, tasks: int = 1 << 17) -> DataFrame:
    """Links (u, v) whose classes are those of all pairs of `unique` fingerprints (column fp, each once) within the radius.

    A tile has `tile` fingerprints, or as many as make about `tiles` tiles; the pairs of tiles
    are a join of the table of tiles with itself by band, and each is a task's row, in `tasks` tasks at most.
    """
    spark = unique.sparkSession
    band = F.floor(F.bit_count("fp") / (radius + 1)).cast("int")
    count = {r.band: r.n for r in unique.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()}  # 65 rows at most
    size = max(tile, sum(count.values()) // tiles)
    slices = [(b, -(-n // size)) for b, n in sorted(count.items())]
    if not slices:
        return spark.createDataFrame([], "u long, v long")
    many, first, before = F.lit(0), F.lit(0), 0
    for b, n in slices:
        many, first, before = F.when(band == b, n).otherwise(many), F.when(band == b, before).otherwise(first), before + n
    packed = saved(unique.select(band.alias("band"), (first + F.pmod(F.xxhash64("fp"), many)).cast("int").alias("tile"), "fp").groupBy("band", "tile").agg(F.collect_list("fp").alias("fps")), "simhash-tiles")
    listed = packed.select("band", F.col("tile").alias("a"))
    near = listed.withColumn("other", F.explode(F.array("band", F.col("band") + 1))).select("a", "other")
    pairs = near.join(listed.select(F.col("band").alias("other"), F.col("a").alias("b")), "other").where("a <= b").select("a", "b")
    left, right = packed.select(F.col("tile").alias("a"), F.col("fps").alias("left")), packed.select(F.col("tile").alias("b"), F.col("fps").alias("right"))
    n = dict(slices)
    rows = pairs.join(left, "a").join(right, "b").repartition(min(sum(m * (m + 1) // 2 + m * n.get(b + 1, 0) for b, m in slices), tasks), "a", "b")
    rows = rows.select("left", F.when(F.col("a") != F.col("b"), F.col("right")).alias("right"))
    return rows.mapInArrow(lambda batches: _compare(batches, radius), "u long, v long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(v, root) for every v of `edges` (u, v) that isn't the least of its component.

    Alternating large and small stars; each round is written to the shared folder. Only
    minima are gathered by vertex, with partial aggregation, so a hub is no hot group.
    """

    def turned(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return turned(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))

    def small(e: DataFrame) -> DataFrame:
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        return turned(e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.toDF("u", "v")))

    edges, before = saved(turned(edges), name), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or state.n == 0:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        before, edges = state, saved(small(large(edges)), name)


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 4, radius: int = 4) -> DataFrame:
    """One row for each document: doc_id, fingerprint (long), component_id (the least doc_id
    that links of `radius` differing bits or fewer reach, itself included).

    Defined cases: null and empty texts have fingerprint 0 and link like any other; repeated
    rows come back as often as they are there; a null doc_id gets the component of its
    fingerprint, null only where all members' ids are null; other columns aren't returned.
    """
    rows = saved(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")), "t", "fp", k).select("doc_id", "fp"), "simhash")
    unique = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-unique")
    root = components(links(unique.select("fp"), radius), "simhash-components")
    # Only linked fingerprints take part in the next steps; the others are their own component.
    member = unique.join(root.select(F.col("v").alias("fp"), "root"), "fp").unionByName(
        unique.join(root.select(F.col("root").alias("fp")).distinct(), "fp").withColumn("root", F.col("fp"))
    )
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = member.select("fp", "root").join(least, "root").select("fp", "component_id")
    named = saved(unique.join(linked, "fp", "left").select("fp", "n", F.coalesce("component_id", "least").alias("component_id")), "simhash-named")
    return _joined(rows, named).select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def _joined(rows: DataFrame, named: DataFrame, share: int = 1024) -> DataFrame:
    """Each row with its fingerprint's component. Fingerprints with one of `share` of all rows or
    more, of which there are no more than `share`, are broadcast; none of the others is a hot key."""
    total = named.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * share >= total
    many = F.broadcast(named.where(hot).select("fp", "component_id", F.lit(True).alias("many")))
    marked = rows.join(many, "fp", "left")
    rest = marked.where("many is null").select(*rows.columns).join(named.where(~hot).select("fp", "component_id"), "fp")
    return marked.where("many").select(*rows.columns, "component_id").unionByName(rest.select(*rows.columns, "component_id"))


def keep_one(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents whose id is that of their component, each id once; those without an id stay."""
    (name,) = unused(docs, "__kept")
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(name))
    out = docs.join(kept, F.col(doc_id) == F.col(name), "left_semi").unionByName(docs.where(F.col(doc_id).isNull()))
    many, distinct = found.where("doc_id is not null").agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    return out if many == distinct else out.dropDuplicates([doc_id])
