"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

Each source's documents, in an order shuffled by hash, are one stream of words, cut into
blocks of `block` words. The points of a golden-ratio sequence are mapped through the
sources' cumulative weights: point i is a slot of the mix for the source whose interval it
falls into, and the slot's rank among that source's slots says which block of the stream it
takes, over again when the stream has been used up. A source takes its target's words
exactly: slots beyond that are left out, and the few that the sequence is short of follow at
the end.

Ranks and running totals are counted within buckets and added to the buckets' offsets, so no
source and no schedule is ever ordered in one task, and sources may be as many as documents:
they are a table too, and only totals over all of them are collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.enrich import small
from .common import saved, unused

#: The sequence's period, and its step: the odd integer nearest to period / golden ratio.
PERIOD = 1 << 31
STEP = 1327217885


def words_in(text: Column) -> Column:
    """The number of runs of characters other than 09-0D and 20."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _in_order(df: DataFrame, by: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """The rows in the order of `by` with their number `nth`, from 0, and for each of `sums` what
    it adds up to over the rows before. Partitions are ranges of that order; their totals, a row
    for each, are added to what is counted within each."""
    rows = saved(df.orderBy(*by).withColumn("__m", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("__p", F.shiftright("__m", 33))
    sums = {"nth": F.lit(1)} | sums
    own = rows.groupBy("__p").agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    ahead = Window.partitionBy(F.lit(0)).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    base = own.select(F.col("__p").alias("__q"), *[F.coalesce(F.sum(k).over(ahead), F.lit(0)).alias(f"__{k}") for k in sums])
    within = Window.partitionBy("__p").orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(F.broadcast(base), F.col("__p") == F.col("__q"))
    return out.withColumns({k: F.col(f"__{k}") + F.coalesce(F.sum(c).over(within), F.lit(0)) for k, c in sums.items()}).drop("__m", "__p", "__q", *[f"__{k}" for k in sums])


def shares(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, block: int = 1024) -> DataFrame:
    """For a table (source, n), each source once: (s, source, source_size, target, take, blocks,
    slots, first). s numbers the sources by code point, null last; target is the words it should
    give, take those whole, blocks those of its stream, slots those it takes, first the slots of the sources before.

    The weights repeat over the sources and share the sum of all sizes. A target stops at `most`
    times its source's size, and what it leaves is shared by weight among the others: so, in the
    order of size by weight, all up to some source stop there, and the rest share what is left.
    """
    weight = F.get(F.lit([float(w) for w in weights]), (F.col("s") % len(weights)).cast("int"))
    rows = _in_order(sizes, [F.col("source").isNull(), F.col("source")], {}, "mix-sources").withColumnRenamed("nth", "s").withColumn("w", weight)
    cap = F.lit(most) * F.col("n")
    ranked = _in_order(rows, [cap / F.col("w"), F.col("s")], {"capped": cap, "spent": F.col("w")}, "mix-ranked")
    total = ranked.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    left, whole = F.lit(float(total.n or 0)) - F.col("capped"), F.lit(float(total.w or 0)) - F.col("spent")
    open_ = ranked.where(cap * whole >= left * F.col("w")).agg(F.min_by(F.struct(left.alias("left"), whole.alias("whole"), F.col("nth")), "nth").alias("x")).first().x
    share = F.lit(open_.left) * F.col("w") / F.lit(open_.whole) if open_ else F.lit(0.0)
    target = F.when(F.col("nth") < (open_.nth if open_ else 1 << 62), cap.cast("double")).otherwise(share)
    ranked = ranked.withColumn("target", target).withColumn("take", F.least(F.rint("target").cast("long"), cap)).withColumn("blocks", F.ceil(F.col("n") / block))
    of = lambda words: F.ceil(words / block)
    slots = F.when(F.col("n") == 0, 0).otherwise(F.floor(F.try_divide("take", "n")) * F.col("blocks") + of(F.try_mod("take", "n"))).cast("long")
    found = ranked.withColumn("slots", slots).select("s", "source", F.col("n").alias("source_size"), "target", "take", "blocks", "slots")
    return saved(_in_order(found, [F.col("s")], {"first": F.col("slots")}, "mix-numbered").drop("nth"), "mix-shares")


def _before(rows: DataFrame, group: list[str], bucket: str, order: list, value: Column) -> DataFrame:
    """`rows` with `before`: the sum of `value` over the rows of the same `group` that come
    earlier, by `bucket` and then `order`. Each bucket is summed apart from the others."""
    keys = [*group, bucket]
    totals = rows.groupBy(*keys).agg(F.sum(value).alias("__n"))
    ahead = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offset = totals.select(*[F.col(k).alias(f"__{k}") for k in keys], F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__base"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("__own", F.coalesce(F.sum(value).over(within), F.lit(0)))
    joined = own.join(offset, [F.col(k) == F.col(f"__{k}") for k in keys])
    return joined.withColumn("before", F.col("__base") + F.col("__own")).drop("__own", "__base", *[f"__{k}" for k in keys])


@dataclass
class Mix:
    """sized: doc_id, s (number of its source), size. shares: as of shares()."""

    sized: DataFrame
    shares: DataFrame
    block: int
    buckets: int

    @property
    def spark(self) -> SparkSession:
        return self.sized.sparkSession

    def schedule(self) -> DataFrame:
        """(position, s, rank, epoch, block, words): the slots of the mix, in order of position."""
        sources = self.shares
        count = sources.agg(F.count("*").alias("n"), F.sum("slots").alias("slots")).first()
        total = count.slots or 0
        # Each source's interval of the period, under every cell of it that it reaches into.
        bits = max(8, (count.n or 1).bit_length())
        edge = lambda slots: F.floor(slots * F.lit(PERIOD).cast("decimal(20,0)") / max(1, total)).cast("long")
        cell = lambda u: F.shiftright(u, PERIOD.bit_length() - 1 - bits)
        spans = sources.where("slots > 0").select("s", edge(F.col("first")).alias("low"), edge(F.col("first") + F.col("slots")).alias("high"))
        cells = spans.where("high > low").withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1))))
        points = self.spark.range(total).withColumn("u", F.pmod(F.pmod("id", F.lit(PERIOD)) * F.lit(STEP), F.lit(PERIOD)))
        slots = points.withColumn("cell", cell(F.col("u"))).join(small(cells), "cell").where("low <= u and u < high")
        slots = slots.select("id", "s", F.floor(F.col("id") * self.buckets / max(1, total)).cast("int").alias("bucket"))
        sources = small(sources)
        ranked = _before(slots, ["s"], "bucket", ["id"], F.lit(1)).select(F.col("id").alias("position"), "s", F.col("before").alias("rank"))
        got = slots.groupBy("s").agg(F.count("*").alias("got"))
        short = sources.join(got, "s", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < slots")
        late = short.select("s", F.explode(F.sequence("got", F.col("slots") - 1)).alias("rank")).select((F.col("rank") + total).alias("position"), "s", "rank")
        epoch, k = F.floor(F.col("rank") / F.col("blocks")), F.col("rank") % F.col("blocks")
        start = F.col("epoch") * F.col("source_size") + F.col("block") * self.block
        taken = ranked.unionByName(late).join(sources, "s").where("rank < slots").withColumn("epoch", epoch.cast("long")).withColumn("block", k)
        full = F.least(F.lit(self.block).cast("long"), F.col("source_size") - F.col("block") * self.block)
        return taken.select("position", "s", "rank", "epoch", "block", F.least(full, F.col("take") - start).alias("words"), full.alias("full"))

    def placed(self) -> DataFrame:
        """(doc_id, s, size, bucket, a, taken): the documents with words, by their place in the source's stream."""
        some = self.sized.where("size > 0").withColumn("bucket", F.pmod(F.col("h"), F.lit(self.buckets)).cast("int"))
        placed = _before(some, ["s"], "bucket", ["h", "doc_id", "size"], F.col("size")).select("doc_id", "s", "size", "bucket", F.col("before").alias("a"))
        first, last = F.floor(F.col("a") / self.block), F.floor((F.col("a") + F.col("size") - 1) / self.block)
        pieces = placed.withColumn("block", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
        used = self.schedule().groupBy("s", "block").agg(F.sum((F.col("words") == F.col("full")).cast("long")).alias("whole"), F.max(F.when(F.col("words") < F.col("full"), F.col("words"))).alias("part"))
        base = F.col("block") * self.block
        low, high = F.greatest("a", base), F.col("a") + F.col("size")
        overlap = F.least(high, base + self.block) - low
        partly = F.greatest(F.lit(0), F.least(high, base + F.coalesce("part", F.lit(0))) - low)
        joined = pieces.join(used, ["s", "block"], "left").withColumn("taken", F.coalesce("whole", F.lit(0)) * overlap + partly)
        return joined.groupBy("doc_id", "s", "size", "bucket", "a").agg(F.sum("taken").alias("taken"))

    def documents(self) -> DataFrame:
        """(doc_id, source, size, source_size, target, taken), a row for each document."""
        none = self.sized.where("size = 0").select("doc_id", "s", "size", F.lit(0).cast("long").alias("taken"))
        named = self.placed().select("doc_id", "s", "size", "taken").unionByName(none).join(small(self.shares), "s")
        return named.select("doc_id", "source", "size", "source_size", "target", "taken")

    def copies(self) -> DataFrame:
        """(doc_id, copies): the documents that the mix takes at least once, and how often as a whole.

        Along the stream, among documents of the source whose sizes have the same number of
        binary digits, what a copy has too much or too little is carried to the next document. So
        a source's words differ from what is taken by one document of each such class at most,
        which is less than twice the longest of them all.
        """
        one = 1 << 20  # parts of a copy; whole numbers, so sums don't depend on their order
        rows = self.placed().withColumn("share", F.floor(F.col("taken") * one / F.col("size")).cast("long"))
        rows = _before(rows.withColumn("class", F.length(F.bin("size"))), ["s", "class"], "bucket", ["a"], F.col("share"))
        upto = lambda c: F.floor((c + one // 2) / one)
        return rows.withColumn("copies", (upto(F.col("before") + F.col("share")) - upto(F.col("before"))).cast("int")).where("copies > 0").select("doc_id", "copies")


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), most: int = 3, block: int = 1024, seed: int = 0) -> Mix:
    """The mix of all of `docs`.

    Defined cases: a null text has size 0 and is never taken; null is a source of its own;
    documents that agree in id, source and size share what those places of the stream take;
    an empty table gives an empty mix; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = saved(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words_in(F.col(text)).alias("size")).withColumn("h", F.xxhash64("doc_id", "size", F.lit(seed))), "mix")  # by size too, as many may have no id
    found = shares(rows.groupBy("source").agg(F.sum("size").alias("n")), weights, most, block)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = small(found.select("s", F.col("source").alias("name")))
    sized = rows.join(numbered, F.col("source").eqNullSafe(F.col("name"))).select("doc_id", "s", "size", "h")
    return Mix(sized, found, block, buckets)


def mixed(docs: DataFrame, *, doc_id: str = "doc_id", **settings) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, as whole documents: see Mix.copies().
    Rows with the same id come as often as the one of them that is taken most."""
    often = mix(docs, doc_id=doc_id, **settings).copies()
    key, times, each = unused(docs, "__id", "__times", "__i")
    often = often.groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(times))
    out = docs.join(often, F.col(doc_id).eqNullSafe(F.col(key)))
    return out.withColumn(each, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(key, times, each)
