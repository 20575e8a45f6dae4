"""Document fingerprints: bottom-k sketches of word shingles; DataFrame functions only.

A sketch is the sorted array of the k least XXH64 hashes of a text's distinct shingles. The
sketch of a union is that of the hashes of its parts' sketches, so sketches merge; from two
of them resemblance, containment and numbers of distinct shingles are estimated, and are
exact where both texts have at most k shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import unused

K, SHINGLE = 128, 5


def with_sketch(df: DataFrame, text: Column, into: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """`df` with the sketch of `text`: lower-cased words between runs of 09-0D and 20, in
    shingles of `shingle`; fewer words are one shingle, none give an empty sketch."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes, made = unused(df, "__w", "__s")
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    w = F.col(hashes)
    many = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (shingle - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get(w, i + j) for j in range(1, shingle))))
    df = df.withColumn(made, F.when(F.size(w) >= shingle, many).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")))
    return df.withColumn(into, F.slice(F.sort_array(F.array_distinct(made)), 1, k)).drop(hashes, made)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of common shingles among all of both texts; 1 where neither has any."""
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    common = F.size(F.array_intersect(F.array_intersect(least, a), b))
    return F.when(F.size(least) == 0, 1.0).otherwise(common / F.size(least))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles."""
    place = (F.element_at(a, -1).cast("double") + F.lit(float(1 << 63))) / F.lit(float(1 << 64))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / F.greatest(place, F.lit(2.0**-64)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of a's shingles that b has too; 1 where a has none."""
    j, x, y = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), j / (1 + j) * (x + y) / x))


def merged(df: DataFrame, by: list[str], sketch: str, k: int = K) -> DataFrame:
    """The sketch of each group's union. Every task keeps the k least hashes of a group before
    anything moves, so a group with very many rows is no larger than one with few."""
    least = Window.partitionBy(*by).orderBy("__h")
    hashes = df.select(*by, F.explode_outer(sketch).alias("__h"))
    kept = hashes.withColumn("__r", F.dense_rank().over(least)).where(F.col("__r") <= k + 1)  # null, if any, ranks first
    return kept.groupBy(*by).agg(F.slice(F.sort_array(F.collect_set("__h")), 1, k).alias(sketch))


def in_hex(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sketch: bool = False) -> DataFrame:
    """(doc_id, text, next_text): null texts are empty; next is the next smaller doc_id, and
    for the smallest the largest. Null ids are smaller than all, equal ones go by their texts' hashes.
    With `sketch` also text_sketch and next_sketch, for which each text is sketched once.

    Documents are dealt to buckets of neighbouring ids, by quantiles, and ordered there. The
    first of each bucket also goes, as a guest, to the end of the one before. Whole texts
    move once; a row for each bucket is all that is collected and broadcast.
    """
    spark = docs.sparkSession
    n = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("i"))
    cuts = ids.agg(F.percentile_approx("i", [j / n for j in range(1, n)], 100 * n).alias("q")).first().q or []
    cuts = sorted(set(cuts))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("i"))

    def dealt(df: DataFrame) -> DataFrame:
        """bucket: how many of the cuts are below the id, by halving."""
        df = df.withColumn("bucket", F.lit(0))
        for step in (1 << j for j in reversed(range(len(cuts).bit_length()))):
            df = df.withColumn("bucket", F.col("bucket") + F.when((F.col("bucket") + step <= len(cuts)) & (F.get(F.lit(cuts), F.col("bucket") + (step - 1)) < F.col("i")), step).otherwise(0))
        return df

    first = sorted((r.bucket, r.i) for r in dealt(ids).groupBy("bucket").agg(F.max("i").alias("i")).collect())  # a row for each bucket
    hosts = [(i, first[(j + 1) % len(first)][0]) for j, (_, i) in enumerate(first)]
    guests = F.broadcast(spark.createDataFrame(hosts, "g long, host int"))
    home = F.struct(F.col("bucket"), F.lit(0).alias("guest"))
    places = F.when(F.col("host").isNull(), F.array(home)).otherwise(F.array(home, F.struct(F.col("host").alias("bucket"), F.lit(1).alias("guest"))))
    spread = dealt(rows).join(guests, F.col("i") == F.col("g"), "left").withColumn("at", F.explode(places))
    spread = spread.select("doc_id", "text", "i", F.col("at.bucket").alias("bucket"), F.col("at.guest").alias("guest"))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("i"), F.xxhash64("text"))
    if not sketch:
        return spread.withColumn("next_text", F.lead("text").over(order)).where("guest = 0").select("doc_id", "text", "next_text")
    made = with_sketch(spread.repartition("bucket"), F.col("text"), "text_sketch")  # after texts have moved, so sketches don't
    placed = made.withColumns({"next_text": F.lead("text").over(order), "next_sketch": F.lead("text_sketch").over(order)})
    return placed.where("guest = 0").select("doc_id", "text", "next_text", "text_sketch", "next_sketch")


def edited(text: Column, following: Column) -> Column:
    """The last third of the text's code points, rounded down, replaced by the first as many of the next text."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.left(text, n - third), F.left(following, third))
