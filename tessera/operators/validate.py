"""Accuracy against a reference geocoder: samples, distances and before/after comparisons."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import haversine_m
from ..functions.arrays import below
from ..schema import LAYERS

#: Half-open ranges of distances in metres, and their labels.
BUCKETS = [(0, 50, "<50 m"), (50, 200, "50-200 m"), (200, 500, "200-500 m"), (500, 1000, "500 m-1 km"), (1000, 5000, "1-5 km"), (5000, None, ">5 km")]
RANGES = 256
QUANTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def strata(df: DataFrame, column: str = "geo_precision", values: tuple[str, ...] | None = LAYERS) -> DataFrame:
    """Rows by stratum, largest first; those without coordinates don't count."""
    if values:
        df = df.where(F.col(column).isin(*values) & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def allocate(counts: Mapping[str, int], n: int) -> dict[str, int]:
    """How many of a sample of n each stratum gives: in proportion (halves to even), one at
    least and all it has at most. What the rounded shares have too many comes off the largest
    ones, one row each staying; what they lack goes to the strata in the order of `counts`."""
    total = sum(counts.values())
    if not total:
        return dict.fromkeys(counts, 0)
    share = {k: min(c, max(1, round(n * c / total))) for k, c in counts.items()}
    lack = n - sum(share.values())
    if lack > 0 and total < n:
        return share
    # Room of each stratum to be corrected by, in the order of correction; each takes what those before it leave.
    if lack < 0:
        room = [(k, share[k] - 1) for k in sorted(share, key=share.__getitem__, reverse=True)]
    else:
        room = [(k, c - share[k]) for k, c in counts.items()]
    before = accumulate((r for _, r in room), initial=0)
    moved = {k: min(r, max(0, abs(lack) - b)) for (k, r), b in zip(room, before, strict=False)}
    return {k: m + (moved[k] if lack > 0 else -moved[k]) for k, m in share.items()}


def sample(df: DataFrame, share: Mapping[str, int], column: str, id: str, seed: int = 0, order: Column | None = None) -> DataFrame:
    """The allotted number of rows of each stratum, the same ones for the same seed: those whose
    id hashes are least."""
    limit = F.lit(0)
    for k, m in share.items():
        limit = F.when(F.col(column) == k, m).otherwise(limit)
    rank = Window.partitionBy(column).orderBy(order if order is not None else F.xxhash64(F.col(id), F.lit(seed)), id)
    return df.where(limit > 0).withColumn("__row", F.row_number().over(rank)).where(F.col("__row") <= limit).drop("__row")


def with_distance(df: DataFrame, into: str = "distance_m", a: tuple[str, str] = ("apt_lat", "apt_lon"), b: tuple[str, str] = ("tt_lat", "tt_lon")) -> DataFrame:
    return df.withColumn(into, haversine_m(*(F.col(c) for c in (*a, *b))))


def distance_stats(df: DataFrame, column: str = "distance_m", by: list[str] | None = None, total: str | None = None) -> DataFrame:
    """n, mean, population deviation, extremes, quantiles and counts below 50 m and from 5 km
    up, by the columns `by`; with `total`, also over all rows, under that name.

    A quantile p of n sorted values is the one at index int(p * n). Equal values are one row
    with a count; each group's are cut into ranges at its approximate quantiles, so that ranges
    have about as many rows each whatever the distribution, and a task sorts one range only.
    """
    d = F.col(column)
    rows = df.where(d.isNotNull()).select(*(by or []), d.alias("__d"))
    if not by:
        by, rows = ["__all"], rows.withColumn("__all", F.lit("ALL"))
    if total:
        rows = rows.unionByName(rows.select(*[F.lit(total).alias(c) for c in by], "__d"))
    # Equal values share a row from here on; their running count gives each one's first and last index.
    counts = rows.groupBy(*by, "__d").agg(F.count("*").alias("__c"))
    size = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg("__d").alias("mean"), F.stddev_pop("__d").alias("std"), F.min("__d").alias("min"), F.max("__d").alias("max"),
        F.count_if(F.col("__d") < 50).alias("below_50"), F.count_if(F.col("__d") >= 5000).alias("from_5000"),
    )
    cuts = counts.groupBy(*by).agg(F.array_distinct(F.percentile_approx("__d", [i / RANGES for i in range(1, RANGES)], 10 * RANGES)).alias("__cuts"))
    cells = counts.join(size.select(*by, F.col("n").alias("__n")), by).join(cuts, by).withColumn("__r", below(F.col("__cuts"), F.col("__d"))).drop("__cuts")
    ranges = cells.groupBy(*by, "__r").agg(F.sum("__c").alias("__m"))
    ahead = Window.partitionBy(*by).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__base", F.coalesce(F.sum("__m").over(ahead), F.lit(0))).drop("__m")
    inside = Window.partitionBy(*by, "__r").orderBy("__d").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.join(ranges, [*by, "__r"]).withColumn("__first", F.col("__base") + F.coalesce(F.sum("__c").over(inside), F.lit(0)))
    at = lambda p: F.floor(F.lit(p) * F.col("__n"))
    picked = placed.groupBy(*by).agg(*[F.max(F.when((F.col("__first") <= at(p)) & (at(p) < F.col("__first") + F.col("__c")), F.col("__d"))).alias(k) for k, p in QUANTILES.items()])
    return size.join(picked, by).drop("__all")


def buckets(df: DataFrame, column: str = "distance_m") -> DataFrame:
    """Rows and percent in each range of BUCKETS, empty ones included."""
    spark, d = df.sparkSession, F.col(column)
    label = F.lit(None).cast("int")
    for i, (low, high, _) in enumerate(BUCKETS):
        label = F.when((d >= low) & (F.lit(True) if high is None else d < high), i).otherwise(label)
    counts = df.where(d.isNotNull()).groupBy(label.alias("__i")).agg(F.count("*").alias("__n"))
    names = spark.createDataFrame([(i, name) for i, (*_, name) in enumerate(BUCKETS)], "bucket int, label string")
    n = F.coalesce("__n", F.lit(0))
    all_ = F.sum(n).over(Window.partitionBy())
    return names.join(counts, F.col("bucket") == F.col("__i"), "left").select("bucket", "label", n.alias("n"), F.try_divide(100.0 * n, all_).alias("percent"))


def layer_stats(df: DataFrame, column: str = "geo_precision", distance: str = "distance_m", layers: tuple[str, ...] = LAYERS) -> DataFrame:
    """n, mean and deviation of each layer that has distances, in the layers' order."""
    place = F.array_position(F.lit(list(layers)), F.col(column))
    d = F.col(distance)
    return df.where(d.isNotNull() & F.col(column).isin(*layers)).groupBy(column).agg(F.count(d).alias("n"), F.avg(d).alias("mean"), F.stddev_pop(d).alias("std")).orderBy(place)


def outcome(df: DataFrame, distance: str = "distance_m", error: str = "tt_error") -> DataFrame:
    """One row: rows, matched, match rate in percent (null without rows), no result, errors."""
    d, e = F.col(distance), F.col(error)
    bad = e.isNotNull() & (e != "")
    return df.agg(
        F.count("*").alias("n"), F.count(d).alias("matched"), F.try_divide(100.0 * F.count(d), F.count("*")).alias("match_rate"),
        F.count_if(e == "no_results").alias("no_result"), F.count_if(bad & (e != "no_results")).alias("errors"),
    )


def compare(old: DataFrame, new: DataFrame, id: str = "cnpj") -> DataFrame:
    """Old rows (id, old_precision, old_lat, old_lon, old_distance_m, ref_lat, ref_lon) with the new
    match of each, its distance from the same reference, and the difference, null if either is."""
    side = new.select(F.col(id).alias("__id"), F.col("lat").alias("new_lat"), F.col("lon").alias("new_lon"), F.col("geo_precision").alias("new_precision"))
    out = old.join(side, F.col(id) == F.col("__id"), "left").drop("__id")
    out = out.withColumn("new_distance_m", haversine_m(F.col("new_lat"), F.col("new_lon"), F.col("ref_lat"), F.col("ref_lon")))
    return out.withColumn("delta_m", F.col("new_distance_m") - F.col("old_distance_m"))


def moves(df: DataFrame, old: str = "old_precision", new: str = "new_precision", none: str = "none") -> DataFrame:
    """How many rows went from one layer to another, the most frequent first."""
    a, b = F.coalesce(F.col(old), F.lit(none)), F.coalesce(F.col(new), F.lit(none))
    return df.where(a != b).groupBy(a.alias(old), b.alias(new)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), old, new)


def gained_dropped(old: DataFrame, new: DataFrame, id: str = "cnpj") -> DataFrame:
    """One row: ids that only the new match has, and that only the old one had."""
    a, b = old.select(id).distinct(), new.select(id).distinct()
    gained, dropped = b.join(a, id, "left_anti"), a.join(b, id, "left_anti")
    return gained.select(F.lit(1).alias("g")).unionByName(dropped.select(F.lit(0).alias("g"))).agg(F.count_if(F.col("g") == 1).alias("gained"), F.count_if(F.col("g") == 0).alias("dropped"))


def coordinates_as_text(df: DataFrame, metres: list[str], degrees: list[str]) -> DataFrame:
    """Metres with one decimal and degrees with seven, empty where null."""
    for columns, form in ((metres, "%.1f"), (degrees, "%.7f")):
        for c in columns:
            df = df.withColumn(c, F.when(F.col(c).isNull(), "").otherwise(F.format_string(form, F.col(c))))
    return df
