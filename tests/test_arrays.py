"""Running sums and counts against Python's own."""

import random

from pyspark.sql import functions as F

from tessera.functions.arrays import below, let, running


def test_sums_and_counts(spark):
    rng = random.Random(14)
    rows = [(sorted(rng.randrange(50) for _ in range(n)),) for n in (0, 1, 2, 3, 7, 8, 9, 100)]
    df = spark.createDataFrame(rows, "v array<int>").select("v", running(F.col("v")).alias("s"), F.transform(F.lit([-1, 0, 5, 25, 60]), lambda x: below(F.col("v"), x)).alias("b"), F.transform(F.lit([5, 49]), lambda x: below(F.col("v"), x, equal=True)).alias("e"))
    for r in df.collect():
        assert r.s == [sum(r.v[: i + 1]) for i in range(len(r.v))]
        assert r.b == [sum(v < x for v in r.v) for x in (-1, 0, 5, 25, 60)] and r.e == [sum(v <= x for v in r.v) for x in (5, 49)]


def test_let(spark):
    assert spark.range(3).select(let(F.col("id") + 1, lambda x: x * x).alias("y")).orderBy("y").collect() == [(1,), (4,), (9,)]
