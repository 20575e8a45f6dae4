"""The local address match as a run: cached indexes, resumable batches, one output."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession

from ..operators import match
from ..schema import INDEX
from ..sinks import files
from ..sources import geopackage
from ..sources.tables import MissingInput
from ..streaming import Stop, match_batches, todo

log = logging.getLogger(__name__)

#: The columns of an address layer.
COLUMNS = ["postcode:pt-Latn", "housenumber", "street:pt-Latn", "city:pt-Latn", "suburb:pt-Latn"]


def cached_index(spark: SparkSession, package: str, cache_dir: str, *, force: bool = False) -> DataFrame:
    """The index of a package's points, made once. A cached one counts if it was committed and has a row."""
    path = f"{cache_dir}/index_{PurePath(package).stem}_v2.parquet"
    if not force and files.done(spark, path):
        index = spark.read.schema(INDEX).parquet(path)
        if index.limit(1).count():
            return index
        log.warning("%s is empty and is made again", path)
    files.write_parquet(match.build_index(geopackage.points(spark, package, COLUMNS)), path)
    return spark.read.schema(INDEX).parquet(path)


def indexes(spark: SparkSession, packages: list[str], cache_dir: str, *, force: bool = False) -> DataFrame:
    """The cached indexes of all packages, as one."""
    if not packages:
        raise MissingInput("no address package is given")
    return reduce(DataFrame.unionByName, [cached_index(spark, p, cache_dir, force=force) for p in packages])


def run(spark: SparkSession, joined: str, packages: list[str], cache_dir: str, out: str, *, ufs: list[str] | None = None, batches: int = 16, threshold: float = 0.90, force: bool = False, stop: Callable[[], bool] = lambda: False) -> DataFrame:
    """All rows (of the given states) with what the layers found. Batches that an earlier run
    finished are kept; rows without a match are tried again with the next index."""
    if not files.done(spark, joined):
        raise MissingInput(joined)
    if files.done(spark, out) and not force:
        return spark.read.parquet(out)
    pois = spark.read.parquet(joined)
    if ufs:
        pois = pois.where(pois.uf.isin(*ufs))
    index = indexes(spark, packages, cache_dir, force=force)
    folder = f"{out}.progress"
    thresholds = match.Thresholds(street=threshold)
    found = match_batches(match.normalise_pois(pois), index, folder, batches=batches, match=lambda p, i: match.cascade(p, i, t=thresholds), stop=stop)
    if stop():
        return match.located(pois, found)
    log.info("%d rows without a match", todo(pois, folder).count())
    files.write_parquet(match.located(pois, found), out)
    return spark.read.parquet(out)


def main(argv: list[str] | None = None) -> int:
    from ..session import log_to, session

    p = argparse.ArgumentParser(prog="tessera-match")
    p.add_argument("--joined", required=True)
    p.add_argument("--package", nargs="+", required=True)
    p.add_argument("--cache", default="data/cache")
    p.add_argument("--out", required=True)
    p.add_argument("--uf", nargs="*")
    p.add_argument("--batches", type=int, default=16)
    p.add_argument("--threshold", type=float, default=0.90)
    p.add_argument("--force", action="store_true")
    p.add_argument("--log-dir", default="data/log")
    a = p.parse_args(argv)
    log_to(a.log_dir)
    try:
        with Stop() as stop:
            got = run(session(), a.joined, a.package, a.cache, a.out, ufs=a.uf, batches=a.batches, threshold=a.threshold, force=a.force, stop=stop)
            if stop():
                return 130
    except MissingInput as e:
        log.error("%s", e)
        return 1
    match.summary(got).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
