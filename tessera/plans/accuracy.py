"""The validation loop: a stratified sample against a reference geocoder, and the same sample
again, without any request, after the match has changed."""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cep_key_strict
from ..operators import match, validate
from ..operators.geocode import street_line
from ..schema import LAYERS, RESAMPLE, VALIDATION
from ..sinks import slug, write_report
from ..sources import clients, tables
from .export import resolve
from .matching import indexes

log = logging.getLogger(__name__)

_POI = "cnpj razao_social uf municipio_descricao bairro tipo_logradouro logradouro numero complemento cep".split()


def locate(spark: SparkSession, patterns: list[str]) -> str:
    """The first of some paths or patterns that is there."""
    for p in patterns:
        if tables.exists(spark, p):
            return p
    raise tables.MissingInput(", ".join(patterns))


def draw(df: DataFrame, n: int = 300, seed: int = 0, column: str = "geo_precision") -> DataFrame:
    """About n located rows, allotted to the layers in proportion to their sizes."""
    counts = {r[column]: r.n for r in validate.strata(df, column).collect()}  # a row for each layer
    located = df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return validate.sample(located, validate.allocate(counts, n), column, "cnpj", seed)


def against(sample: DataFrame, client: clients.Client, retry: clients.Retry = clients.Retry()) -> DataFrame:
    """The sample's rows with the reference's first hit and the distance from it, in the report's
    columns; tt_error is `no_results` without a hit, `failed` without an answer."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    request = F.struct(
        F.lit("BRA").alias("countryCode"), F.lit(1).alias("limit"), street_line(F.col("tipo_logradouro"), F.col("logradouro")).alias("streetName"), blank("numero").alias("streetNumber"),
        cep_key_strict(F.col("cep")).alias("postalCode"), blank("municipio_descricao").alias("municipality"), blank("uf").alias("countrySubdivision"),
    )
    asked = clients.request(sample.select("cnpj", F.to_json(request).alias("parameters")), "cnpj", client, retry)
    at = lambda path: F.get_json_object("body", f"$.results[0].{path}")
    lat, lon = at("position.lat").try_cast("double"), at("position.lon").try_cast("double")
    error = F.when(F.col("state") == "failed", "failed").when(lat.isNull() | lon.isNull(), "no_results")
    hits = asked.select(F.col("cnpj").alias("__id"), lat.alias("tt_lat"), lon.alias("tt_lon"), at("score").try_cast("double").alias("tt_score"), at("type").alias("tt_type"), error.alias("tt_error"))
    rows = sample.withColumnsRenamed({"lat": "apt_lat", "lon": "apt_lon"}).join(hits, F.col("cnpj") == F.col("__id"), "left").drop("__id")
    return validate.with_distance(rows).select(*VALIDATION)


@dataclass
class Report:
    rows: DataFrame
    outcome: DataFrame
    distances: DataFrame
    buckets: DataFrame
    layers: DataFrame


def summarise(rows: DataFrame) -> Report:
    return Report(rows, validate.outcome(rows), validate.distance_stats(rows), validate.buckets(rows), validate.layer_stats(rows))


def run(df: DataFrame, client: clients.Client, path: str, n: int = 300, seed: int = 0, retry: clients.Retry = clients.Retry()) -> Report:
    """Sample, ask, write the report and return it with its statistics. They are of the report
    as it was written, so nothing is asked twice."""
    write_report(against(draw(df, n, seed), client, retry), path, VALIDATION)
    return summarise(read(df.sparkSession, path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """A report with its numbers as doubles."""
    df = tables.report(spark, path)
    numbers = [c for c in df.columns if c.endswith(("_lat", "_lon", "_m", "_score"))]
    return df.withColumns({c: F.col(c).try_cast("double") for c in numbers})


@dataclass
class Comparison:
    rows: DataFrame
    before: DataFrame
    after: DataFrame
    moves: DataFrame
    changes: DataFrame


def resample(spark: SparkSession, report: str, pois: DataFrame, index: DataFrame, path: str, thresholds: match.Thresholds = match.Thresholds()) -> Comparison:
    """Match the report's rows again, fuzzy layer included, and compare with what it says: the
    distances are from the stored reference coordinates."""
    old = read(spark, report)
    wanted = old.select(F.col("cnpj").alias("__id"))
    again = match.cascade(match.normalise_pois(pois.join(wanted, F.col("cnpj") == F.col("__id"), "left_semi")), index, t=thresholds, fuzzy=True)
    before = old.withColumnsRenamed({"geo_precision": "old_precision", "distance_m": "old_distance_m", "apt_lat": "old_apt_lat", "apt_lon": "old_apt_lon"})
    both = validate.compare(before.withColumn("ref_lat", F.col("tt_lat")).withColumn("ref_lon", F.col("tt_lon")), again)
    both = both.withColumnsRenamed({"new_lat": "new_apt_lat", "new_lon": "new_apt_lon"}).select(*RESAMPLE)
    text = validate.coordinates_as_text(both, ["old_distance_m", "new_distance_m", "delta_m"], ["old_apt_lat", "old_apt_lon", "new_apt_lat", "new_apt_lon", "tt_lat", "tt_lon"])
    write_report(text, path, RESAMPLE)
    rows = read(spark, path)
    side = lambda which: validate.distance_stats(rows.where(F.col(f"{which}_precision").isin(*LAYERS)), f"{which}_distance_m", [f"{which}_precision"], "ALL")
    have = lambda which: rows.where(F.col(f"{which}_precision").isin(*LAYERS)).select("cnpj")
    return Comparison(rows, side("old"), side("new"), validate.moves(rows), validate.gained_dropped(have("old"), have("new")))


def table_lines(df: DataFrame) -> list[str]:
    """A small table as aligned text, a line for each row."""
    rows = [df.columns, *[["" if v is None else f"{v:,.1f}" if isinstance(v, float) else str(v) for v in r] for r in df.collect()]]  # statistics: a few rows
    width = [max(map(len, c)) for c in zip(*rows, strict=True)]
    return ["  ".join(v.rjust(w) for v, w in zip(r, width, strict=True)) for r in rows]


def bars(df: DataFrame, label: str = "label", percent: str = "percent", width: int = 40) -> list[str]:
    """A line with a bar for each row, as long as its share of all."""
    rows = [(r[label], r[percent] or 0.0) for r in df.orderBy("bucket").collect()]  # a row for each range of distances
    return [f"{name:>12} {share:5.1f}% {'#' * round(width * share / 100)}" for name, share in rows]


def console(found: Report | Comparison) -> str:
    """A report or a comparison as the text that the commands print."""
    if isinstance(found, Report):
        parts = [("Outcome", table_lines(found.outcome)), ("Distances in metres", table_lines(found.distances)), ("Ranges", bars(found.buckets)), ("Layers", table_lines(found.layers))]
    else:
        parts = [("Before", table_lines(found.before)), ("After", table_lines(found.after)), ("Moves between layers", table_lines(found.moves)), ("Gained and dropped", table_lines(found.changes))]
    return "\n\n".join("\n".join([title, *lines]) for title, lines in parts)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera-accuracy", description="Located rows against a reference geocoder.")
    commands = p.add_subparsers(dest="command", required=True)
    for name, text in (("validate", "ask the reference for a sample of the rows"), ("resample", "match a report's rows again, without asking")):
        c = commands.add_parser(name, help=text)
        c.add_argument("--date", default="*", help="dump date; without it, any")
        c.add_argument("--source", help="the table; without it, the date's geocoded one, else its joined one")
        c.add_argument("--category", nargs="*", help="the table geocoded for these tags only")
        c.add_argument("--intermediate-dir", default="data/intermediate")
        c.add_argument("--out", required=True)
        c.add_argument("--log-dir", default="data/log")
    v, r = commands.choices["validate"], commands.choices["resample"]
    v.add_argument("--url", help="address of the reference geocoder")
    v.add_argument("--key", default="")
    v.add_argument("--n", type=int, default=300)
    v.add_argument("--seed", type=int, default=0)
    r.add_argument("--report", required=True, help="what validate wrote")
    r.add_argument("--package", nargs="+", required=True, help="address packages")
    r.add_argument("--cache-dir", default="data/cache")
    r.add_argument("--threshold", type=float, default=match.Thresholds().street)
    return p


def main(argv: list[str] | None = None, *, client: clients.Client | None = None, retry: clients.Retry = clients.Retry()) -> int:
    """The command: 0, or 1 where an input is missing."""
    from ..session import log_to, session

    a = parser().parse_args(argv)
    log_to(a.log_dir)
    spark = session()
    try:
        rows = spark.read.parquet(locate(spark, resolve(a.intermediate_dir, a.date, a.source, slug(a.category) if a.category else None)))
        if a.command == "validate":
            if not client and not a.url:
                raise tables.MissingInput("give the reference geocoder's address with --url")
            print(console(run(rows, client or clients.HttpStructured(a.url, a.key), a.out, a.n, a.seed, retry)))
        else:
            locate(spark, [a.report])
            print(console(resample(spark, a.report, rows, indexes(spark, a.package, a.cache_dir), a.out, match.Thresholds(street=a.threshold))))
    except tables.MissingInput as e:
        log.error("%s", e)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
