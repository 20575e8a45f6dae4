"""The steps of a run, each a lazy plan whose result is one Parquet folder per dump date."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich, filters, geocode, match
from ..schema import COMPANY, ESTABLISHMENT, KEY_CACHE, PROGRESS
from ..sinks import files, slug
from ..sources import clients, download, geopackage, tables
from ..sources.config import Config
from ..sources.tables import MissingInput
from ..streaming import Stop, answers, ask_in_batches, partial_output

log = logging.getLogger(__name__)
STEPS = ("download", "filter", "join", "geocode", "export")
#: Kinds of file that the steps read.
NEEDED = ("emp", "estab", "cnae", "natureza", "municipio")


class Stopped(Exception):
    """The run was interrupted; its argument names the partial output."""


@dataclass
class Run:
    """One dump date: where its files are, and the steps over them."""

    spark: SparkSession
    date: str
    config: Config = field(default_factory=Config)
    force: bool = False
    ufs: list[str] | None = None
    codes: list[str] | None = None
    categories: list[str] | None = None
    formats: list[str] | None = None
    compat_on_filter: bool = False
    lookup_client: clients.Client | None = None
    fallback_client: clients.Client | None = None
    retry: clients.Retry = field(default_factory=clients.Retry)
    transport: download.Transport = download.urllib_transport
    attempts: download.Attempts = field(default_factory=download.Attempts)
    stop: Callable[[], bool] = lambda: False

    def __post_init__(self) -> None:
        c = self.config
        if c.lookup_url and not self.lookup_client:
            self.lookup_client = clients.HttpLookup(c.lookup_url)
        if c.fallback_url and not self.fallback_client:
            self.fallback_client = clients.HttpStructured(c.fallback_url, c.fallback_key)

    def at(self, name: str) -> str:
        return f"{self.config.intermediate_dir}/{name}_{self.date}.parquet"

    def raw(self, pattern: str) -> str:
        return f"{self.config.input_dir}/{self.date}/{pattern}"

    def _step(self, path: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The output that is there, or the plan's, committed as a whole."""
        if self.force or not files.done(self.spark, path):
            files.write_parquet(build(), path, compression=self.config.compression, row_group=self.config.row_group)
        else:
            log.info("%s is there; --force makes it again", path)
        return self.spark.read.parquet(path)

    def _csv(self, stem: str, schema) -> DataFrame:
        """The files of a kind, extracted or still zipped."""
        options = {"encoding": self.config.encoding, "delimiter": self.config.delimiter}
        from ..sources.archives import zipped_csv

        for pattern in (f"{stem}*.csv", f"{stem}*.CSV"):
            if tables.exists(self.spark, self.raw(pattern)):
                return tables.registry_csv(self.spark, self.raw(pattern), schema, **options)
        if tables.exists(self.spark, self.raw(f"{stem}*.zip")):
            return zipped_csv(self.spark, self.raw(f"{stem}*.zip"), schema, **options)
        raise MissingInput(self.raw(f"{stem}*"))

    def _lookup(self, stem: str, required: bool = True) -> DataFrame | None:
        from ..schema import LOOKUP

        try:
            return self._csv(stem, LOOKUP)
        except MissingInput:
            if required:
                raise
            log.warning("optional lookup %s is missing", stem)
            return None

    def download(self) -> None:
        """The dump's files, those that are there already but for `force`; what can't be had ends the run."""
        if not self.config.base_url:
            raise MissingInput("no address to download from: give --base-url, or --skip-download where the files are there")
        wanted = download.of_kinds(download.list_files(self.transport, self.config.base_url, self.date), NEEDED)
        got = download.fetch_all(self.transport, wanted, Path(self.raw("")), force=self.force, resume=not self.force, attempts=self.attempts)
        log.info("%d files fetched, %d there already", len(got.done), len(got.skipped))
        if got.failed or got.missing or not wanted:
            raise MissingInput(f"not to be had from {self.config.base_url}: {', '.join(got.failed + got.missing) or 'any file'}")

    def filter(self) -> tuple[DataFrame, DataFrame]:
        establishments = self._step(self.at("establishments"), lambda: filters.active(self._csv("Estabelecimentos", ESTABLISHMENT)))
        companies = self._step(self.at("companies"), lambda: filters.without(self._csv("Empresas", COMPANY)))
        return establishments, companies

    def join(self) -> DataFrame:
        def build() -> DataFrame:
            for name in ("establishments", "companies"):
                if not files.done(self.spark, self.at(name)):
                    raise MissingInput(f"{self.at(name)}: run the filter step first")
            if not Path(self.config.tag_map).exists():
                raise MissingInput(f"{self.config.tag_map}: a file of activity codes and their tags is needed (--tag-map)")
            return enrich.enrich(
                self.spark.read.parquet(self.at("establishments")), self.spark.read.parquet(self.at("companies")), enrich.tag_table(self.spark, tables.read_map(self.config.tag_map)),
                activities=self._lookup("Cnaes"), natures=self._lookup("Naturezas"), cities=self._lookup("Municipios"), ufs=self.ufs, codes=self.codes, compat_on_filter=self.compat_on_filter,
            )

        return self._step(self.at("joined"), build)

    def geocoded_path(self) -> str:
        return self.at("geocoded" + (f"__{slug(self.categories)}" if self.categories else ""))

    def _look_up(self, pois: DataFrame) -> DataFrame:
        """The key cache with the answers for all keys that it hasn't. They are kept in batches
        beside it, so what a run was answered before it failed or was stopped is there for the next."""
        path = f"{self.config.cache_dir}/cep.parquet"
        fresh, asked = f"{path}.next", f"{self.config.cache_dir}/cep.answers"
        read = lambda: self.spark.read.schema(KEY_CACHE).parquet(path) if files.done(self.spark, path) else self.spark.createDataFrame([], KEY_CACHE)
        joined = lambda: geocode.update_cache(read(), answers(self.spark, asked, KEY_CACHE))
        if self.lookup_client:
            shown = 0

            def after(n: int) -> None:
                nonlocal shown
                log.info("%d keys asked", n)
                if n - shown >= self.config.partial_every:
                    shown = n
                    partial_output(pois, joined(), self.geocoded_path())

            wanted = geocode.missing_keys(pois, read())
            ask_in_batches(wanted, lambda k: clients.look_up(k, self.lookup_client, retry=self.retry), asked, KEY_CACHE, "cep", size=self.config.flush, stop=self.stop, after=after)
            if self.stop():
                raise Stopped(partial_output(pois, joined(), self.geocoded_path()))
        if tables.exists(self.spark, f"{asked}/batch=*"):
            files.write_parquet(joined(), fresh)
            files.write_parquet(self.spark.read.parquet(fresh), path)
            files.remove(self.spark, fresh, asked)
        return read()

    def _centres(self) -> DataFrame | None:
        """City centres under the registry's codes, made of the polygons once; None without any."""
        path = f"{self.config.cache_dir}/centres.parquet"
        if self.config.centres_package and not files.done(self.spark, path):
            code = self.config.centres_code
            found = geopackage.centroids(self.spark, self.config.centres_package, [code])
            key = F.split(F.col(f"`{code}`"), r"\.").getItem(0)  # a code that was stored as a floating-point number
            files.write_parquet(found.select(key.alias("municipio"), F.col("lat").alias("lat_centro"), F.col("lon").alias("lon_centro")), path)
        if not tables.exists(self.spark, path):
            return None
        centres = tables.centres(self.spark, path)
        if self.config.city_codes:
            centres = geocode.crosswalk(centres, self.spark.read.parquet(self.config.city_codes))
        return centres

    def _fall_back(self, out: DataFrame) -> DataFrame:
        """Structured answers for the rows that need them, each asked once whatever reads them afterwards."""
        asked = f"{self.config.cache_dir}/fallback_{self.date}.answers"
        ask = lambda rows: clients.structured(rows, self.fallback_client, retry=self.retry).where("geo_precision != 'failed'")
        found = ask_in_batches(geocode.needs_fallback(out), ask, asked, PROGRESS, "cnpj", size=self.config.flush, stop=self.stop)
        if self.stop():
            raise Stopped(files.write_parquet(geocode.merge_fallback(out, found), f"{self.geocoded_path()}.partial"))
        return geocode.merge_fallback(out, found)

    def geocode(self) -> DataFrame:
        def build() -> DataFrame:
            pois = self.spark.read.parquet(self.at("joined"))
            if self.categories:
                pois = pois.where(pois.osm_category.isin(*self.categories))
            out = geocode.located(pois, self._look_up(pois))
            centres = self._centres()
            if centres is not None:
                out = geocode.flag_centres(out, centres, metres=self.config.centre_m)
            return self._fall_back(out) if self.fallback_client else out

        if not files.done(self.spark, self.at("joined")):
            raise MissingInput(f"{self.at('joined')}: run the join step first")
        return self._step(self.geocoded_path(), build)

    def best(self) -> str:
        """The geocoded table if it is there, else the joined one."""
        for path in (self.geocoded_path(), self.at("joined")):
            if files.done(self.spark, path):
                return path
        raise MissingInput(f"{self.at('joined')}: run the join step first")

    def export(self) -> list[str]:
        return files.export(self.spark.read.parquet(self.best()), f"{self.config.output_dir}/{self.date}", self.formats or self.config.formats, force=self.force)

    def match(self, index: DataFrame, **options) -> DataFrame:
        """The local layered match over the joined table."""
        pois = self.spark.read.parquet(self.at("joined"))
        if self.ufs:
            pois = pois.where(pois.uf.isin(*self.ufs))
        return match.located(pois, match.cascade(match.normalise_pois(pois), index, **options))

    def run(self, first: str = "download", *, skip_download: bool = False, count: bool = False, until: str = "export") -> int | None:
        """The steps from `first` on, in order; `count` ends after the join with the number of rows."""
        todo = STEPS[STEPS.index(first) : STEPS.index(until) + 1]
        for step in todo:
            if step == "download" and skip_download:
                continue
            if step == "geocode" and count:
                return self.spark.read.parquet(self.at("joined")).count()
            log.info("step %s", step)
            getattr(self, step)()
        return None


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera", description="From a registry dump to geocoded points of interest.")
    p.add_argument("--date", help="dump date, YYYY-MM-DD or YYYY-MM; without it, the latest that --base-url has")
    p.add_argument("--from-step", choices=STEPS, default=STEPS[0])
    p.add_argument("--skip-download", action="store_true")
    p.add_argument("--force", action="store_true")
    p.add_argument("--count", action="store_true", help="only count the joined rows")
    p.add_argument("--uf", nargs="*", type=str.upper)
    p.add_argument("--cnae", nargs="*")
    p.add_argument("--category", nargs="*", help="geocode only these tags")
    p.add_argument("--format", nargs="*", choices=list(files.WRITERS))
    for name, kind in SETTINGS.items():
        p.add_argument("--" + name.replace("_", "-"), default=getattr(Config(), name), type=kind)
    return p


#: What of the configuration the command line sets.
SETTINGS = dict.fromkeys(("base_url", "input_dir", "intermediate_dir", "cache_dir", "output_dir", "log_dir", "tag_map", "lookup_url", "fallback_url", "fallback_key", "centres_package", "centres_code", "city_codes"), str) | {"flush": int, "partial_every": int}


def main(argv: list[str] | None = None, **parts) -> int:
    """The command: 0, 1 where an input is missing, 130 after an interruption. `parts` are fields
    of Run that have no option, such as clients and the transport."""
    from ..session import log_to, session

    a = parser().parse_args(argv)
    log_to(a.log_dir)
    config = Config(**{k: getattr(a, k) for k in SETTINGS})
    with Stop() as stop:
        try:
            if not a.date and not config.base_url:
                raise MissingInput("give --date, or --base-url for the latest dump")
            date = a.date or download.latest_dump(parts.get("transport", download.urllib_transport), config.base_url)
            run = Run(session(), date, config, a.force, a.uf, a.cnae, a.category, a.format, stop=stop, **parts)
            n = run.run(a.from_step, skip_download=a.skip_download and a.from_step == STEPS[0], count=a.count)
        except MissingInput as e:
            log.error("%s", e)
            return 1
        except Stopped as e:
            log.warning("stopped; what is known so far is in %s", e)
            return 130
    if n is not None:
        print(n)
    return 0


if __name__ == "__main__":
    sys.exit(main())
