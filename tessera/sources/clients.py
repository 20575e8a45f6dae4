"""Geocoding services asked by executors, each distinct key once.

A client is a picklable callable from request parameters to (status, body); it runs in
mapInArrow, so requests are spread over tasks and bounded by their number.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cep_key_strict
from ..operators.geocode import parse_lookup, parse_structured, street_line

Client = Callable[[dict], tuple[int, str]]


def http_get(url: str, timeout: float) -> tuple[int, str]:
    """Status and body, of refused requests too."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as got:
            return got.status, got.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, ""


@dataclass(frozen=True)
class HttpLookup:
    """A key lookup over HTTP; the key stands in the address where `template` has {cep}."""

    template: str
    timeout: float = 15.0

    def __call__(self, parameters: dict) -> tuple[int, str]:
        return http_get(self.template.format(**{k: urllib.parse.quote(str(v), safe="") for k, v in parameters.items()}), self.timeout)


@dataclass(frozen=True)
class HttpStructured:
    """A structured geocoder over HTTP: the request's fields and the access key are the query."""

    address: str
    key: str = ""
    timeout: float = 15.0

    def __call__(self, parameters: dict) -> tuple[int, str]:
        fields = {k: v for k, v in parameters.items() if v not in (None, "")} | ({"key": self.key} if self.key else {})
        return http_get(f"{self.address}?{urllib.parse.urlencode(fields)}", self.timeout)


@dataclass(frozen=True)
class Retry:
    attempts: int = 3
    #: Seconds before the next attempt after 429 are base ** attempt, after others `wait`.
    base: float = 2.0
    wait: float = 1.0
    sleep: Callable[[float], None] = time.sleep


def ask(client: Client, parameters: dict, retry: Retry, final: tuple[int, ...]) -> tuple[str, str | None]:
    """('ok', body), ('absent', None) for a `final` status, or ('failed', None) after all attempts."""
    for attempt in range(retry.attempts):
        try:
            status, body = client(parameters)
        except Exception:  # noqa: BLE001  any failure of a client is a failed attempt
            status, body = 0, ""
        if status == 200:
            return "ok", body
        if status in final:
            return "absent", None
        retry.sleep(retry.base**attempt if status == 429 else retry.wait)
    return "failed", None


def _asked(df: DataFrame, key: str, client: Client, retry: Retry, final: tuple[int, ...]) -> DataFrame:
    """`df` has key and a JSON column `parameters`; adds state and body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [ask(client, json.loads(p), retry, final) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in got]), pa.array([b for _, b in got], pa.string())], [key, "state", "body"])

    return df.select(key, "parameters").mapInArrow(run, f"{key} string, state string, body string")


def request(df: DataFrame, key: str, client: Client, retry: Retry = Retry(), final: tuple[int, ...] = ()) -> DataFrame:
    """(key, state, body) for rows of a key and a JSON column `parameters`."""
    return _asked(df, key, client, retry, final)


def look_up(keys: DataFrame, client: Client, key: str = "cep", retry: Retry = Retry()) -> DataFrame:
    """(key, lat, lon) of each key that was answered: 404 has no place, failures are left out."""
    rows = keys.select(F.col(key), F.to_json(F.struct(F.col(key))).alias("parameters"))
    got = _asked(rows, key, client, retry, (404,)).where("state != 'failed'")
    at = parse_lookup(F.col("body"))
    return got.select(key, at["lat"].alias("lat"), at["lon"].alias("lon"))


def structured(pois: DataFrame, client: Client, id: str = "cnpj", retry: Retry = Retry(), country: str = "BRA", language: str = "pt-BR") -> DataFrame:
    """(id, lat, lon, geo_precision) of each row: the first result's, `none` without any, `failed`
    where no answer came (403 included, as a refused key says nothing of the address)."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    request = F.struct(
        F.lit(country).alias("countryCode"), F.lit(language).alias("language"), F.lit(1).alias("limit"), street_line(F.col("tipo_logradouro"), F.col("logradouro")).alias("streetName"),
        blank("numero").alias("streetNumber"), cep_key_strict(F.col("cep")).alias("postalCode"), blank("municipio_descricao").alias("municipality"), blank("uf").alias("countrySubdivision"),
    )
    got = _asked(pois.select(F.col(id), F.to_json(request).alias("parameters")), id, client, retry, ())
    at = parse_structured(F.coalesce(F.col("body"), F.lit("{}")))
    failed = F.col("state") == "failed"
    return got.select(id, F.when(~failed, at["lat"]).alias("lat"), F.when(~failed, at["lon"]).alias("lon"), F.when(failed, "failed").otherwise(at["geo_precision"]).alias("geo_precision"))
