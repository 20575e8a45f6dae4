"""Settings of a run."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path


@dataclass(frozen=True)
class Config:
    base_url: str = ""
    input_dir: str = "data/input"
    intermediate_dir: str = "data/intermediate"
    cache_dir: str = "data/cache"
    output_dir: str = "data/output"
    log_dir: str = "data/log"
    #: A file of activity codes and their tags; the join needs it, and there is none to fall back on.
    tag_map: str = "tags.yaml"
    #: Addresses of the geocoding services, {cep} standing for the key; empty: not asked.
    lookup_url: str = ""
    fallback_url: str = ""
    fallback_key: str = ""
    #: Answers that are kept at a time, and after how many the partial output is made again.
    flush: int = 1_000
    partial_every: int = 5_000
    #: City polygons (GeoPackage) with the column of their codes, and a table of codigo_rf, codigo_ibge.
    centres_package: str = ""
    centres_code: str = "code_muni"
    city_codes: str = ""
    encoding: str = "windows-1252"
    delimiter: str = ";"
    compression: str = "zstd"
    row_group: int = 122_880
    centre_m: float = 500.0
    formats: tuple[str, ...] = field(default=("parquet",))

    def path(self, key: str) -> Path:
        """The folder of a `..._dir` setting, made if it isn't there."""
        p = Path(getattr(self, key))
        p.mkdir(parents=True, exist_ok=True)
        return p


@lru_cache(1)
def config() -> Config:
    return Config()
