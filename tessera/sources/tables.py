"""Registry CSV files, Parquet, lookups, tag maps and reports as DataFrames."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import LOOKUP

log = logging.getLogger(__name__)


class MissingInput(FileNotFoundError):
    """A file that a step needs isn't there."""


def registry_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, *, encoding: str = "windows-1252", delimiter: str = ";") -> DataFrame:
    """Headerless quoted CSV files, columns by position, all strings. Empty fields are null,
    quoted or not; rows with too few or too many fields are dropped."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    return (
        spark.read.schema(schema).option("sep", delimiter).option("quote", '"').option("escape", '"').option("encoding", encoding)
        .option("mode", "DROPMALFORMED").option("header", "false").option("enforceSchema", "true").csv([paths] if isinstance(paths, str) else list(paths))
    )


def parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches, in whatever file system Spark reads it from."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def lookup(spark: SparkSession, pattern: str, *, required: bool = True, **csv) -> DataFrame | None:
    """A (codigo, descricao) table. Without files: an error if it is required, else None and a warning."""
    if not exists(spark, pattern):
        if required:
            raise MissingInput(pattern)
        log.warning("optional lookup %s is missing", pattern)
        return None
    return registry_csv(spark, pattern, LOOKUP, **csv)


def read_map(path: str | Path) -> dict[str, str]:
    """A flat `"code": "key=value"` file; comments and blank lines don't count, and of repeated
    codes the last one does."""
    out = {}
    for number, line in enumerate(Path(path).read_text(encoding="utf-8").splitlines(), 1):
        line = line.strip()
        if not line or line.startswith("#"):
            continue
        key, sep, value = line.partition(":")
        value = value.strip()
        value = value[1 : value.index(value[0], 1)] if value[:1] in ("'", '"') else value.split("#")[0].strip()
        if not sep or not value:
            raise ValueError(f"{path}:{number}: no code and tag: {line}")
        out[key.strip().strip("'\"")] = value
    return out


def report(spark: SparkSession, path: str) -> DataFrame:
    """A CSV report with a header; all columns are strings, empty ones null."""
    return spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(path)


def centres(spark: SparkSession, path: str, key: str = "municipio") -> DataFrame:
    """City centres (key, lat_centro, lon_centro), keys as strings of seven digits."""
    df = spark.read.parquet(path)
    return df.selectExpr(f"lpad(cast({key} as string), 7, '0') as {key}", "cast(lat_centro as double) lat_centro", "cast(lon_centro as double) lon_centro")
