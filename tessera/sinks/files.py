"""Output files. Spark writes folders of part files; `single` moves one part to one file."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def done(spark: SparkSession, path: str) -> bool:
    """Whether a complete output is there: a file, or a folder that its writer committed."""
    fs, p, Path = _fs(spark, path)
    return fs.exists(p) and (fs.getFileStatus(p).isFile() or fs.exists(Path(f"{path}/_SUCCESS")))


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, p, _ = _fs(spark, path)
        fs.delete(p, True)


def _write(writer, df: DataFrame, path: str, single: bool) -> str:
    """writer(df, folder); with `single`, one part file under the path itself."""
    if not single:
        writer(df, path)
        return path
    folder = f"{path}.parts"
    writer(df.coalesce(1), folder)
    fs, p, Path = _fs(df.sparkSession, path)
    parts = [s.getPath() for s in fs.globStatus(Path(f"{folder}/part-*"))]
    fs.delete(p, True)
    if parts:
        fs.rename(parts[0], p)
    fs.delete(Path(folder), True)
    return path


def write_parquet(df: DataFrame, path: str, *, single: bool = False, compression: str = "zstd", row_group: int = 122_880, partition_by: list[str] | None = None) -> str:
    def put(d: DataFrame, to: str) -> None:
        w = d.write.mode("overwrite").option("compression", compression).option("parquet.block.row.count.limit", str(row_group))
        (w.partitionBy(*partition_by) if partition_by else w).parquet(to)

    return _write(put, df, path, single)


def write_csv(df: DataFrame, path: str, *, single: bool = False, compression: str = "gzip") -> str:
    return _write(lambda d, to: d.write.mode("overwrite").option("header", "true").option("compression", compression).option("escape", '"').option("emptyValue", "").csv(to), df, path, single)


def write_jsonl(df: DataFrame, path: str, *, single: bool = False) -> str:
    """One object a line, nulls included."""
    return _write(lambda d, to: d.write.mode("overwrite").option("ignoreNullFields", "false").json(to), df, path, single)


def feature(df: DataFrame, lat: str = "lat", lon: str = "lon", *, geometry: bool = True) -> Column:
    """A GeoJSON feature as text: a point, or null where a coordinate is missing. Without
    `geometry` it is always null, and all columns are properties."""
    if geometry and {lat, lon} <= set(df.columns):
        place = F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates")))
        names = [c for c in df.columns if c not in (lat, lon)]
    else:
        place = F.lit(None).cast("struct<type:string,coordinates:array<double>>")
        names = df.columns
    row = F.struct(F.lit("Feature").alias("type"), place.alias("geometry"), F.struct(*[F.col(c) for c in names]).alias("properties"))
    return F.to_json(row, {"ignoreNullFields": "false"})


def write_geojson(df: DataFrame, path: str, *, single: bool = True, geometry: bool = True) -> str:
    """A FeatureCollection in one file, joined of the parts by the file system; or, not single,
    part files of one feature a line."""
    rows = df.select(feature(df, geometry=geometry).alias("value"))
    folder = f"{path}.parts" if single else path
    rows.write.mode("overwrite").text(folder)
    if single:
        spark = df.sparkSession
        fs, p, Path = _fs(spark, path)
        out = fs.create(p, True)
        out.write(bytearray(b'{"type": "FeatureCollection", "features": ['))
        first = True
        for s in sorted(fs.globStatus(Path(f"{folder}/part-*")), key=lambda s: s.getPath().getName()):
            if s.getLen():
                copy_lines(spark, fs, s.getPath(), out, first)
                first = False
        out.write(bytearray(b"\n]}\n"))
        out.close()
        fs.delete(Path(folder), True)
    return path


def copy_lines(spark: SparkSession, fs, path, out, first: bool) -> None:
    """Append a part's lines, with a comma between any two, block by block."""
    stream = fs.open(path)
    left, before = fs.getFileStatus(path).getLen(), b"" if first else b","
    out.write(bytearray(before + b"\n"))
    jvm = spark.sparkContext._jvm
    while left:
        n = min(left, 1 << 22)
        block = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n))
        left -= n
        body = block if left else block.rstrip(b"\n")
        out.write(bytearray(body.replace(b"\n", b",\n")))
    stream.close()


def write_report(df: DataFrame, path: str, fields: list[str], *, single: bool = True) -> str:
    """A CSV of fixed columns with a header; nulls are empty."""
    have = set(df.columns)
    rows = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in fields])
    return _write(lambda d, to: d.write.mode("overwrite").option("header", "true").option("escape", '"').option("emptyValue", "").csv(to), rows, path, single)


WRITERS = {"parquet": ("poi.parquet", write_parquet), "csv": ("poi.csv.gz", write_csv), "jsonl": ("poi.jsonl", write_jsonl), "geojson": ("poi.geojson", write_geojson)}


def export(df: DataFrame, folder: str, formats: Iterable[str], *, force: bool = False, name: str | None = None, single: bool = False, geometry: bool = True) -> list[str]:
    """Write each format once; one that is there is left alone unless `force`. The rows are
    kept in memory or on disk while more than one format is written."""
    todo, out = [], []
    for kind in formats:
        if kind not in WRITERS:
            raise ValueError(f"unknown format {kind}; there are {', '.join(WRITERS)}")
        file, writer = WRITERS[kind]
        path = f"{folder.rstrip('/')}/{file if name is None else name + file[len('poi'):]}"
        out.append(path)
        if force or not done(df.sparkSession, path):
            todo.append((kind, writer, path))
    kept = df.persist() if len(todo) > 1 else df
    for kind, writer, path in todo:
        writer(kept, path, geometry=geometry) if kind == "geojson" else writer(kept, path, single=single)
    if len(todo) > 1:
        kept.unpersist()
    return out


def safe_name(category: str | None = None, ufs: Iterable[str] | None = None) -> str:
    """A file name of a tag and states."""
    parts = [category.replace("=", "_").replace("/", "-")] if category else []
    return "_".join(parts + sorted(u.upper() for u in ufs or [])) or "poi_export"


def slug(categories: Iterable[str]) -> str:
    """Sorted names, joined by `_`; all but word characters and `=` is a hyphen."""
    return "_".join(re.sub(r"[^\w=]", "-", c) for c in sorted(categories))
