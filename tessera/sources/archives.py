"""Zip files of the dump: integrity, and extraction on executors."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size and mark of a zip's end record.
END_SIZE, END_MARK = 22, b"PK\x05\x06"


def is_zip(path: str | Path) -> bool:
    """Whether a local file ends as a zip without a comment does."""
    p = Path(path)
    if not p.exists() or p.stat().st_size < END_SIZE:
        return False
    with p.open("rb") as f:
        f.seek(-END_SIZE, 2)
        return f.read(len(END_MARK)) == END_MARK


def ends_as_zip(content: Column) -> Column:
    """The same of a binary column."""
    return (F.octet_length(content) >= END_SIZE) & (F.hex(F.substring(content, -END_SIZE, 4)) == F.lit(END_MARK.hex().upper()))


def check(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, length, valid) of zip files, wherever Spark reads them."""
    return spark.read.format("binaryFile").load(pattern).select("path", "length", ends_as_zip(F.col("content")).alias("valid"))


def extract(path: str | Path, folder: str | Path) -> Path:
    """The first member of a zip, under its name in `folder`; left alone if it is there in full."""
    with zipfile.ZipFile(path) as z:
        if not z.infolist():
            raise ValueError(f"{path} is empty")
        member = z.infolist()[0]
        out = Path(folder) / Path(member.filename).name
        if not out.exists() or out.stat().st_size != member.file_size:
            out.parent.mkdir(parents=True, exist_ok=True)
            part = out.with_name(out.name + ".part")
            with z.open(member) as src, part.open("wb") as dst:
                while block := src.read(1 << 20):
                    dst.write(block)
            part.replace(out)
    return out


def extract_all(paths: list[str | Path], folder: str | Path) -> list[str]:
    return [str(extract(p, folder)) for p in paths]


def _lines(batches: Iterator[pa.RecordBatch], encoding: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                if not z.infolist():
                    continue
                with io.TextIOWrapper(z.open(z.infolist()[0]), encoding, errors="replace", newline="") as text:
                    while rows := text.readlines(1 << 20):
                        yield pa.RecordBatch.from_arrays([pa.array([r.rstrip("\r\n") for r in rows])], ["value"])


def zipped_csv(spark: SparkSession, pattern: str, schema, *, encoding: str = "windows-1252", delimiter: str = ";") -> DataFrame:
    """The rows of CSV files in zips that Spark reads; each archive is inflated by one task, line by line.
    Quoted line breaks aren't supported; rows of another number of fields are dropped."""
    lines = spark.read.format("binaryFile").load(pattern).select("content").mapInArrow(lambda b: _lines(b, encoding), "value string")
    bad = "__bad"
    form = schema.simpleString()[7:-1].replace(":", " ")
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    parsed = lines.where("value != ''").select(F.from_csv("value", f"{form},{bad} string", options).alias("r")).select("r.*")
    return parsed.where(F.col(bad).isNull()).drop(bad)
