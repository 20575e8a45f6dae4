"""GeoPackage layers of points and polygons: SQLite files with geometry blobs, read row range by row range."""

from __future__ import annotations

import os
import sqlite3
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

#: Bytes of the envelope by its indicator in the header's flags.
ENVELOPE = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


def point(blob: bytes | None) -> tuple[float, float] | None:
    """(x, y) of a GeoPackage point; None for null, empty and other geometries."""
    if not blob or blob[:2] != b"GP" or len(blob) < 8:
        return None
    flags = blob[3]
    at = 8 + ENVELOPE.get((flags >> 1) & 7, 0)
    if flags & 0x10 or len(blob) < at + 21:
        return None
    order = "<" if blob[at] else ">"
    kind, x, y = struct.unpack_from(f"{order}Idd", blob, at + 1)
    return (x, y) if kind % 1000 == 1 and x == x and y == y else None


def _rings(blob: bytes, at: int) -> tuple[list[list[tuple[float, float]]], int]:
    """The rings of the well-known binary polygon or multipolygon at `at`, and where it ends."""
    order = "<" if blob[at] else ">"
    kind, n = struct.unpack_from(f"{order}II", blob, at + 1)
    rings, at, width = [], at + 9, 2 + (kind // 1000 in (1, 2, 3)) + (kind // 1000 == 3)
    if kind % 1000 == 6:
        for _ in range(n):
            more, at = _rings(blob, at)
            rings += more
    elif kind % 1000 == 3:
        for _ in range(n):
            (m,) = struct.unpack_from(f"{order}I", blob, at)
            numbers = struct.unpack_from(f"{order}{m * width}d", blob, at + 4)
            rings.append(list(zip(numbers[::width], numbers[1::width], strict=True)))
            at += 4 + 8 * m * width
    return rings, at


def centroid(blob: bytes | None) -> tuple[float, float] | None:
    """(x, y) of the centre of a polygon's or multipolygon's area, holes left out; None for null,
    empty and other geometries, and for polygons without an area."""
    if not blob or blob[:2] != b"GP" or len(blob) < 8 or blob[3] & 0x10:
        return None
    try:
        rings, _ = _rings(blob, 8 + ENVELOPE.get((blob[3] >> 1) & 7, 0))
    except (struct.error, IndexError):  # the geometry ends too early
        return None
    area = x = y = 0.0
    for ring in rings:  # shells and holes run in opposite directions; sums near the first point lose least
        if len(ring) > 2:
            x0, y0 = rings[0][0]
            for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True):
                part = (a - x0) * (d - y0) - (c - x0) * (b - y0)
                area, x, y = area + part, x + part * (a + c - 2 * x0), y + part * (b + d - 2 * y0)
    return (rings[0][0][0] + x / (3 * area), rings[0][0][1] + y / (3 * area)) if area else None


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)


def layer(path: str, table: str | None = None) -> tuple[str, str, list[str], int, int]:
    """Table, geometry column, other columns and the range of row numbers of a point layer."""
    with _open(path) as db:
        rows = db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY table_name").fetchall()
        name, geometry = next((r for r in rows if table in (None, r[0])), (None, None))
        if name is None:
            raise ValueError(f"{path} has no layer {table or ''}")
        columns = [r[1] for r in db.execute(f'PRAGMA table_info("{name}")') if r[1] != geometry]
        low, high = db.execute(f'SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM "{name}"').fetchone()
    return name, geometry, columns, low, high


def points(spark: SparkSession, path: str, columns: list[str] | None = None, table: str | None = None, slices: int | None = None, *, shared: bool = False, place: Callable[[bytes | None], tuple[float, float] | None] = point) -> DataFrame:
    """The layer's columns as strings with lat and lon of `place`; rows without one are dropped.

    Tasks read ranges of row numbers. On a cluster each executor fetches the file from the driver
    first, unless it is `shared`: there under the same path everywhere.
    """
    path = os.path.abspath(path.removeprefix("file://"))
    name, geometry, have, low, high = layer(path, table)
    wanted = [c for c in (columns or have)]
    n = slices or max(1, min(spark.sparkContext.defaultParallelism * 4, (high - low) // 10_000 + 1))
    step = max(1, -(-(high - low + 1) // n))
    ranges = [(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]
    schema = ", ".join(f"`{c}` string" for c in wanted) + ", lat double, lon double"
    if not ranges:
        return spark.createDataFrame([], schema)
    here = shared or spark.sparkContext.master.startswith("local")
    if not here:
        spark.sparkContext.addFile(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoted = ", ".join(f'"{c}"' for c in [*wanted, geometry])
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                db = _open(path if here else SparkFiles.get(os.path.basename(path)))
                cursor = db.execute(f'SELECT {quoted} FROM "{name}" WHERE rowid >= ? AND rowid < ?', (a, b))
                while rows := cursor.fetchmany(10_000):
                    kept = [(*map(lambda v: None if v is None else str(v), r[:-1]), p[1], p[0]) for r in rows if (p := place(r[-1]))]
                    columns_ = list(zip(*kept, strict=True)) or [[]] * (len(wanted) + 2)
                    kinds = [pa.string()] * len(wanted) + [pa.float64()] * 2
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns_, kinds, strict=True)], [*wanted, "lat", "lon"])
                db.close()

    return spark.createDataFrame(ranges, "a long, b long").repartition(len(ranges)).mapInArrow(read, schema)


def centroids(spark: SparkSession, path: str, columns: list[str] | None = None, table: str | None = None, **options) -> DataFrame:
    """The columns of a polygon layer with lat and lon of each polygon's centre."""
    return points(spark, path, columns, table, place=centroid, **options)
