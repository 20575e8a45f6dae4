"""WARC archives as chunked record tables.

Records are gzip members of WARC 1.1 files, one file for each task that writes. A payload
never stands in memory a second time: the writer slices the Arrow buffer in chunks, the
reader inflates the file piece by piece and gives (record, chunk number, bytes) rows with
the SHA-1 of the payload so far; the last chunk's digest must be that of the header.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .common import saved, scratch_path, utf8

CHUNK = 1 << 20
BROADCAST = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def planned(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """(page_id, url, html, bytes, sha1, refers_to): refers_to is the largest page_id with an
    equal payload, null for that record itself and for payloads of fewer than `least` bytes.

    Digests are grouped without payloads, with partial aggregation; only the ids that revisit
    another are joined back. Up to `BROADCAST` of them (some 64 bytes each) are broadcast, so
    that no payload moves; more are joined by page_id.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("bytes"), F.sha1(F.col("html").cast("binary")).alias("sha1"))
    keys = saved(rows.where(F.col("bytes") >= least).select("page_id", "bytes", "sha1"), "warc-keys")
    kept = keys.groupBy("sha1", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    revisits = keys.join(kept, ["sha1", "bytes"]).where("not page_id <=> refers_to").distinct()
    revisits = saved(revisits.select(F.col("page_id").alias("i"), F.col("sha1").alias("s"), "refers_to"), "warc-revisits")
    if revisits.limit(BROADCAST + 1).count() <= BROADCAST:
        revisits = F.broadcast(revisits)
    return rows.join(revisits, F.col("page_id").eqNullSafe(F.col("i")) & (F.col("sha1") == F.col("s")), "left").drop("i", "s")


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    return int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", uri)) else None


def head(page_id: int | None, url: str | None, size: int, sha1: str, refers_to: int | None) -> bytes:
    """A record's headers, and those of the HTTP message in it, up to the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += ["Content-Type: application/http;msgtype=response", "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()]
    if revisit:
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {len(http) + (0 if revisit else size)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def add(out, page_id: int | None, url: str | None, payload: memoryview, sha1: str, refers_to: int | None, chunk: int = CHUNK) -> None:
    """Write one record as a gzip member, its payload chunk by chunk."""
    gzip = zlib.compressobj(6, zlib.DEFLATED, 31)
    out.write(gzip.compress(head(page_id, url, len(payload), sha1, refers_to)))
    if refers_to is None:
        for a in range(0, len(payload), chunk):
            out.write(gzip.compress(payload[a : a + chunk]))
    out.write(gzip.compress(b"\r\n\r\n") + gzip.flush())


def write(planned_pages: DataFrame, folder: str) -> list[str]:
    """Write the records of planned(); the paths of the files, one for each partition with rows."""
    rows = planned_pages.select("page_id", "url", "html", "sha1", "refers_to", F.spark_partition_id().alias("p"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        batch = next(batches, None)
        if batch is None:
            return
        path = f"{folder}/pages-{batch.column(5)[0].as_py():05d}.warc.gz"
        with files.committed(path) as out:
            while batch is not None:
                data, offsets = utf8(batch.column(2))
                raw, bounds = memoryview(data), offsets.tolist()
                for i, (page, url, sha1, refers) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4)), strict=True)):
                    add(out, page, url, raw[bounds[i] : bounds[i + 1]], sha1, refers)
                batch = next(batches, None)
        yield pa.RecordBatch.from_pydict({"path": [path]})

    return sorted(r.path for r in rows.mapInArrow(written, "path string").collect())  # a row for each file


@dataclass
class Chunk:
    """A piece of a record's payload; digest is the SHA-1 up to its end, size the bytes up to there."""

    fields: dict[str, str]
    http: dict[str, str]
    number: int
    data: bytes
    size: int
    sha1: object = field(repr=False)
    last: bool = False


def _fields(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def inflated(stream, read: int = 1 << 16) -> Iterator[bytes]:
    """The bytes of a file of gzip members, in pieces of bounded size."""
    gzip, raw = zlib.decompressobj(31), stream.read(read)
    while raw:
        yield gzip.decompress(raw, CHUNK)
        if gzip.eof:
            raw = gzip.unused_data or stream.read(read)
            gzip = zlib.decompressobj(31)
        else:
            raw = gzip.unconsumed_tail or stream.read(read)


def chunks(pieces: Iterator[bytes], chunk: int = CHUNK) -> Iterator[Chunk]:
    """The records of a WARC byte stream as chunks, in order; a record without a payload has one, empty."""
    held = bytearray()

    def until(mark: bytes) -> bytes | None:
        while (at := held.find(mark)) < 0:
            piece = next(pieces, None)
            if piece is None:
                if held.strip():
                    raise ValueError("the archive ends within a record")
                return None
            held.extend(piece)
        out = bytes(held[:at])
        del held[: at + len(mark)]
        return out

    while (raw := until(b"\r\n\r\n")) is not None:
        fields = _fields(raw.lstrip(b"\r\n"))
        message = until(b"\r\n\r\n")
        if message is None:
            raise ValueError("the archive ends within a record")
        left, sha1, number, size = int(fields["content-length"]) - len(message) - 4, hashlib.sha1(), 0, 0
        http = _fields(message)
        while True:
            take = min(left, chunk)
            while len(held) < take and (piece := next(pieces, None)) is not None:
                held.extend(piece)
            if len(held) < take:
                raise ValueError("the archive ends within a record")
            data = bytes(held[:take])
            del held[:take]
            sha1.update(data)
            left, size = left - take, size + take
            yield Chunk(fields, http, number, data, size, sha1.copy(), left == 0)
            number += 1
            if not left:
                break
        while len(held) < 4 and (piece := next(pieces, None)) is not None:
            held.extend(piece)
        del held[:4]


def _opened(path: str) -> Iterator[Chunk]:
    system, name = files.at(path)
    with system.open_input_stream(name, compression=None) as stream:
        yield from chunks(inflated(stream))


def _digest(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


def _paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))


CHUNKS = "record long, chunk long, last boolean, page_id long, record_type string, refers_to long, payload_bytes long, header_digest string, bytes long, payload_digest string"


def _row(record: int, c: Chunk) -> tuple:
    return (record, c.number, c.last, _page(c.fields["warc-record-id"]), c.fields["warc-type"], _page(c.fields.get("warc-refers-to", "")), int(c.http["content-length"]), c.fields["warc-payload-digest"].removeprefix("sha1:"), c.size, _digest(c.sha1))


def chunk_table(spark: SparkSession, paths: list[str], *, data: bool = True, path: str = "path") -> DataFrame:
    """A row for each chunk of each record: file, number of the record in it and of the chunk in
    the record, whether that is its last; what the headers say (page_id, record_type, refers_to,
    payload_bytes, header_digest); and of the payload up to the chunk's end its size and digest.
    With `data` also the chunk's bytes. No task holds more of a record than one chunk."""
    kinds = [*(pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()), *([pa.binary()] if data else [])]
    names = [x.split()[0] for x in CHUNKS.split(", ")] + ["data"] * data

    def batch_of(file: str, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], [path, *names])

    def loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, size, record = [], 0, 0
                for c in _opened(file):
                    rows.append((*_row(record, c), *([c.data] if data else [])))
                    size, record = size + len(c.data), record + c.last
                    if size >= CHUNK and data or len(rows) == 10_000:
                        yield batch_of(file, rows)
                        rows, size = [], 0
                yield batch_of(file, rows)

    return _paths(spark, paths).mapInArrow(loaded, f"`{path}` string, {CHUNKS}" + ", data binary" * data)


def record_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A row for each record, put together from its chunks: the last one's size and digest are
    the payload's. A response whose payload isn't what its headers say fails the query."""
    rows = chunk_table(spark, paths, data=False)
    # A record's chunks lie one after another in one file, so the last chunk sums them all up and nothing is shuffled.
    last = rows.where("last")
    sound = (F.col("record_type") != "response") | (F.col("bytes") == F.col("payload_bytes")) & (F.col("payload_digest") == F.col("header_digest"))
    damaged = F.raise_error(F.concat(F.lit("damaged payload in record "), F.col("record").cast("string"), F.lit(" of "), F.col("path")))
    return last.select("page_id", F.when(sound, F.col("payload_bytes")).otherwise(damaged.cast("long")).alias("payload_bytes"), F.col("header_digest").alias("payload_digest"), "record_type", "refers_to")


def round_trip(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """The pages written as archives in the shared folder, and the records read from there.

    Defined cases: a null payload is empty; records with equal payloads and the same, largest
    page_id are all responses; a null page_id revisits the largest id there is, or is a
    response where no equal payload has one; a null url is left out; other columns aren't written.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    return record_table(pages.sparkSession, write(planned(pages, page_id=page_id, url=url, html=html, least=least), folder))
