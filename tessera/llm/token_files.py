"""Token-ID files: each document a zstandard frame of its own, all under one trained dictionary.

A set of files is a folder of `dictionary` and `shard-NNNNN.tok`. A shard holds, in ascending
doc_id order:

    header   magic TOKZ1, bytes of an id (2 or 4), SHA-256 of the dictionary
    frames   one zstandard frame for each document: its ids, little-endian
    index    doc_id (int64), 1 if it is null (uint8), offset of the frame (uint64) and number
             of ids (uint64), each as one array, in one zstandard frame
    trailer  offset of the index (uint64), documents (uint64), magic

so one short document is read with two seeks, and a reader with another dictionary is
refused. The dictionary is trained on the serialized ids of a bounded sample of documents.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import files
from .common import scratch_path

MAGIC = b"TOKZ1"
_HEAD, _TRAIL = struct.Struct("<5sB32s"), struct.Struct("<QQ5s")


#: What a byte-level tokenizer writes for each byte: itself if it is visible, else the next
#: character from U+0100 on.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_VISIBLE = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


class Encoder:
    """Token ids of texts by a tokenizers file; words that were seen before aren't encoded again.

    For tokenizers that lower-case, split at words and merge within a word only, a text's ids
    are those of its words one after another. There, texts below U+0300 that can't hold a special
    token are split here, with the tokenizer's own pattern, and only new words go through the
    library's model. All other texts and tokenizers go through the library whole.
    """

    #: Words that are remembered at most; beyond that, all are forgotten.
    MOST = 200_000
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        steps = [x["type"] for x in (form.get("normalizer") or {}).get("normalizers", [])]
        split = [(x["type"], x.get("pattern"), x.get("use_regex")) for x in (form.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        by_word = steps == ["NFC", "Replace", "Lowercase"] and split == [("Split", {"Regex": self.PATTERN}, None), ("ByteLevel", None, False)] and not form.get("post_processor")
        special = all(t["content"].startswith("<|") for t in form.get("added_tokens", []))
        self.odd = re.compile("[^\x00-\u02ff]") if by_word and special else None
        low = sorted({x for c in range(0x300) for x in chr(c) + chr(c).lower()})
        of = lambda kind: "".join(re.escape(c) for c in low if unicodedata.category(c)[0] == kind)
        space = "\t-\r \x85\xa0"
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{of('L')}]+|[{of('N')}]|[^{space}{of('L')}{of('N')}]+").findall

    def _learn(self, words: Iterable[str]) -> None:
        """Ids of new words, by the library's model: what it gets is what its byte-level step makes of a word."""
        tokens, code = self.tokenizer.model.tokenize, "H" if self.width == 2 else "I"
        for word in words:
            ids = [t.id for t in tokens(word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_VISIBLE))]
            self.words[word] = struct.pack(f"<{len(ids)}{code}", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The serialized ids of each text."""
        out: list[list[bytes | None]] = []
        fresh: dict[str, None] = {}
        pending: list[tuple[int, list[str]]] = []
        if len(self.words) > self.MOST:
            self.words.clear()
        get = self.words.get
        for i, text in enumerate(texts):
            if self.odd is None or not text.isascii() and self.odd.search(text) or "<|" in text:
                out.append([np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()])
                continue
            words = self.split(text.lower())
            ids = list(map(get, words))
            if None in ids:
                fresh.update((w, None) for w, x in zip(words, ids, strict=True) if x is None)
                pending.append((i, words))
            out.append(ids)
        self._learn(fresh)
        for i, words in pending:
            out[i] = [get(w) if x is None else x for w, x in zip(words, out[i], strict=True)]
        return list(map(b"".join, out))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each file and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def _spread(raw: bytes, piece: int, pieces: int, width: int) -> bytes:
    """All of `raw`, or if it is longer, `pieces` of `piece` bytes of it at even distances, from its beginning to its end."""
    if len(raw) <= piece * pieces:
        return raw
    last = (len(raw) - piece) // width
    return b"".join(raw[(at := last * k // max(1, pieces - 1) * width) : at + piece] for k in range(pieces))


def train(docs: DataFrame, tokenizer: str, *, doc_id: str, text: str, sample: int = 512, piece: int = 8192, pieces: int = 8, size: int = 1 << 16) -> bytes:
    """A dictionary from the ids of the `sample` documents with the least id hashes, `pieces`
    of `piece` bytes of each at most, spread over the whole text; empty where there is too little to learn from."""
    chosen = docs.select(F.col(doc_id).alias("i")).orderBy(F.xxhash64("i"), "i").limit(sample).distinct()
    rows = docs.select(F.col(doc_id).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(chosen), F.col("d") == F.col("i")).groupBy("d").agg(F.min("t").alias("t"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coder = encoder(tokenizer)
            raw = [_spread(x, piece, pieces, coder.width) for x in coder.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["d", "x"])

    got = sorted((r.d is not None, r.d or 0, bytes(r.x)) for r in rows.mapInArrow(encoded, "d long, x binary").collect())
    samples = [x[a : a + piece] for _, _, x in got for a in range(0, len(x), piece)]
    if len(samples) < 16 or sum(map(len, samples)) < 16 * 1024:
        return b""
    return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples, level=3).as_bytes()


class Writer:
    """Documents, one after another, into the stream of a shard."""

    def __init__(self, out, width: int, dictionary: bytes):
        self.out, self.width = out, width
        trained = _dictionary(dictionary)
        if trained:
            trained.precompute_compress(level=3)
        self.compress = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True).compress
        self.ids: list[int | None] = []
        self.at, self.n = [], []
        self.size = out.write(_HEAD.pack(MAGIC, width, hashlib.sha256(dictionary).digest()))

    def add(self, doc_id: int | None, raw: bytes) -> None:
        frame = self.compress(raw)
        self.ids.append(doc_id)
        self.at.append(self.size)
        self.n.append(len(raw) // self.width)
        self.out.write(frame)
        self.size += len(frame)

    def close(self) -> None:
        index = np.array([x or 0 for x in self.ids], "<i8").tobytes() + np.array([x is None for x in self.ids], "u1").tobytes() + np.array(self.at, "<u8").tobytes() + np.array(self.n, "<u8").tobytes()
        self.out.write(zstandard.ZstdCompressor(level=3).compress(index))
        self.out.write(_TRAIL.pack(self.size, len(self.ids), MAGIC))


class Shard:
    """A shard, read in order or document by document."""

    def __init__(self, path: str, dictionary: bytes):
        system, name = files.at(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        magic, self.width, digest = _HEAD.unpack(self.file.read_at(_HEAD.size, 0))
        end, self.documents, tail = _TRAIL.unpack(self.file.read_at(_TRAIL.size, size - _TRAIL.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError(f"not a token file: {path}")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"written with another dictionary: {path}")
        raw, n = zstandard.ZstdDecompressor().decompress(self.file.read_at(size - _TRAIL.size - end, end)), self.documents
        self.doc_id = [None if null else i for i, null in zip(np.frombuffer(raw, "<i8", n).tolist(), raw[8 * n : 9 * n], strict=True)]
        self.at = [*np.frombuffer(raw, "<u8", n, 9 * n).tolist(), end]
        self.n = np.frombuffer(raw, "<u8", n, 17 * n).tolist()
        self._decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress

    def read(self, i: int) -> np.ndarray:
        """The ids of document number i."""
        frame = self.file.read_at(self.at[i + 1] - self.at[i], self.at[i])
        return np.frombuffer(self._decompress(frame, max_output_size=self.n[i] * self.width), f"<u{self.width}")

    def documents_in_order(self, read: int = 1 << 22) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents, with one read for about `read` bytes of frames."""
        i = 0
        while i < self.documents:
            j = i + 1
            while j < self.documents and self.at[j + 1] - self.at[i] <= read:
                j += 1
            block, base = self.file.read_at(self.at[j] - self.at[i], self.at[i]), self.at[i]
            for k in range(i, j):
                raw = self._decompress(block[self.at[k] - base : self.at[k + 1] - base], max_output_size=self.n[k] * self.width)
                yield self.doc_id[k], np.frombuffer(raw, f"<u{self.width}")
            i = j


def write(docs: DataFrame, folder: str, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, shards: int | None = None) -> list[tuple[str, int, int]]:
    """Write a set of files under `folder`; (path, documents, ids) of each shard, in order.

    Documents are dealt by ranges of doc_id, so the shards together are in ascending order
    (null first, equal ids by their texts' hashes). Each ends with `end_id`.
    """
    spark = docs.sparkSession
    dictionary = train(docs, tokenizer, doc_id=doc_id, text=text)
    with files.committed(f"{folder}/dictionary") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.repartitionByRange(n, "d").sortWithinPartitions("d", F.xxhash64("t")).select("d", "t", F.spark_partition_id().alias("p"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, first = encoder(tokenizer), next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        path, last = f"{folder}/shard-{first.column(2)[0].as_py():05d}.tok", np.array([end_id], coder.kind).tobytes()
        with files.committed(path) as out:
            shard = Writer(out, coder.width, shared.value)
            while first is not None:
                for a in range(0, first.num_rows, 256):
                    part = first.slice(a, 256)
                    for i, raw in zip(part.column(0).to_pylist(), coder.encode(part.column(1).to_pylist()), strict=True):
                        shard.add(i, raw + last)
                first = next(batches, None)
            shard.close()
        yield pa.RecordBatch.from_pydict({"path": [path], "documents": [len(shard.ids)], "ids": [sum(shard.n)]})

    made = rows.mapInArrow(written, "path string, documents long, ids long").collect()  # a row for each shard
    return sorted((r.path, r.documents, r.ids) for r in made)


def read(spark: SparkSession, folder: str, shards: list[tuple[str, int, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files alone; start is
    the number of ids before it in the whole set."""
    before = list(accumulate((n for *_, n in shards), initial=0))
    listed = [(path, at) for (path, *_), at in zip(shards, before, strict=False)]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not listed:
        return spark.createDataFrame([], schema)

    def loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, name = files.at(f"{folder}/dictionary")
        with system.open_input_file(name) as f:
            dictionary = f.read()
        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for i, ids in Shard(path, dictionary).documents_in_order():
                    rows.append((i, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    return spark.createDataFrame(listed, "path string, at long").repartition(len(listed)).mapInArrow(loaded, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])


def round_trip(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """The documents written as token files in the shared folder, and what reading them gives.

    Defined cases: null and empty texts have the end id alone; repeated and null ids keep
    their rows; an empty table gives no shards and no rows; other columns aren't written.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    return read(docs.sparkSession, folder, write(docs, folder, tokenizer, doc_id=doc_id, text=text, end_id=end_id))
