import base64
import hashlib
import io
import zlib

import pytest

from tessera.llm import warc
from tessera.llm.common import scratch_path

ROWS = [(1, "http://a/é x", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://c", None), (4, "http://d", ""), (5, "u", "é" * 2_000_000), (6, "u", "two\r\n\r\nWARC/1.1\r\n"), (7, "u", "<p>one</p>"), (7, "u", "<p>one</p>"), (None, "u", "<p>one</p>"), (None, "u", "lone")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, sha1 string").repartition(2)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(pages):
    got = [(r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()]
    want = []
    for i, _, html in ROWS:
        same = [j for j, _, h in ROWS if (h or "") == (html or "") and j]
        revisit = bool(same) and i != max(same)
        want.append((i or 0, len((html or "").encode()), digest(html), "revisit" if revisit else "response", max(same) if revisit else None))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_smaller_payloads_are_all_responses(pages):
    got = warc.round_trip(pages, least=5).collect()
    assert {r.record_type for r in got if r.payload_bytes < 5} == {"response"} and any(r.record_type == "revisit" for r in got)


def test_chunks(spark, pages):
    paths = warc.write(warc.planned(pages), scratch_path(spark, "warc"))
    rows = warc.chunk_table(spark, paths).where("page_id = 5").orderBy("chunk").collect()
    assert [r.last for r in rows] == [False, False, False, True] and {r.payload_bytes for r in rows} == {4_000_000}
    bare = warc.chunk_table(spark, paths, data=False)
    assert "data" not in bare.columns and bare.count() == warc.record_table(spark, paths).count() + 3
    whole = ("é" * 2_000_000).encode()
    assert [r.chunk for r in rows] == [0, 1, 2, 3] and b"".join(bytes(r.data) for r in rows) == whole
    for r in rows:
        assert r.payload_digest == base64.b32encode(hashlib.sha1(whole[: r.bytes]).digest()).decode()


def test_a_damaged_archive_is_refused():
    out = io.BytesIO()
    warc.add(out, 1, "u", memoryview(b"x" * 100), hashlib.sha1(b"x" * 100).hexdigest(), None)
    raw = out.getvalue()
    assert [c.size for c in warc.chunks(warc.inflated(io.BytesIO(raw)), 30)] == [30, 60, 90, 100]
    plain = zlib.decompress(raw, 31)
    with pytest.raises(ValueError, match="ends within"):
        list(warc.chunks(iter([plain[:-30]])))


def test_a_damaged_payload_is_refused(spark, tmp_path):
    for name, payload in (("good", b"x" * 3_000_000), ("bad", b"y" + b"x" * 2_999_999)):
        with open(f"{tmp_path}/{name}", "wb") as out:
            warc.add(out, 1, "u", memoryview(payload), hashlib.sha1(b"x" * 3_000_000).hexdigest(), None)
    good = warc.record_table(spark, [f"{tmp_path}/good"]).collect()
    assert [(r.payload_bytes, r.payload_digest) for r in good] == [(3_000_000, digest("x" * 3_000_000))]
    with pytest.raises(Exception, match="damaged payload in record 0"):
        warc.record_table(spark, [f"{tmp_path}/bad"]).collect()


def test_the_other_way_to_join_revisits(pages, monkeypatch):
    want = sorted(map(str, warc.round_trip(pages).collect()))
    monkeypatch.setattr(warc, "BROADCAST", 0)
    assert sorted(map(str, warc.round_trip(pages).collect())) == want


def test_empty(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0
