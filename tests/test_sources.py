import sqlite3
import struct
import zipfile

import pytest

from tessera.schema import strings
from tessera.session import prepared
from tessera.sources import archives, clients, download, geopackage, tables

RAW = b'"1";"";"x"\r\n"2";;"y"\r\n"3";"S\xe3o Paulo";"02"\r\n"5";"short"\r\n"6";"a ""q"" b";"z"\r\n"7";"a;b";"  pad "\r\n'
WANT = [("1", None, "x"), ("2", None, "y"), ("3", "São Paulo", "02"), ("6", 'a "q" b', "z"), ("7", "a;b", "  pad ")]


def test_registry_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(RAW)
    df = tables.registry_csv(prepared(spark), str(tmp_path / "a.csv"), strings("a b c"))
    assert sorted(map(tuple, df.collect())) == WANT and df.count() == 5 and df.select("a").count() == 5


def test_zips(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "ok.zip", "w") as z:
        z.writestr("data/A.csv", RAW)
        z.writestr("second.csv", "no")
    (tmp_path / "bad.zip").write_bytes(b"PK" + b"0" * 50)
    (tmp_path / "tiny.zip").write_bytes(b"PK")
    assert archives.is_zip(tmp_path / "ok.zip") and not archives.is_zip(tmp_path / "bad.zip") and not archives.is_zip(tmp_path / "none.zip")
    got = {r.path.rsplit("/", 1)[1]: r.valid for r in archives.check(spark, f"{tmp_path}/*.zip").collect()}
    assert got == {"ok.zip": True, "bad.zip": False, "tiny.zip": False}
    out = archives.extract(tmp_path / "ok.zip", tmp_path / "out")
    assert out.name == "A.csv" and out.read_bytes() == RAW
    before = out.stat().st_mtime_ns
    assert archives.extract_all([tmp_path / "ok.zip"], tmp_path / "out") == [str(out)] and out.stat().st_mtime_ns == before
    rows = archives.zipped_csv(spark, f"{tmp_path}/ok.zip", strings("a b c"))
    assert sorted(map(tuple, rows.collect())) == WANT and rows.count() == 5


def blob(x, y, envelope=0, little=True, empty=False):
    flags = (envelope << 1) | int(little) | (0x10 if empty else 0)
    e = "<" if little else ">"
    return b"GP\x00" + bytes([flags]) + struct.pack(f"{e}i", 4326) + b"\x00" * geopackage.ENVELOPE[envelope] + bytes([int(little)]) + struct.pack(f"{e}Idd", 1, x, y)


def test_geopackage(spark, tmp_path):
    path = str(tmp_path / "p.gpkg")
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    db.execute("INSERT INTO gpkg_geometry_columns VALUES ('apt', 'geom')")
    db.execute('CREATE TABLE apt (fid INTEGER PRIMARY KEY, geom BLOB, "city:pt-Latn" TEXT, housenumber TEXT)')
    rows = [(1, blob(1.5, -2.5), "São", "1"), (5, blob(3, 4, 1), None, "2"), (9, blob(5, 6, 0, False), "x", None), (10, None, "no", "3"), (11, blob(0, 0, empty=True), "no", "4"), (12, b"junk", "no", "5")]
    db.executemany("INSERT INTO apt VALUES (?, ?, ?, ?)", rows)
    db.commit()
    db.close()
    got = sorted(map(tuple, geopackage.points(spark, path, ["city:pt-Latn", "housenumber"], slices=3).collect()), key=str)
    assert got == [("São", "1", -2.5, 1.5), ("x", None, 6.0, 5.0), (None, "2", 4.0, 3.0)] or set(got) == {("São", "1", -2.5, 1.5), (None, "2", 4.0, 3.0), ("x", None, 6.0, 5.0)}
    assert geopackage.points(spark, path).columns == ["fid", "city:pt-Latn", "housenumber", "lat", "lon"]
    with pytest.raises(ValueError, match="layer"):
        geopackage.layer(path, "other")


def test_download(tmp_path):
    zipped = b"x" * 100 + archives.END_MARK + b"\0" * 18
    asked, waited = [], []

    def get(url, headers):
        asked.append((url, dict(headers)))
        if url.endswith("/arquivos/"):
            return download.Response(200, b'<a href="2026-01-10/"><a href="2026-05-10/"><a href="old/">')
        if url.endswith("2026-05-10/"):
            return download.Response(200, b'<a href="Empresas0.zip"><a href="cnaes.zip"><a href="?C=N"><a href="/up.zip"><a href="Gone1.zip"><a href="Empresas1.zip">')
        if "Gone" in url:
            return download.Response(404)
        if "Empresas1" in url:
            return download.Response(500)
        if "Range" in headers:
            at = int(headers["Range"][6:-1])
            return download.Response(416) if at >= len(zipped) else download.Response(206, zipped[at:])
        return download.Response(200, zipped)

    assert download.latest_dump(get, "http://h") == "2026-05-10"
    files = download.list_files(get, "http://h", "2026-05-10")
    assert [f["name"] for f in files] == ["Empresas0.zip", "cnaes.zip", "Gone1.zip", "Empresas1.zip"]
    assert [f["name"] for f in download.of_kinds(files, ["emp", "cnae"])] == ["Empresas0.zip", "cnaes.zip", "Empresas1.zip"]
    (tmp_path / "cnaes.zip").write_bytes(zipped)
    got = download.fetch_all(get, files, tmp_path, attempts=download.Attempts(2, sleep=waited.append))
    assert (got.done, got.skipped, got.missing, got.failed) == (["Empresas0.zip"], ["cnaes.zip"], ["Gone1.zip"], ["Empresas1.zip"])
    assert waited == [5.0]
    part = tmp_path / "part.zip"
    part.write_bytes(zipped[:30])
    assert download.fetch(get, "http://h/part.zip", part, resume=True).read_bytes() == zipped
    assert asked[-1][1] == {"Range": "bytes=30-"}
    assert download.fetch(get, "http://h/part.zip", part, resume=True).read_bytes() == zipped
    with pytest.raises(OSError, match="dated"):
        download.latest_dump(lambda u, h: download.Response(200, b""), "http://h")


def test_maps_and_lookups(spark, tmp_path):
    (tmp_path / "m.yaml").write_text('# codes\n"1": "amenity=fuel"  # one\n\n2: shop=car # two\n"1": \'amenity=bar\'\n', encoding="utf-8")
    assert tables.read_map(tmp_path / "m.yaml") == {"1": "amenity=bar", "2": "shop=car"}
    with pytest.raises(tables.MissingInput):
        tables.lookup(spark, f"{tmp_path}/none*.csv")
    assert tables.lookup(spark, f"{tmp_path}/none*.csv", required=False) is None
    (tmp_path / "Cnaes.csv").write_bytes(b'"01";"Caf\xe9"\n')
    assert tables.lookup(spark, f"{tmp_path}/Cnaes*.csv").first().descricao == "Café"
    spark.createDataFrame([(3550308, 1.0, 2.0)], "municipio int, lat_centro float, lon_centro float").write.parquet(f"{tmp_path}/c.parquet")
    assert tables.centres(spark, f"{tmp_path}/c.parquet").first().municipio == "3550308"


def lookup_service(p):
    key = p["cep"]
    if key == "00000003":
        return 404, ""
    if key == "00000004":
        return 500, ""
    if key == "00000005":
        return 200, '{"location": {"coordinates": {}}}'
    return 200, '{"location": {"coordinates": {"longitude": "-46.5", "latitude": "-23.5"}}}'


def structured_service(p):
    kind = p.get("streetNumber")
    if kind == "403":
        return 403, ""
    if kind == "9":
        return 200, '{"results": []}'
    name = {"1": "Street", "2": "Point Address"}.get(kind, "Other")
    return 200, '{"results": [{"type": "%s", "position": {"lat": 1.5, "lon": 2.5}, "asked": "%s"}]}' % (name, p.get("streetName"))


def test_clients(spark):
    quick = clients.Retry(sleep=print)
    keys = spark.createDataFrame([(f"0000000{i}",) for i in range(1, 6)], "cep string")
    got = {r.cep: (r.lat, r.lon) for r in clients.look_up(keys, lookup_service, retry=quick).collect()}
    assert got == {"00000001": (-23.5, -46.5), "00000002": (-23.5, -46.5), "00000003": (None, None), "00000005": (None, None)}
    pois = spark.createDataFrame([("a", " R ", "X", "1", "1", "SP"), ("b", None, "Y", "2", None, " "), ("c", "", " ", "9", "5", "SP"), ("d", "R", "Z", "403", "6", None), ("e", "R", "Z", None, "7", "RJ")], "cnpj string, tipo_logradouro string, logradouro string, numero string, cep string, uf string")
    pois = pois.withColumn("municipio_descricao", pois.uf)
    got = {r.cnpj: (r.lat, r.geo_precision) for r in clients.structured(pois, structured_service, retry=quick).collect()}
    assert got == {"a": (1.5, "tomtom_street"), "b": (1.5, "tomtom_point_address"), "c": (None, "none"), "d": (None, "failed"), "e": (1.5, "tomtom_unknown")}
