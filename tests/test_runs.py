"""The commands as a whole: fetched files in, exit codes and files out, against stand-ins for all services."""

import io
import json
import logging
import os
import signal
import sqlite3
import struct
import zipfile

import pytest
from test_matching import package
from test_plans import line, look_up
from test_sources import blob

from tessera.plans import accuracy, pipeline
from tessera.schema import COMPANY, ESTABLISHMENT, KEY_CACHE, VALIDATION
from tessera.sources import clients, download, geopackage, tables
from tessera.sources.config import Config
from tessera.streaming import Stop, answers, ask_in_batches


@pytest.fixture(autouse=True)
def quiet():
    yield
    log = logging.getLogger("tessera")
    for h in list(log.handlers):
        log.removeHandler(h)
        h.close()
    log.setLevel(logging.NOTSET)


def zipped(name, text):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(name, text.encode("cp1252"))
    return out.getvalue()


def service(n=6):
    place = {"situacao_cadastral": "02", "cnae_fiscal_principal": "10", "municipio": "7", "uf": "SP", "tipo_logradouro": "R", "logradouro": "AUGUSTA", "numero": "1"}
    estab = "".join(line(ESTABLISHMENT, cnpj_basico=f"0000000{i}", cnpj_ordem="0001", cnpj_dv="00", cep=f"0131010{i}", **place) for i in range(n))
    companies = "".join(line(COMPANY, cnpj_basico=f"0000000{i}", porte="01", natureza_juridica="2062") for i in range(n))
    files = {"Estabelecimentos0": estab, "Empresas0": companies, "Cnaes": '"10";"Posto"\r\n', "Naturezas": '"2062";"Ltda"\r\n', "Municipios": '"7";"SÃO PAULO"\r\n', "Socios0": "x"}
    pages = {"/arquivos/": '<a href="2026-01-10/">x</a><a href="2026-05-10/">y</a><a class="z" href="nothing">', "/arquivos/2026-05-10/": "".join(f"<td><a href='{f}.zip'>{f}</a>" for f in files)}
    asked = []

    def get(url, headers):
        path = url.removeprefix("http://h")
        asked.append(path)
        if path in pages:
            return download.Response(200, pages[path].encode())
        name = path.rsplit("/", 1)[-1].removesuffix(".zip")
        return download.Response(200, zipped(f"{name}.csv", files[name])) if name in files else download.Response(404)

    return get, asked, files


def arguments(tmp_path, *more):
    (tmp_path / "tags.yaml").write_text('"10": "amenity=fuel"\n')
    dirs = [f"--{d}-dir={tmp_path}/{d}" for d in ("input", "intermediate", "cache", "output", "log")]
    return [*dirs, f"--tag-map={tmp_path}/tags.yaml", *more]


def test_from_download_to_export(spark, tmp_path, capsys):
    get, asked, files = service()
    argv = arguments(tmp_path, "--base-url", "http://h", "--format", "jsonl")
    assert pipeline.main(argv, transport=get, lookup_client=look_up) == 0
    assert not any("Socios" in p for p in asked)
    out = next((tmp_path / "output/2026-05-10").glob("poi.jsonl/part-*"))
    rows = [json.loads(x) for p in out.parent.glob("part-*") for x in p.read_text().splitlines()]
    assert len(rows) == 6 and {r["lat"] for r in rows} == {-23.5} and "step export" in (tmp_path / "log/tessera.log").read_text()
    assert pipeline.main([*argv, "--from-step", "join", "--count"], transport=get) == 0 and capsys.readouterr().out.split()[-1] == "6"
    before = len(asked)
    assert pipeline.main([*argv, "--skip-download", "--date", "2026-05-10"], transport=get) == 0 and len(asked) == before


def test_what_is_missing_ends_with_1(tmp_path):
    get, _, files = service()
    assert pipeline.main(arguments(tmp_path)) == 1  # neither a date nor an address
    assert pipeline.main(arguments(tmp_path, "--date", "2026-05-10")) == 1  # no address to download from
    assert pipeline.main(arguments(tmp_path, "--date", "2026-05-10", "--from-step", "join")) == 1
    del files["Empresas0"]
    quick = download.Attempts(1, sleep=print)
    assert pipeline.main(arguments(tmp_path, "--base-url", "http://h"), transport=get, attempts=quick) == 1  # listed, but gone
    get, _, _ = service()
    argv = arguments(tmp_path, "--base-url", "http://h")
    (tmp_path / "tags.yaml").unlink()
    assert pipeline.main(argv, transport=get) == 1 and "--tag-map" in (tmp_path / "log/tessera.log").read_text()


def test_interrupted_lookups_are_kept(spark, tmp_path):
    get, _, _ = service()
    calls = f"{tmp_path}/calls"

    def client(p):
        with open(calls, "a") as f:
            f.write(p["cep"] + "\n")
        return look_up(p)

    argv = arguments(tmp_path, "--base-url", "http://h", "--flush", "2", "--partial-every", "2")
    assert pipeline.main([*argv, "--count"], transport=get) == 0
    config = Config(**{k: v for k, v in vars(pipeline.parser().parse_args(argv)).items() if k in pipeline.SETTINGS})
    count = lambda: len(open(calls).read().split())
    run = pipeline.Run(spark, "2026-05-10", config, lookup_client=client, stop=lambda: os.path.exists(calls))
    with pytest.raises(pipeline.Stopped) as stopped:
        run.geocode()
    first = count()
    part = [r.geo_precision for r in spark.read.parquet(str(stopped.value)).collect()]
    assert 0 < first < 6 and part.count("cep") == first and part.count("pending") == 6 - first
    run = pipeline.Run(spark, "2026-05-10", config, lookup_client=client)
    assert {r.geo_precision for r in run.geocode().collect()} == {"cep"}
    assert count() == 6 == len(set(open(calls).read().split()))  # nothing is asked twice
    assert spark.read.parquet(f"{tmp_path}/cache/cep.parquet").count() == 6 and not os.path.exists(f"{tmp_path}/cache/cep.answers")


def test_failed_batches_leave_the_others(spark, tmp_path):
    keys = spark.createDataFrame([(f"{i:08d}",) for i in range(20)], "cep string")
    batches = []

    def ask(k):
        batches.append(1)
        if len(batches) == 3:
            raise OSError("gone")
        return clients.look_up(k, look_up)

    with pytest.raises(OSError):
        ask_in_batches(keys, ask, f"{tmp_path}/a", KEY_CACHE, "cep", size=4)
    kept = answers(spark, f"{tmp_path}/a", KEY_CACHE).count()
    assert 0 < kept < 20
    assert ask_in_batches(keys, lambda k: clients.look_up(k, look_up), f"{tmp_path}/a", KEY_CACHE, "cep", size=4).count() == 20


def test_stop():
    before = signal.signal(signal.SIGINT, signal.default_int_handler)
    with Stop() as stop:
        assert not stop()
        os.kill(os.getpid(), signal.SIGINT)
        assert stop()
        with pytest.raises(KeyboardInterrupt):
            os.kill(os.getpid(), signal.SIGINT)
    assert signal.signal(signal.SIGINT, before) is signal.default_int_handler


def test_an_interrupted_command_ends_with_130(spark, tmp_path):
    get, _, _ = service()
    assert pipeline.main(arguments(tmp_path, "--base-url", "http://h"), transport=interrupt_once(get), lookup_client=look_up) == 130


def interrupt_once(get):
    sent = []

    def once(url, headers):
        if not sent:
            sent.append(os.kill(os.getpid(), signal.SIGINT))
        return get(url, headers)

    return once


def test_http_clients(monkeypatch):
    asked = []
    monkeypatch.setattr(clients, "http_get", lambda url, timeout: asked.append(url) or (200, "{}"))
    clients.HttpLookup("http://c/v2/{cep}")({"cep": "01/2"})
    clients.HttpStructured("http://s/geo", "k y")({"streetName": "R É", "streetNumber": None, "limit": 1})
    assert asked == ["http://c/v2/01%2F2", "http://s/geo?streetName=R+%C3%89&limit=1&key=k+y"]


def test_accuracy_commands(spark, tmp_path, capsys):
    poi = "cnpj string, razao_social string, uf string, municipio string, municipio_descricao string, bairro string, tipo_logradouro string, logradouro string, numero string, complemento string, cep string, lat double, lon double, geo_precision string"
    rows = [(f"{i}", "X", "SP", "1", "CITY", None, "R", "AUGUSTA", str(i), None, "1", i / 1000, 0.0, "apt_street_exact") for i in range(1, 9)]
    spark.createDataFrame(rows, poi).write.parquet(f"{tmp_path}/mid/geocoded_2026-05-10.parquet")
    where = ["--intermediate-dir", f"{tmp_path}/mid", "--log-dir", f"{tmp_path}/log"]
    answer = lambda p: (200, '{"results": [{"type": "Street", "position": {"lat": %s, "lon": 0.0}}]}' % (int(p["streetNumber"]) / 1000 + 0.001))
    assert accuracy.main(["validate", *where, "--out", f"{tmp_path}/v.csv", "--n", "8"], client=answer) == 0
    said = capsys.readouterr().out
    assert "match_rate" in said and "50-200 m 100.0% " + "#" * 40 in said
    assert tables.report(spark, f"{tmp_path}/v.csv").columns == VALIDATION
    apt = package(tmp_path / "a.gpkg", [(i, blob(0.0, i / 1000), "1", str(i), "R. Augusta", "City", None) for i in range(1, 5)])
    assert accuracy.main(["resample", *where, "--out", f"{tmp_path}/r.csv", "--report", f"{tmp_path}/v.csv", "--package", apt, "--cache-dir", f"{tmp_path}/cache"]) == 0
    said = capsys.readouterr().out
    assert "apt_cep_num_street" in said and "dropped" in said
    assert accuracy.main(["validate", *where, "--date", "1999-01-01", "--out", "x"], client=answer) == 1
    assert accuracy.main(["validate", *where, "--out", "x"]) == 1


def polygon(*rings, kind=3):
    body = b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r) for r in rings)
    return struct.pack("<BII", 1, kind, len(rings)) + body


def test_centres_of_polygons(spark, run_folder, tmp_path):
    head = b"GP\0\1" + struct.pack("<i", 4326)
    square = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    hole = [(0, 0), (0, 4), (2, 4), (2, 0), (0, 0)]
    far = [(x + 10, y) for x, y in square]
    assert geopackage.centroid(head + polygon(square)) == (2.0, 2.0)
    assert geopackage.centroid(head + polygon(square, hole)) == (3.0, 2.0)
    assert geopackage.centroid(head + struct.pack("<BII", 1, 6, 2) + polygon(square) + polygon(far)) == (7.0, 2.0)
    assert geopackage.centroid(None) is geopackage.centroid(head) is geopackage.centroid(blob(1.0, 2.0)) is geopackage.centroid(head + polygon([])) is None
    db = sqlite3.connect(f"{tmp_path}/c.gpkg")
    db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    db.execute("INSERT INTO gpkg_geometry_columns VALUES ('m', 'geom')")
    db.execute("CREATE TABLE m (fid INTEGER PRIMARY KEY, geom BLOB, code_muni REAL)")
    db.execute("INSERT INTO m VALUES (1, ?, 3550308.0), (2, NULL, 1.0)", (head + polygon([(x - 48.5, y - 25.5) for x, y in square]),))
    db.commit()
    db.close()
    spark.createDataFrame([("7", "3550308")], "codigo_rf string, codigo_ibge string").write.parquet(f"{tmp_path}/codes.parquet")
    config, get = run_folder
    run = pipeline.Run(spark, "2026-05-10", Config(**{**config, "centres_package": f"{tmp_path}/c.gpkg", "city_codes": f"{tmp_path}/codes.parquet"}), lookup_client=look_up, transport=get)
    run.run(until="geocode")
    assert {r.geo_precision for r in spark.read.parquet(run.geocoded_path()).collect()} == {"municipio_centroid"}  # (-23.5, -46.5) is the centre


@pytest.fixture
def run_folder(tmp_path):
    get, _, _ = service()
    a = pipeline.parser().parse_args(arguments(tmp_path, "--base-url", "http://h"))
    return {k: getattr(a, k) for k in pipeline.SETTINGS}, get
