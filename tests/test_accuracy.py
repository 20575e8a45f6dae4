import pytest

from tessera.plans import accuracy
from tessera.schema import RESAMPLE, VALIDATION
from tessera.sources import clients, tables

POI = "cnpj string, razao_social string, uf string, municipio string, municipio_descricao string, bairro string, tipo_logradouro string, logradouro string, numero string, complemento string, cep string, lat double, lon double, geo_precision string"
INDEX = "cep_norm string, num_norm string, street_norm string, city_norm string, suburb_norm string, lat double, lon double"


def reference(p):
    n = int(p["streetNumber"])
    if n % 10 == 9:
        return 200, '{"results": []}'
    if n % 10 == 8:
        return 500, ""
    return 200, '{"results": [{"type": "Street", "score": 9.5, "position": {"lat": %s, "lon": 0.0}}]}' % (n / 1000 + 0.001)


@pytest.fixture
def pois(spark):
    rows = [(f"{i:03d}", "X", "SP", "1", "CITY", None, "R", "AUGUSTA", str(i), None, "1", i / 1000, 0.0, "apt_cep_num_street" if i % 4 else "apt_street_exact") for i in range(40)]
    rows.append(("none", "X", "SP", "1", "CITY", None, "R", "B", "1", None, "1", None, None, "none"))
    return spark.createDataFrame(rows, POI)


def test_validate_and_resample(spark, pois, tmp_path):
    assert accuracy.draw(pois, 12).count() == 12
    report = accuracy.run(pois, reference, f"{tmp_path}/v.csv", n=40, retry=clients.Retry(attempts=1, sleep=print))
    assert tables.report(spark, f"{tmp_path}/v.csv").columns == VALIDATION
    o = report.outcome.first()
    assert (o.n, o.matched, o.no_result, o.errors, o.match_rate) == (40, 32, 4, 4, 80.0)
    assert report.distances.first().p50 == pytest.approx(111.19, abs=0.01)
    assert [r.n for r in report.buckets.orderBy("bucket").collect()] == [0, 32, 0, 0, 0, 0]
    index = spark.createDataFrame([("1", str(i), "RUA AUGUSTA", "CITY", "", i / 1000 + 0.001, 0.0) for i in range(40) if i % 5], INDEX)
    got = accuracy.resample(spark, f"{tmp_path}/v.csv", pois, index, f"{tmp_path}/r.csv")
    assert tables.report(spark, f"{tmp_path}/r.csv").columns == RESAMPLE
    r = got.rows.where("cnpj = '001'").first()
    assert (r.old_distance_m, r.new_distance_m, r.delta_m, r.new_precision) == (111.2, 0.0, -111.2, "apt_cep_num_street")
    assert {r.new_precision: r.p50 for r in got.after.collect()}["ALL"] == 0.0
    assert tuple(got.changes.first()) == (0, 8)
    assert {(r.old_precision, r.new_precision) for r in got.moves.collect()} == {("apt_street_exact", "apt_cep_num_street"), ("apt_street_exact", "none"), ("apt_cep_num_street", "none")}


def test_locate(spark, tmp_path):
    (tmp_path / "b_1").mkdir()
    assert accuracy.locate(spark, [f"{tmp_path}/a*", f"{tmp_path}/b*"]).endswith("b*")
    with pytest.raises(tables.MissingInput):
        accuracy.locate(spark, [f"{tmp_path}/c"])
