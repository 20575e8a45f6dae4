import logging
import sqlite3

import pytest
from test_sources import blob

from tessera.plans import matching
from tessera.schema import POI
from tessera.session import log_to
from tessera.sources.tables import MissingInput
from tessera.streaming import partial_output


def package(path, rows):
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    db.execute("INSERT INTO gpkg_geometry_columns VALUES ('apt', 'geom')")
    db.execute('CREATE TABLE apt (fid INTEGER PRIMARY KEY, geom BLOB, "postcode:pt-Latn" TEXT, housenumber TEXT, "street:pt-Latn" TEXT, "city:pt-Latn" TEXT, "suburb:pt-Latn" TEXT)')
    db.executemany("INSERT INTO apt VALUES (?, ?, ?, ?, ?, ?, ?)", rows)
    db.commit()
    db.close()
    return str(path)


def test_run(spark, tmp_path):
    def poi(i, **v):
        base = {"cnpj": f"{i:014d}", "uf": "SP", "tipo_logradouro": "AV", "logradouro": "DR JOSE E MARIA", "numero": str(i), "cep": "01310-100", "municipio_descricao": "SAO PAULO", "osm_category": "amenity=fuel"} | v
        return tuple(base.get(n) for n in POI.names)

    joined = f"{tmp_path}/joined.parquet"
    spark.createDataFrame([poi(1), poi(2, cep="9"), poi(3), poi(4, uf="RJ")], POI).write.parquet(joined)
    a = package(tmp_path / "a.gpkg", [(1, blob(-46.0, -23.0), "01310-100", "1", "Av. Dr José e Maria", "São Paulo", None)])
    b = package(tmp_path / "b.gpkg", [(1, blob(-46.5, -23.5), "1", "2 A", "AV DR JOSÉ MARIA", "SÃO PAULO", "x"), (2, None, "1", "3", "AV DR JOSE MARIA", "SAO PAULO", "x")])
    got = {int(r.cnpj): (r.geo_precision, r.lat, r.lon) for r in matching.run(spark, joined, [a, b], f"{tmp_path}/cache", f"{tmp_path}/out.parquet", ufs=["SP"], batches=2).collect()}
    assert got == {1: ("apt_cep_num_street", -23.0, -46.0), 2: ("apt_street_exact", -23.5, -46.5), 3: ("none", None, None)}
    assert matching.cached_index(spark, a, f"{tmp_path}/cache").count() == 1
    assert matching.run(spark, joined, [], f"{tmp_path}/cache", f"{tmp_path}/out.parquet").count() == 3
    with pytest.raises(MissingInput):
        matching.run(spark, joined, [], f"{tmp_path}/cache", f"{tmp_path}/other.parquet")
    cache = spark.createDataFrame([("01310100", 1.0, 1.0)], "cep string, lat double, lon double")
    path = partial_output(spark.read.parquet(joined), cache, f"{tmp_path}/geo.parquet", ["amenity=fuel"])
    assert sorted(r.geo_precision for r in spark.read.parquet(path).collect()) == ["cep", "cep", "cep", "pending"]


def test_log(tmp_path):
    log = log_to(str(tmp_path))
    log.info("hello")
    assert "hello" in (tmp_path / "tessera.log").read_text() and len(log_to(str(tmp_path)).handlers) == 2
    for h in list(log.handlers):
        log.removeHandler(h)
        h.close()
    logging.getLogger("tessera").setLevel(logging.NOTSET)
