import gzip
import json

import pyarrow.parquet as pq
import pytest

from tessera import sinks
from tessera.plans import export, pipeline
from tessera.schema import COMPANY, ESTABLISHMENT, RESAMPLE, VALIDATION
from tessera.sources import tables
from tessera.sources.config import Config
from tessera.streaming import match_batches, match_stream, progress, todo


def rows(spark):
    return spark.createDataFrame([("a", "é", 1.5, 2.5), ("b", None, None, 2.5)], "id string, name string, lat double, lon double")


def test_writers(spark, tmp_path):
    df, at = rows(spark), str(tmp_path)
    sinks.write_parquet(spark.range(300_000).coalesce(1), f"{at}/p.parquet", single=True)
    meta = pq.ParquetFile(f"{at}/p.parquet").metadata
    assert [meta.row_group(i).num_rows for i in range(3)] == [122_880, 122_880, 54_240] and meta.row_group(0).column(0).compression == "ZSTD"
    sinks.write_csv(df, f"{at}/c.csv.gz", single=True)
    assert gzip.open(f"{at}/c.csv.gz", "rt", encoding="utf-8").read().splitlines()[0] == "id,name,lat,lon"
    sinks.write_jsonl(df, f"{at}/j.jsonl", single=True)
    assert json.loads(open(f"{at}/j.jsonl", encoding="utf-8").read().splitlines()[1]) == {"id": "b", "name": None, "lat": None, "lon": 2.5}
    sinks.write_geojson(df.repartition(2), f"{at}/g.geojson")
    got = json.load(open(f"{at}/g.geojson", encoding="utf-8"))
    features = {f["properties"]["id"]: f for f in got["features"]}
    assert got["type"] == "FeatureCollection" and features["a"]["geometry"] == {"type": "Point", "coordinates": [2.5, 1.5]} and features["b"]["geometry"] is None
    assert features["a"]["properties"] == {"id": "a", "name": "é"} and "é" in open(f"{at}/g.geojson", encoding="utf-8").read()
    sinks.write_geojson(df.limit(0), f"{at}/e.geojson")
    assert json.load(open(f"{at}/e.geojson"))["features"] == []
    sinks.write_report(df, f"{at}/r.csv", ["id", "lat", "other"])
    assert tables.report(spark, f"{at}/r.csv").columns == ["id", "lat", "other"]
    assert len(VALIDATION) == 19 and len(RESAMPLE) == 20


def test_export_skips_what_is_there(spark, tmp_path):
    df, at = rows(spark), str(tmp_path / "x")
    paths = sinks.export(df, at, ["parquet", "jsonl"])
    assert sinks.export(df.limit(0), at, ["parquet", "jsonl"]) == paths and spark.read.parquet(paths[0]).count() == 2
    sinks.export(df.limit(0), at, ["parquet"], force=True)
    assert spark.read.parquet(paths[0]).count() == 0
    with pytest.raises(ValueError, match="unknown format"):
        sinks.export(df, at, ["xls"])


def test_names():
    assert sinks.safe_name("amenity=fuel", ["sp", "RJ"]) == "amenity_fuel_RJ_SP" and sinks.safe_name() == "poi_export"
    assert sinks.slug(["amenity=b/c", "amenity=a"]) == "amenity=a_amenity=b-c"


def line(schema, **values):
    return ";".join(f'"{values.get(n, "")}"' for n in schema.names) + "\r\n"


@pytest.fixture
def run(spark, tmp_path):
    raw = tmp_path / "in" / "2026-05-10"
    raw.mkdir(parents=True)
    place = {"cnae_fiscal_principal": "10", "municipio": "7", "uf": "SP", "cep": "01310-100", "tipo_logradouro": "R", "logradouro": "A", "numero": "1"}
    (raw / "Estabelecimentos0.csv").write_text("".join(line(ESTABLISHMENT, cnpj_basico=f"0000000{i}", cnpj_ordem="0001", cnpj_dv="00", situacao_cadastral="02" if i < 4 else "08", **place) for i in range(1, 6)), "cp1252")
    (raw / "Empresas0.csv").write_text("".join(line(COMPANY, cnpj_basico=f"0000000{i}", porte="05" if i == 3 else "01", natureza_juridica="2062") for i in range(1, 6)), "cp1252")
    for name, text in (("Cnaes", '"10";"Posto"\r\n'), ("Naturezas", '"2062";"Ltda"\r\n'), ("Municipios", '"7";"SÃO PAULO"\r\n')):
        (raw / f"{name}.csv").write_bytes(text.encode("cp1252"))
    (tmp_path / "tags.yaml").write_text('"10": "amenity=fuel"\n')
    config = Config(input_dir=f"{tmp_path}/in", intermediate_dir=f"{tmp_path}/mid", cache_dir=f"{tmp_path}/cache", output_dir=f"{tmp_path}/out", tag_map=f"{tmp_path}/tags.yaml")
    return pipeline.Run(spark, "2026-05-10", config)


def look_up(p):
    return 200, '{"location": {"coordinates": {"longitude": "-46.5", "latitude": "-23.5"}}}'


def test_pipeline(spark, run):
    from tessera.session import prepared

    prepared(spark)
    with pytest.raises(tables.MissingInput):
        run.run("join")
    assert run.run(skip_download=True, count=True) == 2
    run.lookup_client = look_up
    run.run("geocode")
    got = spark.read.parquet(f"{run.config.output_dir}/2026-05-10/poi.parquet").orderBy("cnpj").collect()
    assert [(r.cnpj, r.osm_category, r.municipio_descricao, r.lat, r.geo_precision) for r in got] == [(f"0000000{i}000100", "amenity=fuel", "SÃO PAULO", -23.5, "cep") for i in (1, 2)]
    assert spark.read.parquet(f"{run.config.cache_dir}/cep.parquet").count() == 1
    assert export.filtered(spark.read.parquet(run.best()), "", category="amenity", count_only=True) == 2
    paths = export.filtered(spark.read.parquet(run.at("joined")), run.config.output_dir, ufs=["sp"], category="amenity=fuel", formats=["geojson"])
    assert paths[0].endswith("/amenity_fuel_SP.geojson")
    assert [f["geometry"] for f in json.load(open(paths[0]))["features"]] == [None, None]
    with pytest.raises(SystemExit):
        pipeline.parser().parse_args(["--from-step", "none"])


P = "cnpj string, cep_norm string, num_norm string, street_norm string, city_norm string, bairro_norm string"
A = "cep_norm string, num_norm string, street_norm string, city_norm string, suburb_norm string, lat double, lon double"


def test_batches_resume(spark, tmp_path):
    pois = spark.createDataFrame([(str(i), "1", str(i % 7), "RUA", "C", None) for i in range(40)], P)
    index = spark.createDataFrame([("1", str(i), "RUA", "C", "", float(i), 0.0) for i in range(5)], A)
    folder, calls = str(tmp_path / "progress"), []
    assert progress(spark, folder).count() == 0
    some = match_batches(pois, index, folder, batches=4, stop=lambda: calls.append(1) or len(calls) > 2)
    n = some.count()
    left = todo(pois, folder).count()
    assert 0 < n < 30 and left == 40 - n
    assert match_batches(pois, index, folder, batches=4).count() == 30
    assert todo(pois, folder).count() == 10


def test_stream(spark, tmp_path):
    index = spark.createDataFrame([("1", str(i), "RUA", "C", "", float(i), 0.0) for i in range(5)], A)
    make = lambda a, b: spark.createDataFrame([(str(i), "1", str(i % 5), "RUA", "C", None) for i in range(a, b)], P)
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    make(0, 6).write.parquet(source)
    for more in (None, (4, 10)):
        if more:
            make(*more).write.mode("append").parquet(source)
        match_stream(spark, source, make(0, 1).schema, index, out, check).awaitTermination()
    assert sorted(int(r.cnpj) for r in progress(spark, out).collect()) == list(range(10))
    assert len(list((tmp_path / "out").glob("batch=*"))) == 2
