import pytest
from pyspark.sql import functions as F

from tessera.operators import enrich, filters, geocode, match, validate
from tessera.schema import COMPANY, ESTABLISHMENT, POI


def test_three_valued_exclusion(spark):
    df = spark.createDataFrame([("01", "2062"), ("05", "2062"), ("01", "2135"), (None, "2062"), ("01", None)], "porte string, natureza_juridica string")
    assert [tuple(r) for r in filters.without(df).collect()] == [("01", "2062")]


def test_predicates(spark):
    df = spark.createDataFrame([("SP", "amenity=fuel", "1"), ("RJ", "amenity_x=fuel", "2"), (None, None, "1")], "uf string, osm_category string, cnae_fiscal_principal string")
    n = lambda *a: filters.select_where(df, *a).count()
    assert (n(), n(["sp"]), n(None, "amenity"), n(None, "amenity=fuel"), n(None, None, ["1"]), n(["SP"], "amenity", ["2"])) == (3, 1, 1, 1, 2, 0)
    assert filters.remaining(df, spark.createDataFrame([(None,), ("SP",)], "uf string"), "uf").count() == 2


def row(schema, **values):
    return tuple(values.get(f) for f in schema.names)


@pytest.fixture(scope="module")
def star(spark):
    est = [row(ESTABLISHMENT, cnpj_basico=b, cnpj_ordem="1", cnpj_dv="7", uf=uf, cnae_fiscal_principal=code, municipio=m) for b, uf, code, m in [("00000001", "SP", "10", "9"), ("00000001", "RJ", "10", "8"), ("00000002", "SP", "99", None), ("00000003", "SP", "10", "9")]]
    com = [row(COMPANY, cnpj_basico=b, natureza_juridica="5", porte="01") for b in ("00000001", "00000002")]
    two = "codigo string, descricao string"
    return {
        "establishments": spark.createDataFrame(est, ESTABLISHMENT), "companies": spark.createDataFrame(com, COMPANY), "tags": enrich.tag_table(spark, {"10": "amenity=fuel"}),
        "activities": spark.createDataFrame([("10", "Fuel")], two), "cities": spark.createDataFrame([("9", "City")], two),
    }


def test_enrich(star):
    rows = enrich.enrich(**star).orderBy("cnpj_basico", "uf").collect()
    assert rows[0].__fields__ == POI.names
    got = [(r.cnpj, r.cnae_fiscal_principal_descricao, r.municipio_descricao, r.natureza_juridica_descricao, r.osm_category) for r in rows]
    assert got == [("00000001000107", "Fuel", "8", "5", "amenity=fuel"), ("00000001000107", "Fuel", "City", "5", "amenity=fuel"), ("00000002000107", "99", None, "5", None)]


def test_filter_or_condition(star):
    assert [r.uf for r in enrich.enrich(**star, ufs=["SP"], codes=["10"]).collect()] == ["SP"]
    compat = enrich.enrich(**star, ufs=["SP"], compat_on_filter=True).collect()
    assert sorted((r.uf, r.osm_category or "") for r in compat) == [("RJ", ""), ("SP", ""), ("SP", "amenity=fuel")]


P = "cnpj string, cep_norm string, num_norm string, street_norm string, city_norm string, bairro_norm string"
A = "cep_norm string, num_norm string, street_norm string, city_norm string, suburb_norm string, lat double, lon double"


@pytest.mark.parametrize(
    ("poi", "points", "want"),
    [
        (("1", "10", "RUA AUGUSTA"), [("1", "10", "RUA AUGUSTO", 1)], ("apt_cep_num_street", 1)),
        (("1", "10", "RUA ABCDEF"), [("1", "10", "RUA ZZCDEX", 1)], None),
        (("1", "10", "RUA AUGUSTA"), [("1", "10", "RUA AUGUSTO", 1), ("1", "10", "RUA AUGUSTA", 2)], ("apt_cep_num_street", 2)),
        (("1", "10", "RUA AUGUSTA"), [("2", "10", "RUA AUGUSTA", 1)], ("apt_street_exact", 1)),
        (("1", "10", "RUA AUGUSTA"), [("2", "10", "RUA AUGUSTA", 1, "JARDIM SAO JOAO"), ("3", "10", "RUA AUGUSTA", 2, "OTHER")], ("apt_street_exact", 1)),
        (("1", "10", "RUA AUGUSTA"), [("2", "10", "RUA AUGUSTA", 1, "JD SAO JOAO"), ("3", "10", "RUA AUGUSTA", 2, "JD SAO JOAO")], None),
        (("1", "10", "RUA AUGUSTA"), [("2", "10", "RUA AUGUSTA", 1, "XX"), ("3", "10", "RUA AUGUSTA", 2, "YY")], None),
        (("1", "10", "RUA AUGUSTA"), [("2", "10", "RUA AUGUSTA", 1), ("2", "10", "RUA AUGUSTA", 1)], None),
        (("1", "10", "RUA AUGUSTA"), [("1", "10", "RUA AUGUSTA", 1), ("2", "10", "RUA AUGUSTA", 2)], ("apt_cep_num_street", 1)),
        (("1", None, "RUA AUGUSTA"), [("1", None, "RUA AUGUSTA", 1)], None),
        (("1", "10", None), [("1", "10", "RUA AUGUSTA", 1)], None),
    ],
)
def test_cascade(spark, poi, points, want):
    pois = spark.createDataFrame([("id", *poi, "CITY", "JD SAO JOAO")], P)
    index = spark.createDataFrame([(c, n, s, "CITY", (rest or [""])[0], float(x), 0.0) for c, n, s, x, *rest in points], A)
    got = match.cascade(pois, index).collect()
    assert [(r.geo_precision, r.lat) for r in got] == ([want] if want else [])
    all_ = match.located(pois, match.cascade(pois, index)).first()
    assert all_.geo_precision == (want[0] if want else "none")


def test_fuzzy_layer_on_request(spark):
    pois = spark.createDataFrame([("a", "1", "5", "RUA AUGUSTA", "CITY", None), ("b", "1", "6", "RUA AUGUSTA", "CITY", "CENTRO")], P)
    index = spark.createDataFrame([("9", "5", "RUA AUGUSTO", "CITY", "ANY", 1.0, 1.0), ("9", "6", "RUA AUGUSTO", "CITY", "FAR", 2.0, 2.0)], A)
    assert match.cascade(pois, index).count() == 0
    assert [(r.cnpj, r.geo_precision) for r in match.cascade(pois, index, fuzzy=True).collect()] == [("a", "apt_fuzzy")]


def test_same_address(spark):
    pois = spark.createDataFrame([("a", "1", "5", "S", "C", None), ("b", "1", "5", "S", "C", None), ("c", "1", "6", "S", "C", None)], P)
    known = spark.createDataFrame([("a", 1.0, 2.0)], "cnpj string, lat double, lon double")
    assert [tuple(r) for r in match.propagate(pois, known).collect()] == [("b", 1.0, 2.0)]


def test_geocode(spark):
    pois = spark.createDataFrame([("a", "1", "m1"), ("b", "2", "m1"), ("c", "3", "m2"), ("d", "123456789", "m1"), ("e", None, "m1")], "cnpj string, cep string, municipio string")
    cache = spark.createDataFrame([("00000001", 0.0, 0.004), ("00000002", None, None), ("00000003", 9.0, 9.0)], "cep string, lat double, lon double")
    assert {r.cep for r in geocode.missing_keys(pois, cache).collect()} == {"00000000"}
    out = geocode.located(pois, cache)
    assert {r.cnpj: r.geo_precision for r in out.collect()} == {"a": "cep", "b": "none", "c": "cep", "d": "none", "e": "none"}
    centres = spark.createDataFrame([("m1", 0.0, 0.0)], "municipio string, lat_centro double, lon_centro double")
    flagged = geocode.flag_centres(out, centres)
    assert {r.cnpj: r.geo_precision for r in flagged.collect()}["a"] == "municipio_centroid"
    assert geocode.needs_fallback(flagged).count() == 4
    found = spark.createDataFrame([("a", 7.0, 8.0, "tomtom_street"), ("b", None, None, "none"), ("c", 1.0, 1.0, "tomtom_street")], "cnpj string, lat double, lon double, geo_precision string")
    got = {r.cnpj: (r.lat, r.geo_precision) for r in geocode.merge_fallback(flagged, found).collect()}
    assert (got["a"], got["b"], got["c"]) == ((7.0, "tomtom_street"), (None, "none"), (9.0, "cep"))
    partial = {r.cnpj: r.geo_precision for r in geocode.three_state(pois, cache).collect()}
    assert partial == {"a": "cep", "b": "none", "c": "cep", "d": "pending", "e": "pending"}


def test_centre_border_is_inside(spark):
    df = spark.createDataFrame([(0.0, 0.0, "m", "cep")], "lat double, lon double, municipio string, geo_precision string")
    far = spark.createDataFrame([("m", 0.0, 1.0)], "municipio string, lat_centro double, lon_centro double")
    d = 111194.92664455873
    assert geocode.flag_centres(df, far, metres=d + 1e-6).first().geo_precision == "municipio_centroid"
    assert geocode.flag_centres(df, far, metres=d - 1e-3).first().geo_precision == "cep"
    codes = spark.createDataFrame([(7107, "m")], "codigo_rf int, codigo_ibge string")
    assert geocode.crosswalk(far, codes).first().municipio == "7107"


def test_cache_update(spark):
    cache = spark.createDataFrame([("1", 1.0, 1.0), ("2", None, None)], "cep string, lat double, lon double")
    new = spark.createDataFrame([("2", 2.0, 2.0, "x"), ("3", None, None, "failed"), ("4", None, None, "none")], "cep string, lat double, lon double, geo_precision string")
    assert {r.cep: r.lat for r in geocode.update_cache(cache, new).collect()} == {"1": 1.0, "2": 2.0, "4": None}


@pytest.mark.parametrize(("n", "counts", "want"), [(300, (566069, 58130), (272, 28)), (4, (5, 5, 5), (2, 1, 1)), (10, (7, 4, 4), (4, 3, 3)), (3, (100, 1, 1, 1), (1, 1, 1, 1)), (5, (), ())])
def test_allocation(n, counts, want):
    assert tuple(validate.allocate({str(i): c for i, c in enumerate(counts)}, n).values()) == want


def test_sample_is_stable(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("cnpj"), F.when(F.col("id") < 60, "a").otherwise("b").alias("g"))
    pick = lambda seed, parts: sorted(r.cnpj for r in validate.sample(df.repartition(parts), {"a": 5, "b": 2}, "g", "cnpj", seed).collect())
    assert pick(1, 2) == pick(1, 5) != pick(2, 2) and len(pick(1, 2)) == 7


def test_statistics(spark):
    df = spark.createDataFrame([(float(i), "l1") for i in range(1, 11)] + [(None, "l1")], "distance_m double, g string")
    s = validate.distance_stats(df).first()
    assert (s.n, s["mean"], s.p50, s.p90, s.p95, s.p99, s["min"], s["max"]) == (10, 5.5, 6, 10, 10, 10, 1, 10) and s["std"] == pytest.approx(2.872281, abs=1e-6)
    both = {r.g: r.p50 for r in validate.distance_stats(df, by=["g"], total="ALL").collect()}
    assert both == {"l1": 6, "ALL": 6}
    flat = validate.distance_stats(spark.createDataFrame([(4.0,)] * 5, "distance_m double")).first()
    assert (flat.p50, flat.p99) == (4.0, 4.0)
    edges = spark.createDataFrame([(49.99,), (50.0,), (5000.0,)], "distance_m double")
    assert [r.n for r in validate.buckets(edges).orderBy("bucket").collect()] == [1, 1, 0, 0, 0, 1]
    empty = validate.outcome(spark.createDataFrame([], "distance_m double, tt_error string")).first()
    assert (empty.n, empty.match_rate) == (0, None)
    assert validate.distance_stats(edges.limit(0)).count() == 0


def test_before_and_after(spark):
    old = spark.createDataFrame([("a", "apt_fuzzy", 500.0, 0.0, 0.0), ("b", "apt_fuzzy", 10.0, 0.0, 0.0)], "cnpj string, old_precision string, old_distance_m double, ref_lat double, ref_lon double")
    new = spark.createDataFrame([("a", 0.0, 0.0, "apt_street_exact"), ("z", 0.0, 0.0, "apt_street_exact")], "cnpj string, lat double, lon double, geo_precision string")
    got = {r.cnpj: (r.new_distance_m, r.delta_m) for r in validate.compare(old, new).collect()}
    assert got == {"a": (0.0, -500.0), "b": (None, None)}
    assert [tuple(r) for r in validate.moves(validate.compare(old, new)).collect()] == [("apt_fuzzy", "apt_street_exact", 1), ("apt_fuzzy", "none", 1)]
    assert tuple(validate.gained_dropped(old, new).first()) == (1, 1)
