import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.functions import cep_key, cep_key_strict, compose_id, fold, haversine_m, index_city, index_number, index_street, jaro_winkler, jaro_winkler_score, poi_district, poi_number, poi_street, suburb_clean


def values(spark, f, *columns):
    """f over the rows of the columns' values, in order."""
    rows = [(i, *r) for i, r in enumerate(zip(*columns, strict=True))]
    names = [f"c{i}" for i in range(len(columns))]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} string" for n in names))
    return [r.x for r in df.select("i", f(*map(F.col, names)).alias("x")).orderBy("i").collect()]


def test_streets(spark):
    kinds = ["AV", "RUA", "RUA", "RUA", None, "LG", "KM", " tv "]
    names = ["DR JOSE E MARIA", "DE DA CRUZ", "JD PRIMAVERA", "SÃO JOÃO", "AUGUSTA", "DO E", "9 E  DA Z", "x  y"]
    assert values(spark, poi_street, kinds, names) == ["AVENIDA DR JOSE MARIA", "RUA DA CRUZ", "RUA JD PRIMAVERA", "RUA SÃO JOÃO", None, "LARGO E", "KM 9 DA Z", "TRAVESSA X Y"]
    index = ["AV DR JOSE E MARIA", "RUA DE DA CRUZ", "RUA JD PRIMAVERA", "RUA SÃO JOÃO", "AUGUSTA", "LARGO DO E", "KM 9 E  DA Z", "r. augusta", "", None, " de ", "Cond. Vl Ál"]
    want = ["AVENIDA DR JOSE MARIA", "RUA CRUZ", "RUA JARDIM PRIMAVERA", "RUA SAO JOAO", "AUGUSTA", "LARGO", "KM 9 Z", "RUA. AUGUSTA", None, None, None, "CONDOMINIO. VILA ALAMEDA"]
    assert values(spark, index_street, index) == want


def test_fold(spark):
    import unicodedata

    texts = ["".join(map(chr, range(0x80, 0x250))), "Nº 1ª ½", "… ™ ¼ ¾", "Ø ß œ Ł ÷ “ –", "plain", None]
    assert values(spark, fold, texts) == [t and unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert values(spark, index_city, ["  São   Paulo ", "ß", None]) == ["SAO PAULO", None, None]


def test_numbers_and_keys(spark):
    n = ["123A", " 12 ", "00", "S/N", "SN", "0", "SEM NUMERO", "KM 5", None, ""]
    assert values(spark, poi_number, n) == ["123", "12", "00", None, None, None, "", "", None, None]
    assert values(spark, index_number, n) == ["123", "12", "00", None, None, None, None, None, None, None]
    c = ["01310-100", "123", "123456789", None, "x"]
    assert values(spark, cep_key_strict, c) == ["01310100", "00000123", None, "00000000", "00000000"]
    assert values(spark, cep_key, c) == ["01310100", "00000123", "12345678", None, "00000000"]
    assert values(spark, compose_id, ["123", None], ["1", "1"], ["7", "1"]) == ["00000123000107", None]


def test_districts(spark):
    assert values(spark, poi_district, ["CENTRO (ZONA NORTE) SUL", "jd de sao  joao", None]) == ["CENTROSUL", "JD SAO JOAO", None]
    assert values(spark, suburb_clean, ["CENTRO (ZONA NORTE) SUL", None, "A  B"]) == ["CENTROSUL", "", "A B"]


PAIRS = [
    ("MARTHA", "MARHTA", 0.961111), ("DIXON", "DICKSONX", 0.813333), ("RUA AUGUSTA", "RUA AUGUSTO", 0.963636), ("RUA SAO JOAO", "RUA SAO JOSE", 0.933333),
    ("JD SAO JOAO", "JARDIM SAO JOAO", 0.810909), ("AÇÃO", "ACAO", 0.611111), ("ABCD", "ABXX", 0.666667), ("", "", 0), ("", "A", 0), ("SAME", "SAME", 1),
]


def test_jaro_winkler(spark):
    for a, b, want in PAIRS:
        assert jaro_winkler_score(a, b) == pytest.approx(want, abs=1e-6)
    rng = random.Random(5)
    words = ["".join(rng.choice("ABÇ Ã") for _ in range(rng.randrange(0, 14))) for _ in range(400)]
    pairs = [(rng.choice(words), rng.choice(words)) for _ in range(3000)] + [(a, b) for a, b, _ in PAIRS]
    got = [jaro_winkler_score(a, b) for a, b in pairs]
    con = duckdb.connect()
    con.execute("CREATE TABLE p(i INT, a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(i, *p) for i, p in enumerate(pairs)])
    want = [x for (x,) in con.execute("SELECT jaro_winkler_similarity(a, b) FROM p ORDER BY i").fetchall()]
    assert max(abs(x - y) for x, y in zip(got, want, strict=True)) < 1e-12
    a, b = [p[0] for p in pairs] + [None, "x"], [p[1] for p in pairs] + ["x", None]
    assert values(spark, jaro_winkler, a, b) == [*got, None, None]
    kept = values(spark, lambda x, y: jaro_winkler(x, y, 0.8), a, b)
    assert all((k or 0) == g or (g < 0.8 and k == 0) for k, g in zip(kept, got, strict=False))


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (5.0, 5.0, 5.0, 5.0), (0.0, 0.0, 0.0, 180.0), (None, 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    got = [r.x for r in df.select(haversine_m(*map(F.col, "abcd")).alias("x")).collect()]
    assert got[0] == pytest.approx(111194.926645, abs=1e-5) and got[1] == 0 and got[2] == pytest.approx(20015086.796, abs=1e-2) and got[3] is None
