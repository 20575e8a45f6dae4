"""What the match layers compare: no more pairs than can change a result, whatever the addresses share."""

import random

import duckdb
from test_copies import A, P, compared

from tessera import queries
from tessera.functions import jaro_winkler_score
from tessera.functions.similarity import scores
from tessera.operators import match


def test_fuzzy_layer_compares_streets_once(spark):
    """Streets are compared once for all their districts, and districts only with points that are better than one without."""
    pois = spark.createDataFrame([(100 * i + j, "1", "10", street, "C", f"DISTRICT {j}") for i, street in enumerate(["RUA AUGUSTA", "LARGO"]) for j in range(40)], P)
    near = [("9", "10", "RUA AUGUSTO", "C", f"DISTRICT {j}", 1.0, float(j)) for j in range(40)]
    far = [("9", "10", street, "C", f"DISTRICT {j}", 2.0, float(j)) for street in ("AVENIDA X", "TRAVESSA Y") for j in range(40)]
    index = spark.createDataFrame([*near, *far, ("9", "10", "RUA AUGUSTO", "C", "", 0.0, 0.0)], A)
    df = match.layer4(pois, index)
    assert sorted((r.cnpj, r.lat, r.lon) for r in df.collect()) == [(j, 0.0, 0.0) for j in range(40)]
    assert 0 < compared(df) <= 6 + 40


def test_fuzzy_layer_by_brute_force(spark):
    pick = random.Random(5)
    streets, districts = ["RUA AUGUSTA", "RUA AUGUSTO", "RUA AUGUSTINA", "LARGO DA SE", "LARGO DO SE", ""], ["CENTRO", "CENTRA", "MOOCA", "MOCA", "", None]
    rows = [(i, "1", pick.choice(["10", "11", None]), pick.choice([*streets, None]), pick.choice("CD"), pick.choice(districts)) for i in range(150)]
    points = [("1", pick.choice(["10", "11"]), pick.choice([*streets, None]), pick.choice("CD"), pick.choice([*districts, ""]), float(pick.randrange(9)), float(pick.randrange(9))) for _ in range(40)]
    want = []
    for i, _, number, street, city, district in rows:
        found = []
        for _, number_, street_, city_, suburb, lat, lon in points:
            if number != number_ or city != city_ or street is None or street_ is None:
                continue
            suburb = suburb or ""
            score = jaro_winkler_score(street, street_)
            if score >= 0.85 and (district is None or not suburb or jaro_winkler_score(district, suburb) >= 0.8):
                found.append((-score, lat, lon))
        want += [(i, *min(found)[1:])] if found else []
    got = match.layer4(spark.createDataFrame(rows, P), spark.createDataFrame(points, A)).collect()
    assert len(want) > 50 and sorted((r.cnpj, r.lat, r.lon) for r in got) == want


def test_first_layer_takes_equal_streets(spark):
    """A street that a point has isn't compared with others; empty ones are not equal."""
    pois = spark.createDataFrame([(i, "1", "10", street, "C", None) for i, street in enumerate(["RUA AUGUSTA", "RUA AUGUSTO", "RUA B", "", None] * 9)], P)
    index = spark.createDataFrame([("1", "10", street, "C", "", lat, 0.0) for lat, street in enumerate(["RUA AUGUSTA", "RUA AUGUSTAS", "RUA AUGUSTINA", "", "RUA AUGUSTA"], 1) for lat in [float(lat)]], A)
    df = match.layer1(pois, index)
    assert sorted((r.cnpj % 5, r.lat) for r in df.collect()) == [(0, 1.0)] * 9 + [(1, 1.0)] * 9
    assert 0 < compared(df) <= 3 * 4


def test_same_address_reads_written_matches(spark):
    """The first layer is computed once and written; nothing is compared when its rows are read again."""
    got = queries.QUERIES["same_address"](spark, "/root/testdata/sf0.001")
    rows = sorted((r.cnpj, r.lat, r.lon) for r in got.collect())
    con = duckdb.connect()
    con.sql("CREATE VIEW part AS SELECT * FROM '/root/testdata/sf0.001/part.parquet'")
    assert rows and rows == sorted(con.execute(queries.ORACLE_SQL["same_address"]).fetchall())
    assert compared(got) == 0


def test_scores_with_a_threshold():
    """A bound sets pairs to 0 only where they are below the threshold."""
    pick = random.Random(6)
    words = ["".join(pick.choice("ABCé ") for _ in range(pick.randrange(9))) for _ in range(80)]
    a, b = [pick.choice(words) for _ in range(3000)], [pick.choice(words) for _ in range(3000)]
    exact = scores(a, b)
    for least in (0.5, 0.7, 0.85, 1.0):
        got = scores(a, b, least)
        assert [x if x >= least else 0.0 for x in got] == [x if x >= least else 0.0 for x in exact]
        assert all(x in (0.0, y) for x, y in zip(got, exact, strict=True)) and got.count(0.0) > exact.count(0.0)
