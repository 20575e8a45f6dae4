"""Copies of an address or a text cost no comparisons."""

import pytest

from tessera.operators import match

P = "cnpj long, cep_norm string, num_norm string, street_norm string, city_norm string, bairro_norm string"
A = "cep_norm string, num_norm string, street_norm string, city_norm string, suburb_norm string, lat double, lon double"
N = 60


def compared(df) -> int:
    """The rows that Python got, of a result that was collected."""
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        got = node.metrics().get("pythonNumRowsReceived")
        total += got.get().value() if got.isDefined() else 0
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        else:
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.fixture(scope="module")
def sides(spark):
    """Copies of three rows and of four points, under postcodes that only one of the rows shares."""
    rows = [("1", "10", "RUA AUGUSTA", "C", "CENTRO"), ("2", "10", "RUA AUGUSTA", "C", None), ("3", "10", "RUA DO CARMO", "C", "CENTRO")]
    points = [("1", "10", "RUA AUGUSTO", "C", "CENTRA"), ("1", "10", "RUA AUGUSTINA", "C", "CENTRO"), ("9", "10", "RUA AUGUSTE", "C", ""), ("9", "10", "RUA DO CARMO", "C", "CENTRAL")]
    pois = spark.createDataFrame([(3 * i + j, *r) for i in range(N) for j, r in enumerate(rows)], P)
    index = spark.createDataFrame([(*a, float(i), float(j)) for i in range(N) for j, a in enumerate(points)], A)
    return pois, index


def rows_of(df):
    return sorted((r.cnpj, r.lat, r.lon, r.geo_precision) for r in df.collect())


def test_cascade(sides, monkeypatch):
    layers = []

    def saved(df, name):
        got = df.collect()
        layers.append((len(got), compared(df)))
        return df.sparkSession.createDataFrame(got, df.schema)

    monkeypatch.setattr(match, "saved", saved)
    got = rows_of(match.cascade(*sides, fuzzy=True))
    # The third row's copies have an equal street at many points, so the third layer leaves them.
    want = [(3 * i + j, 0.0, lon, label) for i in range(N) for j, (lon, label) in enumerate([(1.0, "apt_cep_num_street"), (1.0, "apt_fuzzy"), (3.0, "apt_fuzzy")])]
    assert got == want and [n for n, _ in layers] == [N, 0, 2 * N]
    assert sum(n for _, n in layers) <= 16


def test_fuzzy_layer(sides):
    df = match.layer4(*sides)
    assert rows_of(df) == [(3 * i + j, 0.0, lon, "apt_fuzzy") for i in range(N) for j, lon in enumerate([1.0, 1.0, 3.0])]
    assert 0 < compared(df) <= 24


def test_first_layer(sides):
    df = match.layer1(*sides)
    assert rows_of(df) == [(3 * i, 0.0, 1.0, "apt_cep_num_street") for i in range(N)]
    assert 0 < compared(df) <= 2


def test_same_address(sides):
    pois, index = sides
    df = match.propagate(pois.unionByName(pois.selectExpr("-cnpj - 1 as cnpj", *pois.columns[1:])), match.layer1(pois, index))
    assert sorted((r.cnpj, r.lat, r.lon) for r in df.collect()) == [(-3 * i - 1, 0.0, 1.0) for i in reversed(range(N))]
    assert 0 < compared(df) <= 4


def test_rows_that_share_an_id(spark):
    """A row for each id, the best of all its addresses; points are counted for each row."""
    pois = spark.createDataFrame([(1, "1", "10", "RUA AUGUSTA", "C", None), (1, "1", "11", "RUA AUGUSTA", "C", None), (2, "1", "12", "RUA B", "C", None), (2, "1", "12", "RUA B", "C", None)], P)
    index = spark.createDataFrame([("1", "10", "RUA AUGUSTO", "C", "", 1.0, 1.0), ("1", "11", "RUA AUGUSTA", "C", "", 2.0, 2.0), ("9", "12", "RUA B", "C", "", 3.0, 3.0)], A)
    assert rows_of(match.layer1(pois, index)) == [(1, 2.0, 2.0, "apt_cep_num_street")]
    assert rows_of(match.layer3(pois, index)) == [(1, 2.0, 2.0, "apt_street_exact")]
    assert rows_of(match.layer2(pois, index)) == []


def test_similar_pairs(spark):
    rows = [(i, "k", ["large ring", "large rink", "small bolt"][i % 3]) for i in range(3 * N)] + [(900, None, "large ring"), (901, "k", None), (902, "l", "large ring")]
    df = match.similar_pairs(spark.createDataFrame(rows, "id long, key string, name string"), "id", ["key"], "name", 0.8)
    got = {(r.a, r.b) for r in df.collect()}
    near = lambda i, j: (i % 3 == 2) == (j % 3 == 2)
    assert got == {(i, j) for i in range(3 * N) for j in range(i + 1, 3 * N) if near(i, j)}
    assert 0 < compared(df) <= 10
