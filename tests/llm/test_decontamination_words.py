"""Repeated words, repeated benchmark rows, null ids and long texts, against brute force and the query's SQL."""

import random
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from test_decontamination import brute

from tessera.llm.decontamination import Index, contamination, find
from tessera.llm.queries import OP1_SQL, op1_decontamination


@pytest.fixture(scope="module")
def case():
    rng = random.Random(9)
    items = [(1, "a " * 40), (2, "a b " * 20), (3, "a " * 13 + "c"), (1, "a " * 40), (4, "a " * 5), (5, None), (6, "b a " * 7), (7, "A, a; a"), (None, "a a")]
    docs = [(i, " ".join(rng.choice("aaab") if rng.random() < 0.95 else "c" for _ in range(rng.randrange(80)))) for i in range(60)]
    docs += [(100, "a " * 300), (101, "x " * 20_000 + "a " * 13 + "c " + "y " * 20_000), (102, None), (103, ""), (104, "a b " * 200)]
    return docs, items


@pytest.mark.parametrize("block", [1 << 20, 30])
def test_repeated_words(spark, case, block):
    docs, items = case
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block).collect()
    want = brute([d for d in docs if d[0] != 101], [x for x in items if x[0] is not None])
    found = {r.doc_id: (r.contamination.n_words, r.contamination.n_hit, r.contamination["items"]) for r in got}
    assert found.pop(101) == (40_014, 14, [1, 3, 4, 7])
    assert found == want


def test_query_and_sql(spark, case, tmp_path):
    docs, items = case
    items, docs = [x for x in items if x[0] is not None], [d for d in docs if d[0] != 101]
    spark.createDataFrame([*docs, (None, "a a a"), (None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [r for r in op1_decontamination(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(OP1_SQL)
    names = [c[0] for c in want.description]
    assert {tuple(r[n] for n in names) for r in got if r.doc_id is not None} == {r for r in want.fetchall() if r[0] is not None}
    assert sorted((r.n_words, r.n_hit, r.contaminated) for r in got if r.doc_id is None) == [(0, 0, False), (3, 3, True)]


def test_time_grows_with_the_words():
    took = []
    for m in (2000, 20_000):
        index = Index([(1, "spam " * m)], 13, 5, 1.0)
        assert len(index.size) == 1
        index.order({n: np.ones(len(k), int) for n, k in index.keys.items()})
        began = time.perf_counter()
        got = find(index, pa.array(["spam " * 5 * m]))[0].as_py()
        took.append(time.perf_counter() - began)
        assert got["n_hit"] == got["n_words"] == 5 * m and got["items"] == [1]
    assert took[1] < 60 * max(took[0], 0.01)
