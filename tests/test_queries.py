"""Every query of the engine against its SQL, over the smallest tables."""

import math
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tessera import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    return repr(round(float(x), 5) + 0.0) if isinstance(x, (float, int)) or hasattr(x, "as_tuple") else str(x)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, str(DATA))
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    assert got == sorted(tuple(map(plain, r)) for r in want.fetchall())


ALONE = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as e
from tessera import queries
assert set(e.queries()) == set(queries.QUERIES) and e.oracle_sql() == queries.ORACLE_SQL and not e.HAS_LLM
import tessera.plans.accuracy, tessera.plans.export, tessera.plans.matching, tessera.plans.pipeline, tessera.streaming, tessera.scratch
assert not any(m.startswith("tessera.llm") for m in sys.modules)
"""


@pytest.mark.parametrize("left", ["nothing", "empty folders"])
def test_the_entry_without_the_text_operators(tmp_path, left):
    """As they are left once the text operators, their tests and the pipeline are deleted."""
    root = Path(__file__).resolve().parent.parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", "*.txt"))
    for folder in (copy / "tessera" / "llm", copy / "tests" / "llm"):
        shutil.rmtree(folder, ignore_errors=True)
        if left == "empty folders":
            folder.mkdir()
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    subprocess.run([sys.executable, "-c", ALONE.format(root=str(copy))], check=True, cwd=tmp_path)
    collected = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], check=True, cwd=copy, capture_output=True, text=True).stdout
    assert "test_queries.py" in collected and "error" not in collected.lower()
