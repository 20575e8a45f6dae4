import hashlib
import re

from pyspark.sql import functions as F

from tessera.llm.queries import op3_fingerprints
from tessera.llm.sketches import containment, distinct_shingles, merged, resemblance, with_sketch


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def near(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query(spark, messy_rows, tmp_path):
    rows = {r[0]: r for r in messy_rows if r[0] is not None}
    spark.createDataFrame(list(rows.values()), "doc_id long, text string, lang string, source string, n_chars long, spans string, n_hit int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op3_fingerprints(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    ids = sorted(rows, reverse=True)
    for i, nxt in zip(ids, ids[1:] + ids[:1], strict=True):
        text, other = rows[i][1] or "", rows[nxt][1] or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + other[:m]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for value, x, y in ((r.near_edited, text, edited), (r.near_next, text, other)):
            a, b = shingles(x), shingles(y)
            assert abs(value - near(a, b)) < (1e-9 if len(a | b) <= 128 else 0.2)
        assert (r.fingerprint == r.edited_fingerprint) == (shingles(text) == shingles(edited)) or len(shingles(text)) > 128


def test_estimates_and_merging(spark):
    texts = [(0, " ".join(f"a{i}" for i in range(3000))), (0, " ".join(f"a{i}" for i in range(1500, 4500))), (1, ""), (1, "x y"), (2, None)]
    df = with_sketch(spark.createDataFrame(texts, "g int, text string"), F.col("text"), "s")
    both = {r.g: r for r in merged(df, ["g"], "s").withColumn("n", distinct_shingles(F.col("s"))).collect()}
    assert abs(both[0].n - 4492) < 1200 and both[1].n == 1 and both[2].s == []
    pair = df.where("g = 0 and text like 'a0 %'").select(F.col("s").alias("x")).crossJoin(df.where("g = 0 and text like 'a1500 %'").select(F.col("s").alias("y")))
    r = pair.select(resemblance(F.col("x"), F.col("y")).alias("j"), containment(F.col("x"), F.col("y")).alias("c")).first()
    assert abs(r.j - 1 / 3) < 0.15 and abs(r.c - 0.5) < 0.2


def test_empty(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert op3_fingerprints(spark, str(tmp_path)).count() == 0


def test_messy(spark, messy, tmp_path):
    messy.write.parquet(f"{tmp_path}/documents.parquet")
    assert op3_fingerprints(spark, str(tmp_path)).count() == messy.count()
