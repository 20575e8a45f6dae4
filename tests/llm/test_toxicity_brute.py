"""Features, training and scores against a plain form of the same rules, one coordinate at a time."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_toxicity import rows

from tessera.llm.common import JOIN, STEP, TABLE, Powers
from tessera.llm.queries import op2_toxicity
from tessera.llm.toxicity import Settings, _features, fit, train

MASK = (1 << 64) - 1


def mix(h):
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & MASK
    h ^= h >> 33
    h = h * 0xC4CEB9FE1A85EC53 & MASK
    return h ^ h >> 33


def hashed(word):
    return mix(sum(int(TABLE[b]) * pow(int(STEP), i, 1 << 64) for i, b in enumerate(word)) & MASK)


def features(text, bits):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    h, shift = [hashed(w) for w in words], 64 - bits
    out = {x >> shift for x in h}
    out |= {mix(hashed(w[:n]) + n & MASK) >> shift for w in words for n in (4, 5)}
    out |= {mix(h[i] * int(JOIN) + h[i + gap] + gap & MASK) >> shift for gap in (1, 2) for i in range(len(h) - gap)}
    return out


def ftrl(examples, s):
    z, n, b = {}, {}, [0.0, 0.0]

    def weight(k):
        if abs(z.get(k, 0.0)) <= s.l1:
            return 0.0
        return -(z[k] - math.copysign(s.l1, z[k])) / ((s.beta + math.sqrt(n[k])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for at, y in examples:
            w = {k: weight(k) for k in at}
            bias = -b[0] / ((s.beta + math.sqrt(b[1])) / s.alpha)
            g = 1 / (1 + math.exp(-min(35, max(-35, bias + sum(w.values()))))) - y
            for k in at:
                before = n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / s.alpha * w[k]
                n[k] = before + g * g
            b = [b[0] + g - (math.sqrt(b[1] + g * g) - math.sqrt(b[1])) / s.alpha * bias, b[1] + g * g]
    return {k: w for k in z if (w := weight(k))}, -b[0] / ((s.beta + math.sqrt(b[1])) / s.alpha)


TEXTS = ["", None, "One", "one two", "É à Über 東京 ünïcödé 123 a-b_c", "x " * 50, " \n\t", "abcdefgh abcdef abcd abc"]


def test_features():
    got = list(_features(pa.array(TEXTS), 20, Powers()))
    assert [set(x.tolist()) for x in got] == [features(t, 20) for t in TEXTS]


@pytest.mark.parametrize("epochs", [1, 3])
def test_passes(epochs):
    s = Settings(bits=12, l1=0.5, epochs=epochs)
    data = [(features(t, s.bits), y) for _, t, y in rows(120, 5)]
    model = fit([(np.array(sorted(at), np.int32), y) for at, y in data], s)
    want, bias = ftrl(data, s)
    assert dict(zip(model.coordinate.tolist(), model.weight.tolist(), strict=True)) == pytest.approx(want, abs=1e-5) and len(want) > 5
    assert model.bias == pytest.approx(bias)


def test_query(spark, tmp_path):
    known = rows(300, 8) + [(500, None, 1), (501, "", 0), (502, "vilest " + "long words " * 4000, 1)]
    labels = [(i, y) for i, _, y in known if i % 3] + [(4, 1), (4, 0), (None, 1), (7, None), (8, 5)]
    docs = [(i, t, "en", "clash", 0.5) for i, t, _ in known] + [(4, "a repeated row", "en", "x", 0.1), (None, "no id", None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, held_out string, score double").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    label, text = {}, {}
    for i, y in labels:
        if i is not None and y in (0, 1) and not held(i):
            label[i] = max(y, label.get(i, 0))
    for i, t, *_ in docs:
        text[i] = min((x for x in (t, text.get(i, t)) if x is not None), default=None)
    order = [r.i for r in spark.createDataFrame([(i,) for i in label], "i long").orderBy(F.xxhash64("i"), "i").collect()]
    s = Settings()
    weights, bias = ftrl([(features(text[i], s.bits), label[i]) for i in order], s)
    got = op2_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(docs)
    want = {t: 1 / (1 + math.exp(-bias - sum(weights.get(k, 0.0) for k in features(t, s.bits)))) for _, t, *_ in docs}
    plain = {(i, round(want[t], 4)) for i, t, *_ in docs}
    assert {(r.doc_id, round(r.score, 4)) for r in got} == plain
    assert all(r.held_out == (r.doc_id is not None and held(r.doc_id)) and r.predicted == (r.score >= 0.3) for r in got)
    assert len(set(r.predicted for r in got)) == 2
    assert train(spark.createDataFrame(docs, "doc_id long, text string, lang string, held_out string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int"), settings=Settings(sample=10)).coordinate is not None
