"""The added spans against brute force over whole texts, long ones with many matches included."""

import random
import re
import string
import time

from pyspark.sql import functions as F
from test_secrets import brute

from tessera.llm.secrets import KEY, default_model, scan, written

CHARS = string.ascii_letters + string.digits
PROSE = "the configuration of the internationalization component and its documentation remain straightforward for administrators "


def expected(text, ratios, threshold=12.0):
    base, _ = brute(text)
    out = [(s, k, e) for s, k, e in base]
    for m in re.finditer(KEY, text or ""):
        codes = [ord(c) for c in m[0]]
        if not any(s < m.end() and m.start() < e for s, _, e in base) and sum(ratios[a * 128 + b] for a, b in zip(codes, codes[1:], strict=False)) >= threshold:
            out.append((m.start(), 3, m.end()))
    return ",".join(f"{('assign', 'access', 'hex', 'random')[k]}:{s}:{e}" for s, k, e in sorted(out))


def made(rng, n):
    out = []
    for _ in range(n):
        kind = rng.randrange(6)
        if kind == 0:
            out.append("".join(rng.choices(CHARS, k=rng.randrange(12, 40))))
        elif kind == 1:
            out.append("".join(rng.choices("0123456789abcdef", k=rng.randrange(12, 40))))
        elif kind == 2:
            out.append(f"{rng.choice(['token', 'API_KEY', 'secret'])}{rng.choice([' = ', ':', '='])}{''.join(rng.choices(CHARS, k=rng.randrange(8, 30)))}")
        elif kind == 3:
            out.append("AKIA" + "".join(rng.choices(string.ascii_uppercase + string.digits, k=rng.randrange(10, 20))))
        else:
            out.append(rng.choice(["é à", PROSE, "internationalization_component", "x", "2024-01-01-12-30-45", ""]))
    return rng.choice([" ", "\n", ", "]).join(out)


def test_against_brute_force(spark):
    rng = random.Random(12)
    docs = [(i, made(rng, rng.randrange(30))) for i in range(150)] + [(200, made(rng, 3000)), (201, None), (202, ""), (203, made(rng, 5)), (203, made(rng, 5)), (None, made(rng, 9))]
    df = spark.createDataFrame([(*d, "clash", 5) for d in docs], "doc_id long, text string, __base string, spans int").repartition(3)
    model = default_model(df)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.w, r["__base"]) for r in scan(df, model).select("doc_id", written(F.col("spans")).alias("w"), F.col("__base")).collect())
    want = sorted((-1 if i is None else i, expected(t, model), "clash") for i, t in docs)
    assert got == want and sum("random" in w for _, w, _ in want) > 50


def test_long_texts(spark):
    rng = random.Random(13)
    key = "".join(rng.choices(CHARS, k=1_000_000))
    hexes = " ".join("".join(rng.choices("0123456789abcdef", k=16)) for _ in range(60_000))
    df = spark.createDataFrame([(1, key), (2, hexes), (3, "a" * 15 + "z" * 1_000_000)], "doc_id long, text string")
    ratios = [0.001] * (128 * 128)
    began = time.perf_counter()
    got = {r.doc_id: r.spans for r in scan(df, ratios).collect()}
    assert time.perf_counter() - began < 60
    assert [(x.start, x.end, x.kind) for x in got[1]] == [(0, 1_000_000, 3)]
    assert [(x.start, x.end, x.kind) for x in got[2]] == [(17 * i, 17 * i + 16, 2) for i in range(60_000)]
