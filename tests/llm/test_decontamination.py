import math
import random
import re

import pytest

from tessera.llm.decontamination import contamination, is_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13, k=5, share=1.0):
    out = {}
    for doc, text in docs:
        d, hit, found = split(text), set(), set()
        for item, t in items:
            w = split(t)
            for s in range(max(1, len(w) - window + 1) if w else 0):
                part = w[s : s + window]
                n = min(k, len(part))
                need = {tuple(part[i : i + n]) for i in range(len(part) - n + 1)}
                for p in range(len(d) - len(part) + 1):
                    here = d[p : p + len(part)]
                    got = {tuple(here[i : i + n]) for i in range(len(part) - n + 1)}
                    if here == part if share >= 1 else len(need & got) >= math.ceil(share * len(need) - 1e-9):
                        hit.update(range(p, p + len(part)))
                        found.add(item)
        out[doc] = (len(d), len(hit), sorted(found))
    return out


@pytest.fixture(scope="module")
def case(spark, messy_rows):
    rng = random.Random(3)
    items = [(i, " ".join(f"b{rng.randrange(90)}" for _ in range(rng.randrange(1, 40)))) for i in range(25)]
    items += [(25, "one"), (26, None), (27, ""), (28, "東京 ÜNÏ"), (25, "Two, words!"), (30, items[3][1])]
    docs = [(r[0], r[1]) for r in messy_rows if r[0] is not None and len(r[1] or "") < 10_000]
    for i in range(100, 160):
        w = split(items[rng.randrange(25)][1])
        a = rng.randrange(len(w))
        w = w[a : a + rng.randrange(1, 40)]
        if i % 3 == 0:
            w[rng.randrange(len(w))] = "other"
        docs.append((i, " ".join([f"x{rng.randrange(9)}" for _ in range(rng.randrange(30))] + w + ["END"])))
    return docs, items


@pytest.mark.parametrize(("share", "block"), [(1.0, 1 << 20), (0.7, 1 << 20), (1.0, 600)])
def test_against_brute_force(spark, case, share, block):
    docs, items = case
    frame = spark.createDataFrame(docs, "doc_id long, text string").dropDuplicates(["doc_id"])
    got = contamination(frame, spark.createDataFrame(items, "item_id long, text string"), containment=share, block_bytes=block).collect()
    want = brute(dict(docs).items(), items, share=share)
    assert {r.doc_id: (r.contamination.n_words, r.contamination.n_hit, r.contamination.items) for r in got} == want
    assert any(n for _, n, _ in want.values())
    assert all(sum(b - a for a, b in r.contamination.runs) == r.contamination.n_hit for r in got)


def test_edges(spark, messy, none):
    items = spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")
    assert contamination(messy, items).count() == messy.count()
    empty = contamination(messy, items.limit(0))
    assert not empty.where(is_contaminated()).count() and set(messy.columns) < set(empty.columns)
    assert contamination(none, items).count() == 0
