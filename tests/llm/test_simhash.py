import random
import re

import numpy as np
import xxhash

from tessera.llm.simhash import _joined, classes, components, fingerprint, keep_one, links, stars


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(prints, radius):
    ids = list(range(len(prints)))
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius and ids[i] != ids[j]:
                a, b = max(ids[i], ids[j]), min(ids[i], ids[j])
                ids = [b if x == a else x for x in ids]
    return ids


def near(rng, n):
    """Random fingerprints, groups around some of them, and a chain of small steps."""
    out = [rng.getrandbits(64) for _ in range(n)]
    for x in out[:20]:
        out += [x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(5)]
    x = rng.getrandbits(64)
    for _ in range(30):
        out.append(x)
        for b in rng.sample(range(64), 4):
            x ^= 1 << b
    rng.shuffle(out)
    return list(dict.fromkeys(out))


def test_fingerprints(messy_rows):
    for _, text, *_ in messy_rows:
        assert fingerprint((text or "").encode(), 4) == brute_fingerprint(text)
    assert fingerprint("a  B\x0bc\x85d e".encode(), 4) == brute_fingerprint("a  B\x0bc\x85d e")


def test_stars():
    prints = near(random.Random(1), 700)
    for radius in (0, 4, 9):
        for own in (True, False):
            x = np.array(prints, np.uint64)
            u, v = stars(x, None, radius, 16) if own else stars(x[:300], x[300:], radius, 16)
            label = {p: p for p in prints}
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                a, b = label[a], label[b]
                label = {k: (a if c == b else c) for k, c in label.items()}
            if own:
                want = brute_classes(prints, radius)
                assert len(set(want)) == len(set(label.values()))
                assert len({(w, label[p]) for w, p in zip(want, prints, strict=True)}) == len(set(want))


def test_links_across_tiles(spark):
    prints = near(random.Random(2), 300)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = links(spark.createDataFrame(signed, "fp long"), 4, tile=16)
    root = {r.v: r.root for r in components(edges).collect()}
    got = [root.get(s, s) for (s,) in signed]
    want = brute_classes(prints, 4)
    assert len({*zip(got, want, strict=True)}) == len({*got}) == len({*want})


def test_classes(spark, messy, messy_rows, none):
    got = classes(messy).collect()
    assert len(got) == len(messy_rows)
    prints = {r[1]: brute_fingerprint(r[1]) for r in messy_rows}
    distinct = sorted(set(prints.values()))
    group = dict(zip(distinct, brute_classes(distinct, 4), strict=True))
    least = {}
    for i, t, *_ in messy_rows:
        g = group[prints[t]]
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(((-1 if i is None else i), least.get(group[prints[t]])) for i, t, *_ in messy_rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.component_id) for r in got) == want
    kept = keep_one(messy, classes(messy)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(set(least.values()))
    assert kept[0].asDict().keys() == set(messy.columns)
    assert classes(none).count() == 0


def test_hot_fingerprints(spark):
    rows = [(i, "one two three four five" if i % 3 else f"a{i} b{i} c{i} d{i} e{i}") for i in range(300)] + [(None, "one two three four five"), (None, None)]
    got = classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    want = classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 302
    named = spark.createDataFrame([(1, 200, 7), (2, 1, 8), (3, 99, None)], "fp long, n long, component_id long")
    copies = spark.createDataFrame([(i, 1) for i in range(200)] + [(300, 2)] + [(400 + i, 3) for i in range(99)], "doc_id long, fp long")
    for share in (1, 2, 5, 1000):
        out = _joined(copies, named, share).collect()
        assert sorted((r.doc_id, r.component_id) for r in out) == sorted((r.doc_id, {1: 7, 2: 8, 3: None}[r.fp]) for r in copies.collect())
