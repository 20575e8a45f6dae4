"""The stages one after another, each against brute force on what the one before kept."""

import random
import zlib

import numpy as np
import pytest
from test_decontamination import brute as contaminated
from test_mixing import targets
from test_simhash import brute_classes, brute_fingerprint

import corpus_pipeline
from tessera.llm.queries import tokenizer


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    items = [(i, " ".join(f"q{rng.randrange(200)}" for _ in range(30))) for i in range(5)]
    rows = []
    for i in range(240):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(30, 90))]
        if i % 6 == 1:
            w[3] = w[9] = "vile"
        if i % 25 == 2:
            w += items[i % 5][1].split()
        rows.append((i, " ".join(w), "en", f"s{i % 4}" if i % 9 else None))
    rows += [(300 + i, rows[i * 10][1], "en", "s0") for i in range(20)] + [(400, None, "en", "s1"), (401, "", "en", None)]
    out = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame([(r[0], 1, int("vile" in (r[1] or ""))) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out, {r[0]: r for r in rows}, items


def test_stages(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept, kind = docs.columns, [], dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), docs.schema)
        assert docs.columns == columns
        kept.append(sorted(r.doc_id for r in docs.collect()))
    assert list(kind) == ["toxicity", "simhash", "decontamination", "mixing", "token_files"]
    assert kept[0] == sorted(i for i, r in rows.items() if "vile" not in (r[1] or ""))
    prints = [brute_fingerprint(rows[i][1]) for i in kept[0]]
    group = {}
    for i, c in zip(kept[0], brute_classes(prints, 4), strict=True):
        group.setdefault(c, i)
    assert kept[1] == sorted(group.values())
    hit = contaminated([(i, rows[i][1]) for i in kept[1]], items)
    assert kept[2] == [i for i in kept[1] if not (hit[i][1] and 20 * hit[i][1] >= hit[i][0])] and kept[2] != kept[1]
    sizes = {}
    for i in kept[2]:
        sizes[rows[i][3]] = sizes.get(rows[i][3], 0) + len((rows[i][1] or "").split())
    for source, t in targets(sizes).items():
        got = sum(len(rows[i][1].split()) for i in kept[3] if rows[i][3] == source)
        assert abs(got - t) <= 2 * max(len((rows[i][1] or "").split()) for i in kept[2])
    assert set(kept[3]) <= set(kept[2]) and max(map(kept[3].count, kept[3])) <= 3


def test_run(spark, folder):
    from tokenizers import Tokenizer

    path, rows, _ = folder
    got = corpus_pipeline.run(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(tokenizer())
    at = 0
    for r in got:
        ids = library.encode(rows[r.doc_id][1] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)
