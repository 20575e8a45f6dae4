import random

from tessera.llm.toxicity import Settings, score, train


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        toxic = rng.random() < 0.2
        w = [f"w{rng.randrange(2000)}" for _ in range(rng.randrange(20, 80))]
        if toxic:
            w[rng.randrange(len(w))] = f"vile{rng.choice(['st', 'ness', 'ly', 'r', str(rng.randrange(50))])}"
        out.append((i, " ".join(w), int(toxic)))
    return out


def test_held_out(spark):
    known, fresh = rows(1500, 1), rows(500, 2)
    docs = spark.createDataFrame(known, "doc_id long, text string, toxic int")
    model = train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    new = spark.createDataFrame(fresh, "doc_id long, text string, y int")
    got = new.withColumn("s", score(model, new)).collect()
    assert sum((r.s >= 0.3) == bool(r.y) for r in got) >= 0.97 * len(got)
    assert len(model.coordinate) < 3000  # sparse


def test_edges(spark, messy, none):
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (5, None), (None, 1), (10, 0), (11, 7)], "doc_id long, toxic int")
    model = train(messy, labels, settings=Settings(epochs=1))
    got = messy.withColumn("s", score(model, messy)).collect()
    assert len(got) == messy.count() and all(0 <= r.s <= 1 for r in got)
    blank = train(none, labels)
    assert not len(blank.coordinate)
    assert none.withColumn("s", score(blank, none)).count() == 0
    assert {round(r.s, 6) for r in messy.withColumn("s", score(train(messy, labels.where("toxic = 0")), messy)).collect()}.__len__() == 1
