import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, n_hit int"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls, empty and very long texts, ties, repeated rows, near and exact copies, shared passages."""
    rng = random.Random(7)
    shared = " ".join(words(rng, 60))
    rows = [(0, None, "en", "a"), (1, "", "en", "a"), (2, "   \n\t ", "en", None), (3, "one", "en", "b"), (4, "Two words", "de", "b"), (5, "É à la Über 東京 ünïcödé 123", "fr", "c")]
    for i in range(6, 60):
        text = " ".join(words(rng, rng.randrange(5, 120)))
        rows.append((i, text if i % 7 else f"{text}\n{shared}. {text[: 20]}", "en", "abc"[i % 3] if i % 11 else None))
    rows += [(60, rows[10][1], "en", "a"), (61, rows[10][1], "en", "b"), (62, rows[11][1] + " extra", "en", "a"), (63, shared, "en", "a"), (64, " ".join(words(rng, 30_000)), "en", "b")]
    rows += [rows[12], rows[12], (65, None, None, None), (66, "x" * 5000, "en", "c"), (None, rows[13][1], "en", "a"), (None, None, "en", "a")]
    return [(i, t, lang, s, len(t or ""), "clash", 9) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
