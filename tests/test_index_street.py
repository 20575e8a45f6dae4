"""The index side's streets against the rules spelt out in Python, and how often a text is gone through."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import fold, index_city, index_street
from tessera.functions.text import ABBREVIATIONS, PREPOSITIONS

BLANK = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f"


def folded(s):
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()


def street(s):
    s = folded(s).upper().strip(BLANK)
    for short, full in ABBREVIATIONS:
        s = re.sub(rf"\b{short}\b", full, s)
    s = re.sub(rf"\b(?:{PREPOSITIONS})\b", "", s)
    return re.sub(r"\s+", " ", s, flags=re.ASCII).strip(BLANK) or None


def test_against_python(spark):
    rng = random.Random(3)
    parts = ["«", "»", "«R»", "«»", "R", "av", "AVDA", "de", "dos", "É", "½", "Ⅷ", "漢字", "ﬁ", "ǆ", "ł", "ệ", "́", "№", "ｅ", "_", ".", "7", "x", "$1", "\\", "\x00", "\x1f", " ", " ", "\n", "😀", "𝐀"]
    texts = ["".join(rng.choice(["", "", " ", " \t "]) + rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(1500)] + [" " * 50_000 + "R" + " " * 50_000 + "É"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").repartition(4)
    got = df.select("i", fold(F.col("s")), index_street(F.col("s")), index_city(F.col("s"))).collect()
    for i, f, s, c in got:
        city = re.sub(r"\s+", " ", folded(texts[i]).upper().strip(BLANK), flags=re.ASCII) or None
        assert (f, s, c) == (folded(texts[i]), street(texts[i]), city), texts[i]


@pytest.mark.parametrize("normal", [index_street, index_city])
def test_a_text_is_folded_once(spark, normal):
    plan = spark.createDataFrame([("x",)], "s string").select(normal(F.col("s")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1
