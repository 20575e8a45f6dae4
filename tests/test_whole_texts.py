"""The normalisers of the queries over whole documents, against Python."""

import re
import unicodedata

import pytest

from tessera import queries
from tessera.functions import text as tables

SENTENCE = "Rua. São João DA the Cruz e  Silva\r\nAv Drª Zoë, jd. Ipê"
TEXTS = ["one. Two", ". ..", "", None, SENTENCE, " ".join([SENTENCE] * 400) + ". End the R"]


def ascii_of(s):
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()


def poi(i, s):
    kinds = ["RUA", "AVENIDA", "TRAVESSA", "ALAMEDA", "PRACA", "ESTRADA", "RODOVIA", "LARGO", "KM"]
    if s is None or i % 10 == 9:
        return None
    out = f"{kinds[i % 10]} {s.replace(' the ', ' da ').strip(' ').upper()}"
    return re.sub(r"\s+", " ", re.sub(r"\s+(DE|DA|DO|DAS|DOS|E)\s+", " ", out))


def index(i, s):
    if s is None:
        return None
    out = ascii_of(f"Av. {queries.ODD}{s} do Jd").upper().strip()
    for short, full in tables.ABBREVIATIONS:
        out = re.sub(rf"\b{short}\b", full, out)
    return re.sub(r"\s+", " ", re.sub(r"\b(DE|DA|DO|DAS|DOS|E)\b", "", out)).strip() or None


def city(i, s):
    return None if s is None else re.sub(r"\s+", " ", ascii_of(queries.ODD + s).upper().strip()) or None


@pytest.mark.parametrize(("name", "brute"), [("norm_street_poi", poi), ("norm_street_index", index), ("norm_city", city)])
def test_whole_documents(spark, tmp_path, name, brute):
    rows = list(enumerate(TEXTS * 2))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: r[1] for r in queries.QUERIES[name](spark, str(tmp_path)).collect()}
    assert got == {i: brute(i, None if s is None else re.sub(r"[\r\n]+", " ", s)) for i, s in rows}
    assert got[5].endswith("END R" if brute is poi else "END THE RUA JARDIM" if brute is index else "END THE R")
