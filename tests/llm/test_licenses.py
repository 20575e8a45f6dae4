import pytest

from tessera.llm.licenses import TEMPLATES, Scanner, Settings, scan

S = Scanner(TEMPLATES, Settings())


def found(text):
    return [(x["license"], text[x["start"] : x["end"]], x["differences"]) for x in S.scan(text)]


@pytest.mark.parametrize(("name", "text"), TEMPLATES)
def test_each_template_alone_and_in_prose(name, text):
    for before, after in (("", ""), ("Some prose here, and more of it.\n", "\nIt goes on for a while."), ("Ünï words " * 30, " and " + "more words " * 30)):
        got = found(before + text + after)
        assert name in {n for n, _, _ in got}, (before[:10], got)
        assert got[0][2] == []


def test_wording():
    assert found("Licensed under CC BY-SA 4.0.")[0][0] == "CC-BY-SA-4.0"
    assert [n for n, _, _ in found("Licensed under the Apache License, Version 2.0.\n\nReleased under the MIT License.")] == ["Apache-2.0", "MIT"]
    changed = TEMPLATES[2][1].replace("free of charge", "free of any charge")
    assert found(changed)[0][::2] == ("MIT", ["+any"])
    assert found("He renewed his driving license under the old rules and the new permission.") == []
    assert found("") == []


def test_rows(spark, messy, none):
    got = scan(messy).collect()
    assert len(got) == messy.count() and all(r.licenses == [] for r in got)
    assert scan(none).count() == 0
    with pytest.raises(ValueError, match="cue"):
        scan(none, templates=[("x", "no such word")])
