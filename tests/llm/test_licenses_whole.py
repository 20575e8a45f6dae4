"""Notices next to one another, repeated, and within long lines."""

import random

import numpy as np
import pytest

from tessera.llm.licenses import _CUE, _WORD, TEMPLATES, Scanner, Settings, scan

S = Scanner(TEMPLATES, Settings())


def found(text):
    return [(x["license"], text[x["start"] : x["end"]], x["differences"]) for x in S.scan(text)]


@pytest.mark.parametrize(
    ("names", "line"),
    [
        (["MIT", "GPL-3.0"], "Released under the MIT License. This work is licensed under the GNU General Public License, version 3."),
        (["Apache-2.0", "CC-BY-4.0"], "Licensed under the Apache License, Version 2.0. Licensed under CC BY 4.0."),
        (["MIT", "MIT", "MIT"], "Released under the MIT License. Released under the MIT License. And: released under the MIT license!"),
        ([n for n, _ in TEMPLATES], " ".join(t for _, t in TEMPLATES)),
        ([n for n, _ in TEMPLATES] * 3, " ".join(t for _, t in TEMPLATES * 3)),
    ],
)
def test_several_notices_in_a_line(names, line):
    assert [(n, d) for n, _, d in found(line)] == [(n, []) for n in names]


@pytest.mark.parametrize(("name", "template"), TEMPLATES)
def test_every_notice_of_a_long_line(name, template):
    rng = random.Random(template)
    prose = lambda n: " ".join("".join(rng.choice("aeinorst") for _ in range(rng.randrange(2, 10))) for _ in range(n))
    line = " ".join(f"{prose(rng.randrange(1, 600))} {template}" for _ in range(12)) + " " + prose(300)
    assert [(n, d) for n, _, d in found(line)] == [(name, [])] * 12
    assert [n for n, _, _ in found("İstanbul " + line)] == [name] * 12


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(row[-1], before[j + 1]))
    return row[-1]


def test_against_all_stretches_of_words():
    """Edited notices in random order: what is found are the best of all stretches of words that pass."""
    rng, s = random.Random(8), S.s
    short = [i for i, (_, _, w) in enumerate(S.templates) if len(w) <= 22]
    n_differing = 0
    for _ in range(25):
        words = []
        for i in rng.choices(short, k=3):
            w = list(S.templates[i][2])
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice([[], ["other"], [rng.choice(w)]])
            words += w + ["prose"] * rng.randrange(3)
        line = " ".join(words)
        tokens = [(t[0], t.start(), t.end()) for t in _WORD.finditer(line)]
        every = []
        for i, (_, _, w) in enumerate(S.templates):
            most = max(1, round((1 - s.coverage) * 2 * len(w)))
            for a in range(len(tokens)):
                for b in range(a + 1, min(len(tokens), a + len(w) + most) + 1):
                    if tokens[a][0] not in w or tokens[b - 1][0] not in w or sum(t[0] in w for t in tokens[a:b]) / len(w) < s.coverage:
                        continue
                    m = common(w, [t[0] for t in tokens[a:b]])
                    if m / len(w) >= s.coverage and len(w) + b - a - 2 * m <= most:
                        every.append((len(w) + b - a - 2 * m, tokens[a][1] - tokens[b - 1][2], tokens[a][1], tokens[b - 1][2]))
        want = []
        for d, _, a, b in sorted(every):
            if _CUE.search(line) and all(b <= x[0] or x[1] <= a for x in want):
                want.append((a, b, d))
        got = S.scan(line)
        assert [(x["start"], x["end"], len(x["differences"])) for x in got] == sorted(want), line
        n_differing += sum(d for _, _, d in want)
    assert n_differing


def test_winners_have_the_places():
    """The places of the blocks' winners are those of all templates everywhere."""
    rng = random.Random(9)
    for _ in range(40):
        words = ["prose"] * rng.randrange(60)
        for i in rng.choices(range(len(S.templates)), k=4):
            w = list(S.templates[i][2])
            for _ in range(rng.randrange(1 + len(w) // 10)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice([[], ["other"], [rng.choice(w)]])
            words += w + ["".join(rng.choice("aeinorst") for _ in range(6)) for _ in range(rng.randrange(90))]
        ids = np.array([S.numbers.get(w, 0) for w in words])
        every = {(d, a, b, i) for i in range(len(S.templates)) for d, a, b in S.places(ids, i)}
        assert S.found(words, ids) == every and every
        won = {i: [(a, b) for a, b, j in S.winners(words, ids) if j == i] for *_, i in every}
        assert all(any(a <= s and e <= b for a, b in won[i]) for _, s, e, i in every)


def test_rows_with_notices(spark):
    mit, cc = "Released under the MIT License.", "Licensed under CC BY 4.0."
    rows = [(1, f"x {mit} {cc}", "clash"), (1, f"x {mit} {cc}", "clash"), (2, None, None), (3, "", "a"), (None, cc, None), (4, f"é\n\n{mit}\n\n{mit}" + " prose" * 20_000, "b"), (5, f"{mit}" * 3, "c")]
    got = scan(spark.createDataFrame(rows, "doc_id long, text string, licenses string").repartition(3)).collect()
    names = sorted((r.doc_id or 0, [x.license for x in r.licenses]) for r in got)
    assert names == [(0, ["CC-BY-4.0"]), (1, ["MIT", "CC-BY-4.0"]), (1, ["MIT", "CC-BY-4.0"]), (2, []), (3, []), (4, ["MIT", "MIT"]), (5, ["MIT"] * 3)]
    text = {r[0]: r[1] for r in rows}
    assert all(text[r.doc_id][x.start : x.end].startswith(("Released", "Licensed")) and x.reduction > 0.2 for r in got for x in r.licenses)
    twice = scan(spark.createDataFrame(rows, "doc_id long, text string, licenses string"), templates=[("A", mit), ("B", mit)])  # a tie goes to the first
    assert {x.license for r in twice.collect() for x in r.licenses} == {"A"}
