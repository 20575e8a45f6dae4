"""License scans by conditional compression.

The paragraphs of a text that have a cue are candidates. Their words, in lower case and with
one space between, are cut into overlapping blocks of several lengths, so that every place
that can hold a template lies whole in some block hardly longer than itself. Each block is
compressed alone and with each template, of which it has enough words, as a raw dictionary of
zstandard; templates are ranked by how much smaller they make it, and all that make it smaller
by a twentieth or more are winners, however many. A winner is confirmed by its exact wording:
the words of template and block are aligned, and each stretch is a place if all but a small
share of the template's words stand there in order. Repeats are found one by one, and the
differing words are returned.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Identifiers and public wordings of licenses.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]
#: Every template has one of these, in lower case; so must a candidate.
CUES = ("licens", "licenc", "permission", "redistribut", "public domain", "copyright")

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("license", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("reduction", T.DoubleType()),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("differences", T.ArrayType(T.StringType())),
        ]
    )
)
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
_CUE = re.compile("|".join(map(re.escape, CUES)))


@dataclass(frozen=True)
class Settings:
    level: int = 9
    #: The size reduction of a block from which a template is confirmed there. Of some thousand blocks with edited notices in other
    #: letters, the one that was made smaller least was so by 0.13.
    reduction: float = 0.05
    #: The share of the template's words that must stand in the place, in order.
    coverage: float = 0.9


def _differences(template: list[str], words: list[str]) -> list[str]:
    """The template's words that a longest common subsequence leaves out, then the others of `words`."""
    most = [[0] * (len(words) + 1) for _ in range(len(template) + 1)]
    for i in range(len(template) - 1, -1, -1):
        for j in range(len(words) - 1, -1, -1):
            most[i][j] = most[i + 1][j + 1] + 1 if template[i] == words[j] else max(most[i + 1][j], most[i][j + 1])
    i, j, less, more = 0, 0, [], []
    while i < len(template) and j < len(words):
        if template[i] == words[j]:
            i, j = i + 1, j + 1
        elif most[i + 1][j] >= most[i][j + 1]:
            less.append(f"-{template[i]}")
            i += 1
        else:
            more.append(f"+{words[j]}")
            j += 1
    return less + [f"-{w}" for w in template[i:]] + more + [f"+{w}" for w in words[j:]]


class Scanner:
    """The templates, compressed and split; one for each Python worker."""

    def __init__(self, templates: list[tuple[str, str]], s: Settings):
        self.s, self.plain = s, zstandard.ZstdCompressor(level=s.level, write_content_size=False, write_checksum=False)
        self.templates, self.numbers = [], {}
        for name, text in templates:
            words = [w.lower() for w in _WORD.findall(text)]
            d = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=s.level)
            self.templates.append((name, zstandard.ZstdCompressor(level=s.level, dict_data=d, write_content_size=False, write_checksum=False), words))
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)  # 0 is any other word
        #: For each template: the fewest words that must stand in a place, the most differing ones,
        #: whether a word is the template's, whether a place may begin with it, and its positions as bits.
        self.tests = []
        for _, _, words in self.templates:
            n = len(words)
            least = next((m for m in range(n + 1) if n and m / n >= s.coverage), n + 1)
            inside, begins, bits = np.zeros(len(self.numbers) + 1, bool), np.zeros(len(self.numbers) + 1, bool), [0] * (len(self.numbers) + 1)
            for j, w in enumerate(words):
                inside[self.numbers[w]] = True
                begins[self.numbers[w]] |= j <= n - least
                bits[self.numbers[w]] |= 1 << j
            self.tests.append((least, max(1, round((1 - s.coverage) * 2 * n)), inside, begins, bits))
        #: Templates by the length of their blocks in words: what the longest place can have, as the least of 4, 6, 8, 12, ..
        #: words, and a quarter more, so that blocks which begin at every quarter have each place whole.
        self.lengths: dict[int, list[int]] = {}
        for i, ((_, _, words), (_, most, *_)) in enumerate(zip(self.templates, self.tests, strict=True)):
            longest = next(n << k for k in range(1, 60) for n in (2, 3) if n << k >= len(words) + most)
            self.lengths.setdefault(longest, []).append(i)

    def paragraphs(self, text: str) -> Iterator[tuple[int, str]]:
        """The paragraphs with a cue, and where they begin."""
        if _CUE.search(text.lower()):
            at = 0
            for part in text.split("\n\n"):
                if _CUE.search(part.lower()):
                    yield at, part
                at += len(part) + 2

    def places(self, ids: np.ndarray, i: int) -> Iterator[tuple[int, int, int]]:
        """(differing words, first word, end) of all stretches of words that hold template i."""
        least, most, inside, begins, bits = self.tests[i]
        n, total = len(self.templates[i][2]), len(ids)
        own = inside[ids]
        before = np.append(0, np.cumsum(own))
        # A stretch has at most n + most words, and `least` of them are the template's.
        starts = np.flatnonzero(begins[ids] & (before[np.minimum(np.arange(total) + n + most, total)] - before[:-1] >= least))
        whole = (1 << n) - 1
        for s in starts.tolist():
            left, matched = whole, 0  # the longest common subsequence of template and stretch, bit by bit (Hyyrö)
            for e, w in enumerate(ids[s : s + n + most].tolist(), s + 1):
                here = left & bits[w]
                if here:
                    left = ((left + here) | (left - here)) & whole
                    now = n - left.bit_count()
                    differ = n + e - s - 2 * now
                    if now > matched and now >= least and differ <= most:
                        yield differ, s, e
                    matched = now
                if e - s - matched > most:
                    break

    def ranked(self, words: list[str], among: list[int]) -> list[tuple[float, int]]:
        """By how much each of the templates makes the words smaller than they are compressed alone, the most first."""
        raw = " ".join(words).encode()
        alone = len(self.plain.compress(raw))
        return sorted(((1 - len(self.templates[i][1].compress(raw)) / alone, i) for i in among), key=lambda x: (-x[0], x[1]))

    def found(self, words: list[str], ids: np.ndarray) -> set[tuple[int, int, int, int]]:
        """(differing words, first word, end, template) of all places, of every block's winners."""
        return {(d, a + s, a + e, i) for a, b, i in self.winners(words, ids) for d, s, e in self.places(ids[a:b], i)}

    def winners(self, words: list[str], ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first word, end, template) of every block that a template makes enough smaller. Where a
        block has too few of a template's words to hold it, it isn't compressed with that one."""
        for longest, among in self.lengths.items():
            quarter = -(-longest // 4)
            first = np.arange(0, max(1, len(words) - longest + 1), quarter)
            end = np.minimum(first + longest + quarter, len(words))
            own = [np.append(0, np.cumsum(self.tests[i][2][ids])) for i in among]
            holds = np.array([n[end] - n[first] >= self.tests[i][0] for i, n in zip(among, own, strict=True)])
            for k in np.flatnonzero(holds.any(0)).tolist():
                a, b = int(first[k]), int(end[k])
                for share, i in self.ranked(words[a:b], [i for i, h in zip(among, holds[:, k].tolist(), strict=True) if h]):
                    if share < self.s.reduction:
                        break
                    yield a, b, i

    def match(self, block: str) -> list[tuple[int, int, str, float, float, list[str]]]:
        """The licenses of a paragraph by start; where found places overlap, the one with the fewest differing
        words stays, on ties the longest, then the first, then the one of the greatest size reduction."""
        tokens = list(_WORD.finditer(block))
        words = [t[0].lower() for t in tokens]
        ids = np.fromiter((self.numbers.get(w, 0) for w in words), np.int64, len(words))
        found = sorted((d, tokens[s].start() - tokens[e - 1].end(), s, e, i) for d, s, e, i in self.found(words, ids))
        taken, out = np.zeros(len(words), bool), []
        for (d, _, s, e), same in itertools.groupby(found, lambda x: x[:4]):
            if taken[s:e].any():
                continue
            taken[s:e] = True
            a, b = tokens[s].start(), tokens[e - 1].end()
            reduction, i = self.ranked(words[s:e], [i for *_, i in same])[0]
            name, _, template = self.templates[i]
            differ = _differences(template, words[s:e]) if d else []
            out.append((a, b, name, reduction, (len(template) - sum(x[0] == "-" for x in differ)) / len(template), differ))
        return sorted(out)

    def scan(self, text: str) -> list[dict]:
        return [{"license": n, "start": at + a, "end": at + b, "reduction": r, "coverage": c, "differences": d} for at, block in self.paragraphs(text) for a, b, n, r, c, d in self.match(block)]


_scanners: dict[tuple, Scanner] = {}


def scan(docs: DataFrame, *, text: str = "text", into: str = "licenses", templates: list[tuple[str, str]] | None = None, settings: Settings = Settings()) -> DataFrame:
    """`docs` with an array `into` of the licenses found, by start: license, start and end in
    code points, size reduction, coverage, and differing words (- of the template, + of the text).

    The templates go with the plan; their number and size are the caller's and don't grow with the data.
    Defined cases: null and empty texts have none; rows don't affect one another; other
    columns stay, one named like `into` is replaced.
    """
    chosen = tuple(templates if templates is not None else TEMPLATES)
    for _, t in chosen:
        if not _CUE.search(t.lower()):
            raise ValueError(f"a template without a cue can't be found: {t[:60]}")

    @F.arrow_udf(FOUND)
    def found(column: pa.Array) -> pa.Array:
        key = (chosen, settings)
        if key not in _scanners:
            _scanners[key] = Scanner(list(chosen), settings)
        scanner = _scanners[key]
        out = []
        for a in range(0, len(column), 256):
            out += [scanner.scan(t) if t else [] for t in column.slice(a, 256).to_pylist()]
        return pa.array(out, _ARROW)

    return docs.withColumn(into, found(F.col(text)))


_ARROW = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reduction", pa.float64()), ("coverage", pa.float64()), ("differences", pa.list_(pa.string()))]))
