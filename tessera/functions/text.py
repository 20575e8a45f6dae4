"""Address normalisers as Column expressions; no Python runs per row.

The two sides of the match are normalised differently, on purpose: the registry side is
upper-case ASCII already and only gets its street type expanded, while the index side is
folded to ASCII and has abbreviations expanded anywhere in the name.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let

#: Street types of the registry side, whole token to word.
STREET_TYPES = {
    "RUA": ("R", "RUA"),
    "AVENIDA": ("AV", "AVENIDA"),
    "TRAVESSA": ("TV", "TRAV", "TRAVESSA"),
    "ALAMEDA": ("AL", "ALM", "ALAMEDA"),
    "PRACA": ("PC", "PCA", "PRACA"),
    "ESTRADA": ("EST", "ESTRADA"),
    "RODOVIA": ("ROD", "RODOVIA"),
    "LARGO": ("LG", "LARGO"),
}
#: Abbreviations of the index side, expanded in this order.
ABBREVIATIONS = [
    ("R", "RUA"), ("AV", "AVENIDA"), ("AVDA", "AVENIDA"), ("AL", "ALAMEDA"), ("ALM", "ALAMEDA"), ("TV", "TRAVESSA"), ("TRAV", "TRAVESSA"), ("PC", "PRACA"),
    ("PCA", "PRACA"), ("PRA", "PRACA"), ("LG", "LARGO"), ("ROD", "RODOVIA"), ("EST", "ESTRADA"), ("BC", "BECO"), ("LD", "LADEIRA"), ("VL", "VILA"),
    ("JD", "JARDIM"), ("COND", "CONDOMINIO"),
]
#: Prepositions that don't tell streets apart, and ways to say "no number".
PREPOSITIONS = "DE|DA|DO|DAS|DOS|E"
NO_NUMBER = ["S/N", "SN", "S N", "SEM NUMERO", "SEM NÚMERO", "0", "", "N/A", "S"]
POI_NO_NUMBER = ["S/N", "SN", "S N", "0", ""]
#: One or more characters beyond ASCII, what is stripped from the ends of the index side's texts, and where the blocks of common Latin letters end.
BEYOND, BLANK, LATIN = r"[^\x00-\x7F]+", " \t\n\x0b\f\r\x1c\x1d\x1e\x1f", 0x180


@lru_cache(1)
def _folded() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility decomposition has ASCII characters in it, and those: one, or several."""
    one, several = {}, {}
    for c in map(chr, range(0x80, 0x20000)):  # beyond, nothing decomposes to ASCII
        if unicodedata.decomposition(c) and (d := unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()):
            (one if len(d) == 1 else several)[c] = d
    return one, several


def _class(chars: Iterable[str]) -> str:
    """A character class, neighbours as ranges: a class is looked through one member at a time."""
    ranges: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return f"[{''.join(f'{chr(a)}-{chr(b)}' for a, b in ranges)}]"


def replaced(s: Column, pattern: str, by: Callable[[Column], Column]) -> Column:
    """All matches of `pattern`, each replaced by what `by` says of it, in one pass."""
    put = lambda gap, k: F.concat(gap, F.coalesce(by(k), F.lit("")))  # noqa: E731  split() leaves one piece more
    return let(s, lambda s: F.when(s.rlike(pattern), F.array_join(F.zip_with(F.split(s, pattern), F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), put), "")).otherwise(s))


def _looked_up(k: Column, words: Mapping[str, str]) -> Column:
    return F.get(F.lit(list(words.values())), (F.array_position(F.lit(list(words)), k) - 1).cast("int"))


def _translated(s: Column, chars: Mapping[str, str]) -> Column:
    return F.translate(s, "".join(chars), "".join(chars.values()))


def fold(s: Column) -> Column:
    """The ASCII part of the compatibility decomposition (NFKD): é is e, º is o, ½ is 12, № is No, ß is nothing.
    Only what stands between ASCII characters is looked at, and most of that is Latin letters, which a short table has."""
    one, several = _folded()
    letters = {c: d for c, d in one.items() if ord(c) < LATIN}
    other = lambda run: F.regexp_replace(_translated(replaced(run, _class(several), lambda k: _looked_up(k, several)), one), BEYOND, "")
    return replaced(s, BEYOND, lambda run: F.when(run.rlike(f"^{_class(letters)}+$"), _translated(run, letters)).otherwise(other(run)))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def cep_key(s: Column) -> Column:
    """Eight digits: padded with zeros, cut if longer; null stays null."""
    return F.lpad(digits(s), 8, "0")


def cep_key_strict(s: Column) -> Column:
    """Eight digits for lookups: padded with zeros, null if longer; null counts as no digits at all."""
    d = F.coalesce(digits(s), F.lit(""))
    return F.when(F.length(d) <= 8, F.lpad(d, 8, "0"))


def compose_id(base: Column, order: Column, check: Column) -> Column:
    """The 14-character id; short parts are padded with zeros."""
    return F.concat(F.lpad(base, 8, "0"), F.lpad(order, 4, "0"), F.lpad(check, 2, "0"))


def _spaced(s: Column) -> Column:
    return F.regexp_replace(s, r"\s+", " ")


def _without_prepositions(s: Column) -> Column:
    """Only between spaces, and of two in a row only the first."""
    return F.regexp_replace(s, rf"\s+({PREPOSITIONS})\s+", " ")


def _upper(s: Column) -> Column:
    """Trimmed and upper-cased letter by letter, so ß is one letter still."""
    return F.upper(F.replace(F.trim(s), F.lit("ß"), F.lit("ẞ")))


def poi_street(kind: Column, name: Column) -> Column:
    """Type and name of a registry street; null if either is."""
    k = _upper(kind)
    word = k
    for full, short in STREET_TYPES.items():
        word = F.when(k.isin(*short), F.lit(full)).otherwise(word)
    return _spaced(_without_prepositions(F.concat(word, F.lit(" "), _upper(name))))


def poi_number(s: Column) -> Column:
    """Leading digits; null for no number, empty for other texts without any."""
    return F.when(~_upper(s).isin(*POI_NO_NUMBER), F.regexp_extract(F.trim(s), "^[0-9]+", 0))


def poi_city(s: Column) -> Column:
    return _upper(s)


def _no_brackets(s: Column) -> Column:
    return F.regexp_replace(s, r"\s*\([^)]*\)\s*", "")


def poi_district(s: Column) -> Column:
    return _spaced(_without_prepositions(_no_brackets(_upper(s))))


def suburb_clean(s: Column) -> Column:
    """An index district without what stands in brackets; null is empty."""
    return _spaced(_no_brackets(F.coalesce(s, F.lit(""))))


def index_street(s: Column) -> Column:
    """Abbreviations are whole words, none of them the expansion of another, so they are marked in
    one pass; the marks are no ASCII, which is all that folding leaves, so they are found quickly."""
    words = {f"«{short}»": full for short, full in ABBREVIATIONS} | {"«»": ""}
    begin = "".join(sorted({w[0] for w in [*dict(ABBREVIATIONS), *PREPOSITIONS.split("|")]}))
    marked = F.regexp_replace(_strip(F.upper(fold(s))), rf"(?<!\w)(?=[{begin}])(?:({'|'.join(dict(ABBREVIATIONS))})|{PREPOSITIONS})(?!\w)", "«$1»")
    out = replaced(marked, "«[A-Z]*»", lambda k: _looked_up(k, words))
    return let(_strip(_spaced(out)), lambda v: F.nullif(v, F.lit("")))


def _strip(s: Column) -> Column:
    return F.trim(s, F.lit(BLANK))


def index_number(s: Column) -> Column:
    return let(_strip(F.upper(s)), lambda up: F.when(~up.isin(*NO_NUMBER), F.nullif(F.regexp_extract(up, "^[0-9]+", 0), F.lit(""))))


def index_city(s: Column) -> Column:
    return let(_spaced(_strip(F.upper(fold(s)))), lambda v: F.nullif(v, F.lit("")))
