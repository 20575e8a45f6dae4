"""Row filters. Predicates keep SQL's three-valued logic: what is unknown is dropped."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ACTIVE, EXCLUDED_NATURE, EXCLUDED_SIZE


def active(df: DataFrame, column: str = "situacao_cadastral", value: str = ACTIVE) -> DataFrame:
    return df.where(F.col(column) == value)


def without(df: DataFrame, excluded: dict[str, str] | None = None) -> DataFrame:
    """Rows that have none of the excluded values; a null in any of the columns drops the row."""
    excluded = {"porte": EXCLUDED_SIZE, "natureza_juridica": EXCLUDED_NATURE} if excluded is None else excluded
    return df.where(reduce(Column.__and__, [F.col(c) != v for c, v in excluded.items()], F.lit(True)))


def predicates(ufs: Iterable[str] | None = None, category: str | None = None, codes: Iterable[str] | None = None, *, uf: str = "uf", tag: str = "osm_category", code: str = "cnae_fiscal_principal") -> list[Column]:
    """One predicate for each filter that is given: states (upper-cased), a tag `key=value` or
    a tag key, and activity codes."""
    out = []
    if ufs:
        out.append(F.col(uf).isin(*[u.upper() for u in ufs]))
    if category:
        out.append(F.col(tag) == category if "=" in category else F.col(tag).startswith(f"{category}="))
    if codes:
        out.append(F.col(code).isin(*codes))
    return out


def select_where(df: DataFrame, *args, **kwargs) -> DataFrame:
    """All filters that are given, ANDed; all rows without any."""
    return reduce(DataFrame.where, predicates(*args, **kwargs), df)


def located(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(key).distinct()


def remaining(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among those done; never NOT IN, so a null there does no harm."""
    return df.join(done.select(key), key, "left_anti")


def relevant(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is wanted."""
    return df.join(wanted.select(key), key, "left_semi")


def united(*tables: DataFrame) -> DataFrame:
    """All rows of tables with the same columns in any order."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
