"""Ad-hoc exports: a few predicates over a table, counted or written."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame

from ..operators.filters import select_where
from ..sinks import export, safe_name


def filtered(df: DataFrame, folder: str, *, ufs: list[str] | None = None, category: str | None = None, codes: list[str] | None = None, formats: list[str] | None = None, count_only: bool = False, force: bool = True) -> int | list[str]:
    """The number of rows that the filters leave, or the paths of the files with them. Their
    geometries are null; all columns are properties."""
    rows = select_where(df, ufs, category, codes)
    if count_only:
        return rows.count()
    return export(rows, folder, formats or ["parquet"], force=force, name=safe_name(category, ufs), geometry=False)


def resolve(intermediate: str, date: str, path: str | None = None, slug: str | None = None) -> list[str]:
    """Places of a table to export or validate, the first that is there counts: a given path, a
    slugged table, any geocoded table, the joined one."""
    if path:
        return [path]
    named = [f"{intermediate}/geocoded__{slug}_{date}*.parquet"] if slug else [f"{intermediate}/geocoded*_{date}*.parquet"]
    return [*named, f"{intermediate}/joined_{date}*.parquet"]


def main(argv: list[str] | None = None) -> int:
    from ..session import session

    p = argparse.ArgumentParser(prog="tessera-export")
    p.add_argument("--source", required=True)
    p.add_argument("--out", default="data/output")
    p.add_argument("--uf", nargs="*")
    p.add_argument("--category")
    p.add_argument("--cnae", nargs="*")
    p.add_argument("--format", nargs="*")
    p.add_argument("--count", action="store_true")
    a = p.parse_args(argv)
    got = filtered(session().read.parquet(a.source), a.out, ufs=a.uf, category=a.category, codes=a.cnae, formats=a.format, count_only=a.count)
    print(got if a.count else "\n".join(got))
    return 0


if __name__ == "__main__":
    sys.exit(main())
