"""The star join: establishments with companies, lookups and category tags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import compose_id
from ..schema import POI

#: Rows and bytes of a table that is broadcast at most; larger ones are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def small(df: DataFrame, most: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The table with a broadcast hint if its rows and bytes, as counted, show that it is small."""
    size = F.coalesce(F.octet_length(F.to_csv(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)]))), F.lit(0))
    got = df.limit(most + 1).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes")).first()
    return F.broadcast(df) if got.rows <= most and (got.bytes or 0) <= most_bytes else df


def labelled(df: DataFrame, lookup: DataFrame | None, code: str, into: str, *, key: str = "codigo", label: str = "descricao", broadcast: bool = True) -> DataFrame:
    """`into` is the code's label, or the code itself where the lookup (or the table) is missing.
    A code that the lookup has twice gives two rows."""
    if lookup is None:
        return df.withColumn(into, F.col(code))
    side = lookup.select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    return df.join(small(side) if broadcast else side, F.col(code) == F.col("__key"), "left").withColumn(into, F.coalesce("__label", code)).drop("__key", "__label")


def tagged(df: DataFrame, tags: DataFrame, code: str = "cnae_fiscal_principal", into: str = "osm_category", *, key: str = "cnae_code", tag: str = "osm_category", on: Column | None = None) -> DataFrame:
    """`into` is the code's tag or null. `on` is a further condition of the join: rows that fail
    it stay and lose their tag."""
    side = tags.select(F.col(key).alias("__key"), F.col(tag).alias("__tag"))
    match = F.col(code) == F.col("__key")
    return df.join(small(side), match if on is None else match & on, "left").withColumn(into, F.col("__tag")).drop("__key", "__tag")


def tag_table(spark, mapping: Mapping[str, str]) -> DataFrame:
    """A mapping as a table; of repeated codes the last one counts, as in any mapping."""
    return spark.createDataFrame(sorted(mapping.items()), "cnae_code string, osm_category string")


def enrich(establishments: DataFrame, companies: DataFrame, tags: DataFrame, *, activities: DataFrame | None = None, natures: DataFrame | None = None, cities: DataFrame | None = None, ufs: Iterable[str] | None = None, codes: Iterable[str] | None = None, compat_on_filter: bool = False) -> DataFrame:
    """The 30-column table of points of interest.

    Establishments without a company are dropped. `ufs` and `codes` filter rows before the
    joins; with `compat_on_filter` they are conditions of the tag join instead, so all rows
    stay and those that fail lose their tag.
    """
    wanted = []
    if ufs:
        wanted.append(F.col("uf").isin(*ufs))
    if codes:
        wanted.append(F.col("cnae_fiscal_principal").isin(*codes))
    on = None
    for w in wanted:
        if compat_on_filter:
            on = w if on is None else on & w
        else:
            establishments = establishments.where(w)
    own = companies.select("cnpj_basico", "razao_social", "natureza_juridica", "porte", "capital_social")
    df = establishments.join(own, "cnpj_basico")
    df = labelled(df, activities, "cnae_fiscal_principal", "cnae_fiscal_principal_descricao")
    df = labelled(df, natures, "natureza_juridica", "natureza_juridica_descricao")
    df = labelled(df, cities, "municipio", "municipio_descricao")
    df = tagged(df, tags, on=on)
    return df.withColumn("cnpj", compose_id(F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv"))).select(*POI.names)
