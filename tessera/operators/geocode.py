"""Coordinates from key lookups, a test against city centres, and a fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cep_key, cep_key_strict, within
from ..schema import CENTROID, CEP, NONE, PENDING, RESULT_LABELS, UNKNOWN_LABEL
from .enrich import small


#: Fixed value: the key of rows without digits.
BLANK = "00000000"


def missing_keys(pois: DataFrame, cache: DataFrame, column: str = "cep", key: str = "cep") -> DataFrame:
    """The distinct lookup keys that the cache hasn't; one row each, so each is asked for once."""
    wanted = pois.select(cep_key_strict(F.col(column)).alias(key)).where(F.col(key).isNotNull()).distinct()
    return wanted.join(cache.select(key), key, "left_anti")


def by_key(df: DataFrame, side: DataFrame, own: Column, key: str, value: str) -> DataFrame:
    """`df` with the struct `value` of the side's row of the key `own`; keys are unique there.
    Rows without digits share the blank key, so its one row is broadcast and all others are joined by theirs."""
    blank = side.where(F.col(key) == BLANK).select(F.col(key).alias("__blank"), F.col(value).alias("__of_blank"))
    named = side.where(F.col(key) != BLANK).select(F.col(key).alias("__key"), F.col(value).alias("__of_key"))
    out = df.withColumn("__own", own).join(named, F.nullif("__own", F.lit(BLANK)) == F.col("__key"), "left")
    out = out.join(F.broadcast(blank), F.col("__own") == F.col("__blank"), "left")
    return out.withColumn(value, F.coalesce("__of_key", "__of_blank")).drop("__own", "__key", "__of_key", "__blank", "__of_blank")


def number(value: Column) -> Column:
    """A double, or null for what isn't a number."""
    return value.try_cast("double")


def located(pois: DataFrame, cache: DataFrame, column: str = "cep") -> DataFrame:
    """All rows with lat, lon and geo_precision from the cache by their key; of repeated keys the greatest place counts."""
    side = cache.groupBy(F.col("cep").alias("key")).agg(F.max(F.struct(number(F.col("lat")).alias("lat"), number(F.col("lon")).alias("lon"))).alias("__at"))
    out = by_key(pois, side, cep_key_strict(F.col(column)), "key", "__at")
    out = out.withColumn("lat", F.col("__at.lat")).withColumn("lon", F.col("__at.lon")).drop("__at")
    return out.withColumn("geo_precision", F.when(F.col("lat").isNotNull(), CEP).otherwise(NONE))


def flag_centres(df: DataFrame, centres: DataFrame, key: str = "municipio", metres: float = 500.0) -> DataFrame:
    """`municipio_centroid` where a looked-up place is within `metres` of its city's centre, the border included."""
    side = centres.select(F.col(key).alias("__key"), F.col("lat_centro").alias("__lat"), F.col("lon_centro").alias("__lon"))
    near = (F.col("geo_precision") == CEP) & within(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon"), metres)
    out = df.join(small(side), F.col(key) == F.col("__key"), "left")  # a row for each city of a country
    return out.withColumn("geo_precision", F.when(near, CENTROID).otherwise(F.col("geo_precision"))).drop("__key", "__lat", "__lon")


def crosswalk(centres: DataFrame, codes: DataFrame, own: str = "codigo_rf", other: str = "codigo_ibge", key: str = "municipio") -> DataFrame:
    """Centres under the registry's own city codes instead of the census's."""
    side = codes.select(F.col(other).cast("string").alias("__other"), F.col(own).cast("string").alias("__own"))
    return centres.join(small(side), F.col(key) == F.col("__other")).select(F.col("__own").alias(key), "lat_centro", "lon_centro")


def needs_fallback(df: DataFrame) -> DataFrame:
    return df.where(F.col("geo_precision").isin(CENTROID, NONE))


def merge_fallback(df: DataFrame, found: DataFrame, id: str = "cnpj") -> DataFrame:
    """The fallback's coordinates and label where a row needs them and the fallback has a latitude."""
    side = found.select(F.col(id).alias("__id"), F.col("lat").alias("__lat"), F.col("lon").alias("__lon"), F.col("geo_precision").alias("__label")).where("__lat is not null")
    use = F.col("geo_precision").isin(CENTROID, NONE) & F.col("__lat").isNotNull()
    out = df.join(side, F.col(id) == F.col("__id"), "left").withColumn("__use", use)
    for c, new in (("lat", number(F.col("__lat"))), ("lon", number(F.col("__lon"))), ("geo_precision", F.col("__label"))):
        out = out.withColumn(c, F.when(F.col("__use"), new).otherwise(F.col(c)))
    return out.drop("__id", "__lat", "__lon", "__label", "__use")


def three_state(pois: DataFrame, cache: DataFrame, column: str = "cep") -> DataFrame:
    """The output while lookups still run: `cep`, `none` for keys that have no place, `pending` for
    keys not asked yet. Of repeated keys the greatest place counts, any before none."""
    side = cache.groupBy(cep_key(F.col("cep")).alias("key")).agg(F.max(F.struct("lat", "lon")).alias("__at"))
    out = by_key(pois, side, cep_key(F.col(column)), "key", "__at")
    state = F.when(F.col("__at").isNull(), PENDING).when(F.col("__at.lat").isNull(), NONE).otherwise(CEP)
    return out.withColumn("geo_precision", state).withColumn("lat", F.col("__at.lat")).withColumn("lon", F.col("__at.lon")).drop("__at")


def label_of(kind: Column) -> Column:
    """The label of a geocoder's result type."""
    out = F.lit(UNKNOWN_LABEL)
    for k, label in RESULT_LABELS.items():
        out = F.when(kind == k, label).otherwise(out)
    return out


def parse_lookup(body: Column) -> Column:
    """lat and lon of a key lookup's answer; what is empty or no number is null."""
    at = lambda k: F.get_json_object(body, f"$.location.coordinates.{k}").try_cast("double")
    lat, lon = at("latitude"), at("longitude")
    whole = lat.isNotNull() & lon.isNotNull() & (lat != 0) & (lon != 0)
    return F.struct(F.when(whole, lat).alias("lat"), F.when(whole, lon).alias("lon"))


def parse_structured(body: Column) -> Column:
    """lat, lon and geo_precision of the first result of a structured geocoder; `none` without any."""
    at = lambda k: F.get_json_object(body, f"$.results[0].{k}")
    any_ = F.get_json_object(body, "$.results[0]").isNotNull()
    return F.struct(
        at("position.lat").try_cast("double").alias("lat"), at("position.lon").try_cast("double").alias("lon"),
        F.when(any_, label_of(F.coalesce(at("type"), F.lit("")))).otherwise(NONE).alias("geo_precision"),
    )


def street_line(kind: Column, name: Column) -> Column:
    """Street type and name with one space between, without those that are blank."""
    part = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.nullif(F.concat_ws(" ", part(kind), part(name)), F.lit(""))


def update_cache(cache: DataFrame, new: DataFrame, key: str = "cep") -> DataFrame:
    """Old and new entries; failed lookups aren't kept, so they are tried again."""
    if "geo_precision" in new.columns:
        new = new.where(F.coalesce(F.col("geo_precision"), F.lit("")) != "failed")
    fresh = new.select(*cache.columns).withColumn("__new", F.lit(1))
    return cache.withColumn("__new", F.lit(0)).unionByName(fresh).groupBy(key).agg(F.max_by(F.struct(*[c for c in cache.columns if c != key]), "__new").alias("__v")).select(key, "__v.*")
