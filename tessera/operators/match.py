"""Layered matching of addresses against an index of address points.

Each layer is an equi-join on its keys followed by a similarity filter, so the keys decide
what is compared. In the first and the fuzzy layer they are dealt to all tasks, however small
the tables are; a key's pairs are one task's. What is compared are the distinct
addresses of either side, so copies of an address cost no comparisons; every row is then told
what was found for its address. Ties go to the smallest coordinates, and a row that an earlier
layer matched takes no part in later ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import digits, index_city, index_number, index_street, jaro_winkler, poi_city, poi_district, poi_number, poi_street, suburb_clean
from ..schema import L1, L2, L3, L4, NONE
from ..scratch import saved


@dataclass(frozen=True)
class Names:
    """Column names of the two sides."""

    id: str = "cnpj"
    cep: str = "cep_norm"
    number: str = "num_norm"
    street: str = "street_norm"
    city: str = "city_norm"
    district: str = "bairro_norm"
    suburb: str = "suburb_clean"
    lat: str = "lat"
    lon: str = "lon"


@dataclass(frozen=True)
class Thresholds:
    street: float = 0.90
    district: float = 0.80
    fuzzy: float = 0.85


def normalise_pois(df: DataFrame) -> DataFrame:
    """The registry side: the address columns and their normal forms."""
    return df.select(
        "cnpj", "tipo_logradouro", "logradouro", "numero", "bairro", "cep", "municipio", "municipio_descricao", "uf",
        digits(F.col("cep")).alias("cep_norm"),
        poi_number(F.col("numero")).alias("num_norm"),
        poi_street(F.col("tipo_logradouro"), F.col("logradouro")).alias("street_norm"),
        poi_city(F.col("municipio_descricao")).alias("city_norm"),
        poi_district(F.col("bairro")).alias("bairro_norm"),
    )


def build_index(points: DataFrame, *, postcode: str = "postcode:pt-Latn", number: str = "housenumber", street: str = "street:pt-Latn", city: str = "city:pt-Latn", suburb: str = "suburb:pt-Latn") -> DataFrame:
    """The index side, from address points with lat and lon; points without a place are dropped."""
    c = lambda name: F.col(f"`{name}`")
    return points.where("lat is not null and lon is not null").select(
        digits(c(postcode)).alias("cep_norm"), index_number(c(number)).alias("num_norm"), c(number).alias("housenumber_raw"),
        index_street(c(street)).alias("street_norm"), c(street).alias("street_raw"), index_city(c(city)).alias("city_norm"),
        index_city(c(suburb)).alias("suburb_norm"), c(suburb).alias("suburb_raw"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"),
    )


def _index(index: DataFrame, n: Names) -> DataFrame:
    if n.suburb not in index.columns:
        index = index.withColumn(n.suburb, suburb_clean(F.col("suburb_norm")))
    names = {n.cep: "__cep", n.number: "__number", n.street: "__street", n.city: "__city", n.suburb: "__suburb", n.lat: "__lat", n.lon: "__lon"}
    return index.select(*[F.col(a).alias(b) for a, b in names.items() if a in index.columns])


def _addresses(pois: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct addresses, in columns __p0, __p1 and so on."""
    return pois.select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(keys)]).distinct()


def _points(index: DataFrame, n: Names, *keys: str) -> DataFrame:
    """The distinct addresses of the index: how many points have each, and the smallest coordinates."""
    return _index(index, n).groupBy(*keys).agg(F.count("*").alias("__n"), F.min(F.struct("__lat", "__lon")).alias("__at"))


def _first(order: Column) -> Column:
    """The coordinates of the least `order`, the smallest of several."""
    return F.min(F.struct(order.alias("order"), "__at")).alias("__best")


def _of_rows(pois: DataFrame, n: Names, keys: Sequence[str], found: DataFrame) -> DataFrame:
    """What was found for the address of each row. Only a district may be null."""
    on = [F.col(k).eqNullSafe(F.col(f"__p{i}")) if k == n.district else F.col(k) == F.col(f"__p{i}") for i, k in enumerate(keys)]
    return pois.select(n.id, *keys).join(found, on)


def _placed(df: DataFrame, n: Names, label: str) -> DataFrame:
    return df.select(n.id, F.col("__best.__at.__lat").alias("lat"), F.col("__best.__at.__lon").alias("lon"), F.lit(label).alias("geo_precision"))


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by their keys to as many tasks as the session has for a shuffle. Few rows can
    make many pairs, and Spark would put them in one task by their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _best(pois: DataFrame, n: Names, keys: Sequence[str], found: DataFrame, label: str) -> DataFrame:
    """One row for each id, the best of those found for its addresses."""
    return _placed(_of_rows(pois, n, keys, found).groupBy(n.id).agg(F.min("__best").alias("__best")), n, label)


def layer1(pois: DataFrame, index: DataFrame, n: Names = Names(), t: Thresholds = Thresholds()) -> DataFrame:
    """Equal postcode and number, and a similar street; the most similar one."""
    keys = [n.cep, n.number, n.street]
    points = _points(index, n, "__cep", "__number", "__street").where("__street is not null")
    own = _addresses(pois, keys).where("__p2 is not null")
    same = points.where("__street <> ''").select(F.col("__cep").alias("__p0"), F.col("__number").alias("__p1"), F.col("__street").alias("__p2"), F.col("__at").alias("__same"))
    known = own.join(same, ["__p0", "__p1", "__p2"], "left")  # no other street is as similar as an equal one
    rest = _spread(known.where("__same is null").drop("__same"), "__p0", "__p1")
    both = rest.join(_spread(points, "__cep", "__number"), (F.col("__p0") == F.col("__cep")) & (F.col("__p1") == F.col("__number")))
    scored = both.withColumn("__score", jaro_winkler(F.col("__p2"), F.col("__street"), t.street)).where(F.col("__score") >= t.street)
    found = scored.groupBy(*[f"__p{i}" for i in range(len(keys))]).agg(_first(-F.col("__score")))
    equal = known.where("__same is not null").select("__p0", "__p1", "__p2", F.struct(F.lit(-1.0).alias("order"), F.col("__same").alias("__at")).alias("__best"))
    found = found.unionByName(equal)
    return _best(pois, n, keys, found, L1)


def layer2(pois: DataFrame, index: DataFrame, n: Names = Names()) -> DataFrame:
    """Equal postcode and number, if only one point has them. Not part of the cascade."""
    points = _points(index, n, "__cep", "__number").select(F.col("__cep").alias("__p0"), F.col("__number").alias("__p1"), "__n", F.struct("__at").alias("__best"))
    own = _of_rows(pois, n, [n.cep, n.number], points).groupBy(n.id).agg(F.sum("__n").alias("__n"), F.min("__best").alias("__best"))
    return _placed(own.where("__n = 1"), n, L2)


def similar_district(a: Column, b: Column, t: Thresholds) -> Column:
    return F.coalesce((F.length(a) > 0) & (F.length(b) > 0) & (jaro_winkler(a, b, t.district) >= t.district), F.lit(False)).cast("int")


def layer3(pois: DataFrame, index: DataFrame, n: Names = Names(), t: Thresholds = Thresholds()) -> DataFrame:
    """Equal street, number and city, if that is one point, or one of a similar district. Points
    are counted as they are, so an address that the index has twice isn't unique."""
    keys = [n.street, n.number, n.city, n.district]
    on = (F.col("__p0") == F.col("__street")) & (F.col("__p1") == F.col("__number")) & (F.col("__p2") == F.col("__city"))
    both = _addresses(pois, keys).join(_points(index, n, "__street", "__number", "__city", "__suburb"), on)
    near = both.withColumn("__near", similar_district(F.col("__p3"), F.col("__suburb"), t))
    found = near.groupBy("__p0", "__p1", "__p2", "__p3").agg(F.sum("__n").alias("__n"), F.sum(F.col("__near") * F.col("__n")).alias("__m"), _first(-F.col("__near")))
    own = _of_rows(pois, n, keys, found).groupBy(n.id).agg(F.sum("__n").alias("__n"), F.sum("__m").alias("__m"), F.min("__best").alias("__best"))
    return _placed(own.where("__n = 1 or __m = 1"), n, L3)


def layer4(pois: DataFrame, index: DataFrame, n: Names = Names(), t: Thresholds = Thresholds()) -> DataFrame:
    """Equal city and number, a similar street, and a district that is similar or unknown. Only
    on request: without a postcode it finds many wrong streets."""
    keys = [n.city, n.number, n.street, n.district]
    points = _points(index, n, "__city", "__number", "__street", "__suburb").where("__street is not null")
    open_ = F.min(F.when(F.length("__suburb") == 0, F.col("__at"))).alias("__open")
    streets = points.groupBy("__city", "__number", "__street").agg(F.min("__at").alias("__any"), open_)
    own, place = _addresses(pois, keys).where("__p2 is not null"), ["__p0", "__p1", "__p2"]
    both = _spread(own.select(*place).distinct(), "__p0", "__p1").join(_spread(streets, "__city", "__number"), (F.col("__p0") == F.col("__city")) & (F.col("__p1") == F.col("__number")))
    scored = both.withColumn("__score", jaro_winkler(F.col("__p2"), F.col("__street"), t.fuzzy)).where(F.col("__score") >= t.fuzzy)
    at = lambda c: F.struct((-F.col("__score")).alias("order"), F.col(c).alias("__at"))
    linked = scored.groupBy(*place).agg(
        F.min(at("__any")).alias("__any"), F.min(F.when(F.col("__open").isNotNull(), at("__open"))).alias("__open"), F.collect_list(F.struct((-F.col("__score")).alias("order"), "__street")).alias("__streets")
    )
    # An address without a district takes the best point, others the best without one, or a better one of a similar district.
    better = F.filter("__streets", lambda x: F.col("__p3").isNotNull() & (F.col("__open").isNull() | (x["order"] <= F.col("__open.order"))))
    known = own.join(linked, place).select(*place, "__p3", F.when(F.col("__p3").isNull(), F.col("__any")).otherwise(F.col("__open")).alias("__sure"), F.explode_outer(better).alias("__x"))
    asked = _spread(known.select("*", F.col("__x.order").alias("order"), F.col("__x.__street").alias("__y")).drop("__x"), "__p0", "__p1", "__y")
    closed = _spread(points.where(F.length("__suburb") > 0), "__city", "__number", "__street")
    on = (F.col("__p0") == F.col("__city")) & (F.col("__p1") == F.col("__number")) & (F.col("__y") == F.col("__street")) & (F.col("__sure").isNull() | (F.struct("order", "__at") < F.col("__sure")))
    near = asked.join(closed, on, "left").withColumn("__d", jaro_winkler(F.col("__p3"), F.col("__suburb"), t.district))
    found = near.groupBy(*place, "__p3").agg(F.min(F.least("__sure", F.when(F.col("__d") >= t.district, F.struct("order", "__at")))).alias("__best")).where("__best is not null")
    return _best(pois, n, keys, found, L4)


def similar_pairs(df: DataFrame, id: str, keys: Sequence[str], text: str, threshold: float) -> DataFrame:
    """(a, b, score): the ids, a < b, of all rows with equal keys and similar texts. Distinct
    texts are compared, in the order in which their rows have them; rows are only joined."""
    texts = df.select(*keys, F.col(text).alias("__x")).where("__x is not null").distinct()
    both = texts.join(texts.withColumnRenamed("__x", "__y"), [*keys])
    links = both.withColumn("score", jaro_winkler(F.col("__x"), F.col("__y"), threshold)).where(F.col("score") >= threshold)
    first = df.select(F.col(id).alias("a"), *keys, F.col(text).alias("__x")).join(links, [*keys, "__x"]).drop("__x")
    return first.join(df.select(F.col(id).alias("b"), *keys, F.col(text).alias("__y")), [*keys, "__y"]).where("a < b").select("a", "b", "score")


def cascade(pois: DataFrame, index: DataFrame, n: Names = Names(), t: Thresholds = Thresholds(), *, fuzzy: bool = False) -> DataFrame:
    """(id, lat, lon, geo_precision) of the rows that some layer matches, the first that does.

    Each layer's matches are written to the shared folder before the next layer reads them, so
    every layer is computed once, over the rows that are left.
    """
    found = saved(layer1(pois, index, n, t), "matched")
    for layer in (layer3, layer4)[: 1 + fuzzy]:
        found = found.unionByName(saved(layer(pois.join(found.select(n.id), n.id, "left_anti"), index, n, t), "matched"))
    return found


def located(pois: DataFrame, found: DataFrame, id: str = "cnpj") -> DataFrame:
    """All rows, with the coordinates that were found and `none` where none were."""
    return pois.join(found, id, "left").withColumn("geo_precision", F.coalesce("geo_precision", F.lit(NONE)))


def summary(df: DataFrame, column: str = "geo_precision") -> DataFrame:
    """Rows and their share in percent by value, the most frequent first."""
    total = F.sum(F.count("*")).over(Window.partitionBy())
    return df.groupBy(column).agg(F.count("*").alias("n"), (100.0 * F.count("*") / total).alias("percent")).orderBy(F.desc("n"), column)


def propagate(pois: DataFrame, known: DataFrame, n: Names = Names()) -> DataFrame:
    """Coordinates for rows without any from rows of the same postcode, number and street that
    have them; the smallest coordinates of several. `known` is read twice or more, so what is long to
    compute should be written before."""
    keys = [n.cep, n.number, n.street]
    place = pois.join(known, n.id).where("lat is not null and lon is not null").groupBy(*keys).agg(F.min(F.struct("lat", "lon")).alias("at"))
    return pois.join(known.select(n.id), n.id, "left_anti").join(place, keys).select(n.id, F.col("at.lat").alias("lat"), F.col("at.lon").alias("lon"))
