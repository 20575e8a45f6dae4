"""The engine's operators over the driver's tables, each with SQL that says the same.

Registry columns don't exist there, so orders stand for establishments, customers for
companies, parts for points of interest, and an altered copy of the parts for the index of
address points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import cep_key, cep_key_strict, compose_id, fold, haversine_m, index_city, index_number, index_street, poi_district, poi_number, poi_street, suburb_clean
from .operators import enrich, filters, geocode, match, validate
from .scratch import saved
from .sinks.files import feature

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column) -> Column:
    return F.round(c, 6)


# --- filters --------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_active(spark, d):
    return filters.active(t(spark, d, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment, c_nationkey FROM customer WHERE nullif(c_mktsegment, 'MACHINERY') <> 'BUILDING' AND c_nationkey <> 7")
def exclude_3vl(spark, d):
    df = t(spark, d, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    return filters.without(df, {"segment": "BUILDING", "c_nationkey": 7}).select("c_custkey", "segment", "c_nationkey")


def _pois(spark, d) -> DataFrame:
    """Parts with a tag: key type, or size for the small ones."""
    tag = F.when(F.col("p_size") < 10, F.concat(F.lit("size="), F.col("p_size").cast("string"))).otherwise(F.concat(F.lit("type="), F.col("p_type")))
    return t(spark, d, "part").select("p_partkey", "p_brand", tag.alias("tag"), F.upper("p_brand").alias("uf"), F.col("p_size").cast("string").alias("code"))


TAG = "CASE WHEN p_size < 10 THEN 'size=' || p_size ELSE 'type=' || p_type END"
NAMES = {"uf": "uf", "tag": "tag", "code": "code"}


@query(f"SELECT p_partkey, {TAG} AS tag FROM part WHERE {TAG} = 'size=7'")
def tag_exact(spark, d):
    return filters.select_where(_pois(spark, d), category="size=7", **NAMES).select("p_partkey", "tag")


@query(f"SELECT p_partkey, {TAG} AS tag FROM part WHERE starts_with({TAG}, 'type=')")
def tag_prefix(spark, d):
    return filters.select_where(_pois(spark, d), category="type", **NAMES).select("p_partkey", "tag")


@query(f"SELECT p_partkey, {TAG} AS tag, CAST(p_size AS VARCHAR) AS code FROM part WHERE upper(p_brand) IN (SELECT DISTINCT upper(p_brand) FROM part ORDER BY 1 LIMIT 4) AND p_size IN (3, 14, 25) AND {TAG} LIKE 'type=%'")
def code_in(spark, d):
    df = _pois(spark, d)
    ufs = [r.uf for r in df.select("uf").distinct().orderBy("uf").limit(4).collect()]
    return filters.select_where(df, [u.lower() for u in ufs], "type", ["3", "14", "25"], **NAMES).select("p_partkey", "tag", "code")


@query(f"SELECT count(*) AS n FROM part WHERE starts_with({TAG}, 'size=')")
def count_only(spark, d):
    return filters.select_where(_pois(spark, d), category="size", **NAMES).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(value) AS located FROM events WHERE value IS NOT NULL")
def not_null_filter(spark, d):
    return filters.located(t(spark, d, "events"), "value", "event_id").agg(F.count("*").alias("n"), F.count("value").alias("located"))


# --- joins ----------------------------------------------------------------------------

SEGMENTS = {"AUTOMOBILE": "shop=car", "BUILDING": "craft=builder", "FURNITURE": "shop=furniture"}
_MAP = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in SEGMENTS.items()) + ") AS m(code, tag)"


def _star(spark, d, *, on: Column | None = None, where: Column | None = None) -> DataFrame:
    orders = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    if where is not None:
        orders = orders.where(where)
    df = orders.join(t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"), "o_custkey")
    nations = t(spark, d, "nation").where("n_nationkey % 5 != 0").select(F.col("n_nationkey").cast("string").alias("codigo"), F.col("n_name").alias("descricao"))
    df = enrich.labelled(df.withColumn("nation", F.col("c_nationkey").cast("string")), nations, "nation", "nation_label")
    tags = enrich.tag_table(spark, SEGMENTS)
    return enrich.tagged(df, tags, "c_mktsegment", "category", on=on).select("o_orderkey", "nation_label", "category", "o_totalprice", "o_orderstatus")


def _star_sql(on: str = "", where: str = "") -> str:
    return f"""SELECT o_orderkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation_label, m.tag AS category, o_totalprice, o_orderstatus
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) n ON c_nationkey = n_nationkey
    LEFT JOIN {_MAP} ON c_mktsegment = m.code {on} {where}"""


@query(f"SELECT nation_label, category, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM ({_star_sql(where="WHERE o_orderstatus = 'F'")}) GROUP BY ALL")
def star_enrich(spark, d):
    df = _star(spark, d, where=F.col("o_orderstatus") == "F")
    return df.groupBy("nation_label", "category").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(_star_sql(on="AND o_orderstatus = 'F'"))
def on_clause_filter(spark, d):
    return _star(spark, d, on=F.col("o_orderstatus") == "F")


@query(_star_sql(where="WHERE o_orderstatus = 'F'"))
def where_filter(spark, d):
    return _star(spark, d, where=F.col("o_orderstatus") == "F")


@query("SELECT l_orderkey, l_linenumber, lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || lpad(CAST(l_partkey AS VARCHAR), 4, '0') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS id FROM lineitem")
def compose_key(spark, d):
    s = lambda c: F.col(c).cast("string")
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", compose_id(s("l_orderkey"), s("l_partkey"), s("l_linenumber")).alias("id"))


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL")
def distinct_keys(spark, d):
    return filters.distinct_keys(t(spark, d, "orders"), "o_custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_remaining(spark, d):
    done = filters.active(t(spark, d, "orders"), "o_orderstatus", "F").select(F.col("o_custkey").alias("c_custkey"))
    return filters.remaining(t(spark, d, "customer"), done, "c_custkey").select("c_custkey", "c_name")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7)")
def semi_prefilter(spark, d):
    wanted = t(spark, d, "part").where("p_size = 7").select(F.col("p_partkey").alias("l_partkey"))
    return filters.relevant(t(spark, d, "lineitem"), enrich.small(wanted), "l_partkey").select("l_orderkey", "l_linenumber")


@query("SELECT k, max(src) AS src, count(*) AS n FROM (SELECT c_custkey AS k, 'cache' AS src FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT o_custkey, 'new' FROM orders) GROUP BY k")
def union_cache(spark, d):
    cache = t(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.lit("cache").alias("src"))
    new = t(spark, d, "orders").select(F.lit("new").alias("src"), F.col("o_custkey").alias("k"))
    return filters.united(cache, new).groupBy("k").agg(F.max("src").alias("src"), F.count("*").alias("n"))


# --- normalisers ----------------------------------------------------------------------

KINDS_OF_STREET = "['R', 'AV', ' tv ', 'ALM', 'PCA', 'EST', 'ROD', 'LG', 'KM']"
_kind = lambda: F.get(F.expr("array('R', 'AV', ' tv ', 'ALM', 'PCA', 'EST', 'ROD', 'LG', 'KM', null)"), F.pmod("doc_id", F.lit(10)).cast("int"))
_text = lambda: F.regexp_replace("text", r"[\r\n]+", " ")
_SQL_TEXT = r"regexp_replace(text, '[\r\n]+', ' ', 'g')"
#: Letters and signs beyond Latin, put before each text, and what folding leaves of them.
ODD, ODD_FOLDED = "Nguyễn Thị Ṩ № 7 ﬁ Ⅷ ㎞ ⑴ ｅ ", "Nguyen Thi S No 7 fi VIII km (1) e "


def _sql_fold(s: str) -> str:
    """By the database's own removal of accents; the signs of other decompositions that the texts have are written out."""
    signs = {"½": "12", "¼": "14", "¾": "34", "…": "...", "™": "TM", "ª": "a", "º": "o", "¹": "1", "²": "2", "³": "3", "\u00a0": " "}
    s = f"strip_accents({s})"
    for sign, plain in signs.items():
        s = f"replace({s}, '{sign}', '{plain}')"
    return f"regexp_replace({s}, '[^\\x00-\\x7F]', '', 'g')"


_SQL_KIND = f"({KINDS_OF_STREET[:-1]}, NULL])[(doc_id % 10) + 1]"
_SQL_TYPED = """CASE WHEN upper(trim(k)) IN ('R', 'RUA') THEN 'RUA' WHEN upper(trim(k)) IN ('AV', 'AVENIDA') THEN 'AVENIDA' WHEN upper(trim(k)) IN ('TV', 'TRAV', 'TRAVESSA') THEN 'TRAVESSA'
 WHEN upper(trim(k)) IN ('AL', 'ALM', 'ALAMEDA') THEN 'ALAMEDA' WHEN upper(trim(k)) IN ('PC', 'PCA', 'PRACA') THEN 'PRACA' WHEN upper(trim(k)) IN ('EST', 'ESTRADA') THEN 'ESTRADA'
 WHEN upper(trim(k)) IN ('ROD', 'RODOVIA') THEN 'RODOVIA' WHEN upper(trim(k)) IN ('LG', 'LARGO') THEN 'LARGO' ELSE upper(trim(k)) END"""


@query(rf"""SELECT doc_id, regexp_replace(regexp_replace({_SQL_TYPED} || ' ' || upper(trim(replace(s, ' the ', ' da '))), '\s+(DE|DA|DO|DAS|DOS|E)\s+', ' ', 'g'), '\s+', ' ', 'g') AS street
FROM (SELECT doc_id, {_SQL_KIND} AS k, {_SQL_TEXT} AS s FROM documents)""")
def norm_street_poi(spark, d):
    name = F.replace(_text(), F.lit(" the "), F.lit(" da "))
    return t(spark, d, "documents").select("doc_id", poi_street(_kind(), name).alias("street"))


def _sql_index_street(s: str) -> str:
    out = rf"trim(upper({s}), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31))"
    for pair in "R RUA,AV AVENIDA,AVDA AVENIDA,AL ALAMEDA,ALM ALAMEDA,TV TRAVESSA,TRAV TRAVESSA,PC PRACA,PCA PRACA,PRA PRACA,LG LARGO,ROD RODOVIA,EST ESTRADA,BC BECO,LD LADEIRA,VL VILA,JD JARDIM,COND CONDOMINIO".split(","):
        short, full = pair.split()
        out = rf"regexp_replace({out}, '\b{short}\b', '{full}', 'g')"
    return rf"nullif(trim(regexp_replace(regexp_replace({out}, '\b(DE|DA|DO|DAS|DOS|E)\b', '', 'g'), '\s+', ' ', 'g')), '')"


@query(f"SELECT doc_id, {_sql_index_street('s')} AS street FROM (SELECT doc_id, 'Av. {ODD_FOLDED}' || {_sql_fold(_SQL_TEXT)} || ' do Jd' AS s FROM documents)")
def norm_street_index(spark, d):
    return t(spark, d, "documents").select("doc_id", index_street(F.concat(F.lit(f"Av. {ODD}"), _text(), F.lit(" do Jd"))).alias("street"))


@query(rf"SELECT doc_id, nullif(regexp_replace(trim(upper(s)), '\s+', ' ', 'g'), '') AS city FROM (SELECT doc_id, '{ODD_FOLDED}' || {_sql_fold(_SQL_TEXT)} AS s FROM documents)")
def norm_city(spark, d):
    return t(spark, d, "documents").select("doc_id", index_city(F.concat(F.lit(ODD), _text())).alias("city"))


@query(f"SELECT doc_id, '{ODD_FOLDED}' || {_sql_fold('text')} AS folded FROM documents")
def fold_ascii(spark, d):
    return t(spark, d, "documents").select("doc_id", fold(F.concat(F.lit(ODD), F.col("text"))).alias("folded"))


NUMBERS = ["12", " 7b", "S/N", "sn", "0", "", "00", "KM 5", "SEM NUMERO", "123A"]
_SQL_NUMBER = "[" + ", ".join(repr(x) for x in NUMBERS) + ", NULL]"


@query(f"""SELECT p_partkey, CASE WHEN upper(trim(x)) IN ('S/N', 'SN', 'S N', '0', '') THEN NULL ELSE regexp_extract(trim(x), '^[0-9]+') END AS poi,
 CASE WHEN upper(trim(x)) IN ('S/N', 'SN', 'S N', 'SEM NUMERO', 'SEM NÚMERO', '0', '', 'N/A', 'S') THEN NULL ELSE nullif(regexp_extract(upper(trim(x)), '^[0-9]+'), '') END AS idx
 FROM (SELECT p_partkey, ({_SQL_NUMBER})[(p_partkey % 11) + 1] AS x FROM part)""")
def norm_num(spark, d):
    x = F.get(F.lit(NUMBERS), F.pmod("p_partkey", F.lit(11)).cast("int"))
    return t(spark, d, "part").select("p_partkey", poi_number(x).alias("poi"), index_number(x).alias("idx"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(upper(trim(s)), '\s*\([^)]*\)\s*', '', 'g'), '\s+(DE|DA|DO|DAS|DOS|E)\s+', ' ', 'g'), '\s+', ' ', 'g') AS district,
 regexp_replace(regexp_replace(coalesce(upper(s), ''), '\s*\([^)]*\)\s*', '', 'g'), '\s+', ' ', 'g') AS suburb
 FROM (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN lang || ' de e (Zona Norte) ' || source || ' da ' || lang END AS s FROM documents)""")
def bairro_clean(spark, d):
    s = F.when(F.col("doc_id") % 7 != 0, F.concat("lang", F.lit(" de e (Zona Norte) "), "source", F.lit(" da "), "lang"))
    return t(spark, d, "documents").select("doc_id", poi_district(s).alias("district"), suburb_clean(F.upper(s)).alias("suburb"))


@query("""SELECT c_custkey, lpad(regexp_replace(x, '[^0-9]', '', 'g'), 8, '0') AS cut,
 CASE WHEN length(coalesce(regexp_replace(x, '[^0-9]', '', 'g'), '')) <= 8 THEN lpad(coalesce(regexp_replace(x, '[^0-9]', '', 'g'), ''), 8, '0') END AS strict
 FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN substr(c_name, 10 - CAST(c_custkey % 4 AS INT)) || '-' || (c_custkey % 1000) END AS x FROM customer)""")
def cep_keys(spark, d):
    x = F.when(F.col("c_custkey") % 9 != 0, F.concat(F.expr("substr(c_name, cast(10 - c_custkey % 4 as int))"), F.lit("-"), (F.col("c_custkey") % 1000).cast("string")))
    return t(spark, d, "customer").select("c_custkey", cep_key(x).alias("cut"), cep_key_strict(x).alias("strict"))


# --- similarity and layered matching --------------------------------------------------


@query("""SELECT a.p_partkey AS a, b.p_partkey AS b, round(jaro_winkler_similarity(a.p_name, b.p_name), 6) AS score
 FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey WHERE jaro_winkler_similarity(a.p_name, b.p_name) >= 0.8""")
def jw_pairs(spark, d):
    return match.similar_pairs(t(spark, d, "part"), "p_partkey", ["p_brand", "p_size"], "p_name", 0.8).withColumn("score", r6(F.col("score")))


#: Parts as points of interest: brand for postcode, size for number, name for street, type for city.
_SQL_POI = """SELECT p_partkey AS cnpj, p_brand AS cep_norm, CASE WHEN p_size % 10 <> 0 THEN CAST(p_size AS VARCHAR) END AS num_norm,
 CASE WHEN p_partkey % 17 <> 0 THEN upper(p_name) END AS street_norm, upper(p_type) AS city_norm, CASE WHEN p_partkey % 5 <> 0 THEN upper(p_name) || ' ' || p_brand END AS bairro_norm FROM part"""
#: Address points: altered names, other postcodes, repeated addresses.
_SQL_IDX = """SELECT CASE WHEN p_partkey % 3 = 0 THEN 'other' ELSE p_brand END AS cep_norm, CAST(p_size AS VARCHAR) AS num_norm,
 CASE WHEN p_partkey % 4 = 0 THEN replace(upper(p_name), 'E', 'X') WHEN p_partkey % 4 = 1 THEN substr(upper(p_name), 1, length(p_name) - 1) ELSE upper(p_name) END AS street_norm,
 upper(p_type) AS city_norm, CASE WHEN p_partkey % 6 <> 0 THEN upper(p_name) || ' (X) ' || p_brand ELSE '' END AS suburb_norm,
 CAST(p_partkey % 180 AS DOUBLE) - 90 + k / 64.0 AS lat, CAST(p_partkey % 360 AS DOUBLE) - 180 AS lon FROM part, (VALUES (0), (1)) AS twice(k) WHERE k = 0 OR p_partkey % 8 = 2"""


def _sides(spark, d) -> tuple[DataFrame, DataFrame]:
    p = t(spark, d, "part").withColumn("n", F.upper("p_name"))
    k, key = F.col("p_partkey"), lambda m: F.col("p_partkey") % m
    pois = p.select(
        k.alias("cnpj"), F.col("p_brand").alias("cep_norm"), F.when(F.col("p_size") % 10 != 0, F.col("p_size").cast("string")).alias("num_norm"), F.when(key(17) != 0, F.col("n")).alias("street_norm"),
        F.upper("p_type").alias("city_norm"), F.when(key(5) != 0, F.concat("n", F.lit(" "), "p_brand")).alias("bairro_norm"),
    )
    twice = p.withColumn("k", F.explode(F.when(key(8) == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    street = F.when(key(4) == 0, F.replace("n", F.lit("E"), F.lit("X"))).when(key(4) == 1, F.expr("substr(n, 1, length(n) - 1)")).otherwise(F.col("n"))
    index = twice.select(
        F.when(key(3) == 0, "other").otherwise(F.col("p_brand")).alias("cep_norm"), F.col("p_size").cast("string").alias("num_norm"), street.alias("street_norm"), F.upper("p_type").alias("city_norm"),
        F.when(key(6) != 0, F.concat("n", F.lit(" (X) "), "p_brand")).otherwise("").alias("suburb_norm"), (key(180).cast("double") - 90 + F.col("k") / 64).alias("lat"), (key(360).cast("double") - 180).alias("lon"),
    )
    return pois, index


_SQL_SIDES = rf"""WITH p AS ({_SQL_POI}), a AS (SELECT *, regexp_replace(regexp_replace(coalesce(suburb_norm, ''), '\s*\([^)]*\)\s*', '', 'g'), '\s+', ' ', 'g') AS suburb_clean FROM ({_SQL_IDX}))"""
_SQL_L1 = """SELECT DISTINCT ON (p.cnpj) p.cnpj, a.lat, a.lon, 'apt_cep_num_street' AS geo_precision FROM p JOIN a ON p.cep_norm = a.cep_norm AND p.num_norm = a.num_norm
 WHERE jaro_winkler_similarity(p.street_norm, a.street_norm) >= 0.9 ORDER BY p.cnpj, jaro_winkler_similarity(p.street_norm, a.street_norm) DESC, a.lat, a.lon"""
_NEAR = "CASE WHEN length(p.bairro_norm) > 0 AND length(a.suburb_clean) > 0 AND jaro_winkler_similarity(p.bairro_norm, a.suburb_clean) >= 0.8 THEN 1 ELSE 0 END"


def _sql_l3(where: str = "") -> str:
    return f"""SELECT DISTINCT ON (cnpj) cnpj, lat, lon, 'apt_street_exact' AS geo_precision FROM (
 SELECT p.cnpj, a.lat, a.lon, {_NEAR} AS near, count(*) OVER (PARTITION BY p.cnpj) AS n, sum({_NEAR}) OVER (PARTITION BY p.cnpj) AS m
 FROM p JOIN a ON p.street_norm = a.street_norm AND p.num_norm = a.num_norm AND p.city_norm = a.city_norm {where}) WHERE n = 1 OR m = 1 ORDER BY cnpj, near DESC, lat, lon"""


def _sql_l4(where: str = "") -> str:
    return f"""SELECT DISTINCT ON (p.cnpj) p.cnpj, a.lat, a.lon, 'apt_fuzzy' AS geo_precision FROM p JOIN a ON p.city_norm = a.city_norm AND p.num_norm = a.num_norm
 AND (p.bairro_norm IS NULL OR length(a.suburb_clean) = 0 OR jaro_winkler_similarity(p.bairro_norm, a.suburb_clean) >= 0.8)
 WHERE jaro_winkler_similarity(p.street_norm, a.street_norm) >= 0.85 {where} ORDER BY p.cnpj, jaro_winkler_similarity(p.street_norm, a.street_norm) DESC, a.lat, a.lon"""


@query(f"{_SQL_SIDES} {_SQL_L1}")
def layer1_top1(spark, d):
    return match.layer1(*_sides(spark, d))


@query(f"{_SQL_SIDES} SELECT p.cnpj, min(a.lat) AS lat, min(a.lon) AS lon, 'apt_cep_num' AS geo_precision FROM p JOIN a ON p.cep_norm = a.cep_norm AND p.num_norm = a.num_norm GROUP BY p.cnpj HAVING count(*) = 1")
def layer2_unique(spark, d):
    return match.layer2(*_sides(spark, d))


@query(f"{_SQL_SIDES} {_sql_l3()}")
def layer3_unique(spark, d):
    return match.layer3(*_sides(spark, d))


@query(f"{_SQL_SIDES} {_sql_l4()}")
def layer4_fuzzy(spark, d):
    return match.layer4(*_sides(spark, d))


_SQL_CASCADE = f"""{_SQL_SIDES}, l1 AS ({_SQL_L1}), l3 AS ({_sql_l3('WHERE NOT EXISTS (SELECT 1 FROM l1 WHERE l1.cnpj = p.cnpj)')}),
 l4 AS ({_sql_l4('AND NOT EXISTS (SELECT 1 FROM l1 WHERE l1.cnpj = p.cnpj) AND NOT EXISTS (SELECT 1 FROM l3 WHERE l3.cnpj = p.cnpj)')}),
 found AS (SELECT * FROM l1 UNION ALL SELECT * FROM l3 UNION ALL SELECT * FROM l4)"""


@query(f"{_SQL_CASCADE} SELECT cnpj, lat, lon, geo_precision FROM found")
def cascade(spark, d):
    return match.cascade(*_sides(spark, d), fuzzy=True)


@query(f"{_SQL_CASCADE}, g AS (SELECT coalesce(geo_precision, 'none') AS geo_precision, count(*) AS n FROM p LEFT JOIN found USING (cnpj) GROUP BY 1) SELECT geo_precision, n, round(100.0 * n / sum(n) OVER (), 6) AS percent FROM g")
def precision_summary(spark, d):
    pois, index = _sides(spark, d)
    out = match.summary(match.located(pois, match.cascade(pois, index, fuzzy=True)))
    return out.withColumn("percent", r6(F.col("percent")))


@query(f"""{_SQL_SIDES}, l1 AS ({_SQL_L1}), k AS (SELECT cep_norm, num_norm, street_norm, min(struct_pack(lat := lat, lon := lon)) AS at FROM p JOIN l1 USING (cnpj) GROUP BY ALL),
 q AS (SELECT * FROM p UNION ALL SELECT -cnpj AS cnpj, cep_norm, num_norm, street_norm, city_norm, bairro_norm FROM p)
 SELECT q.cnpj, k.at.lat AS lat, k.at.lon AS lon FROM q JOIN k USING (cep_norm, num_norm, street_norm) WHERE q.cnpj NOT IN (SELECT cnpj FROM l1)""")
def same_address(spark, d):
    pois, index = _sides(spark, d)
    twins = pois.unionByName(pois.withColumn("cnpj", -F.col("cnpj")))
    return match.propagate(twins, saved(match.layer1(pois, index), "matched"))  # it is read more than once


# --- geocoding ------------------------------------------------------------------------

_SQL_AT = "SELECT c_custkey, c_nationkey, CAST(c_custkey % 170 AS DOUBLE) - 85 AS lat, CAST(c_custkey % 350 AS DOUBLE) - 175 AS lon FROM customer"


def _at(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return t(spark, d, "customer").select("c_custkey", "c_nationkey", ((k % 170).cast("double") - 85).alias("lat"), ((k % 350).cast("double") - 175).alias("lon"))


def _sql_haversine(a: str, b: str, c: str, e: str) -> str:
    return f"2 * 6371000.0 * asin(sqrt(least(1.0, greatest(0.0, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({e} - {b}) / 2), 2)))))"


@query(f"SELECT c_custkey, round({_sql_haversine('lat', 'lon', '-23.55', '-46.63')}, 3) AS metres FROM ({_SQL_AT})")
def haversine(spark, d):
    return _at(spark, d).select("c_custkey", F.round(haversine_m(F.col("lat"), F.col("lon"), F.lit(-23.55), F.lit(-46.63)), 3).alias("metres"))


@query(f"""WITH x AS ({_SQL_AT}), c AS (SELECT c_nationkey, avg(lat) AS la, avg(lon) AS lo FROM x GROUP BY 1)
 SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 'none' WHEN {_sql_haversine('lat', 'lon', 'la', 'lo')} <= 4000000 THEN 'municipio_centroid' ELSE 'cep' END AS geo_precision FROM x JOIN c USING (c_nationkey)""")
def centroid_flag(spark, d):
    x = _at(spark, d).withColumn("geo_precision", F.when(F.col("c_custkey") % 6 == 0, "none").otherwise("cep"))
    centres = x.groupBy("c_nationkey").agg(F.avg("lat").alias("lat_centro"), F.avg("lon").alias("lon_centro"))
    return geocode.flag_centres(x, centres, "c_nationkey", 4_000_000.0).select("c_custkey", "geo_precision")


@query(f"""SELECT c_custkey, CASE WHEN use THEN TRY_CAST(la AS DOUBLE) ELSE lat END AS lat, CASE WHEN use THEN 0.5 ELSE lon END AS lon, CASE WHEN use THEN 'tomtom_street' ELSE p END AS geo_precision
 FROM (SELECT x.*, y.la, p IN ('none', 'municipio_centroid') AND y.la IS NOT NULL AS use FROM (SELECT *, ['cep', 'none', 'municipio_centroid'][c_custkey % 3 + 1] AS p FROM ({_SQL_AT})) x
 LEFT JOIN (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'bad' ELSE CAST(c_custkey % 90 AS VARCHAR) END AS la FROM customer WHERE c_custkey % 5 <> 0) y ON c_custkey = k)""")
def masked_update(spark, d):
    k = F.col("c_custkey")
    x = _at(spark, d).withColumn("geo_precision", F.get(F.lit(["cep", "none", "municipio_centroid"]), (k % 3).cast("int")))
    lat = F.when(k % 4 == 0, None).when(k % 4 == 1, "bad").otherwise((k % 90).cast("string"))
    found = t(spark, d, "customer").where("c_custkey % 5 != 0").select("c_custkey", lat.alias("lat"), F.lit("0.5").alias("lon"), F.lit("tomtom_street").alias("geo_precision"))
    return geocode.merge_fallback(x, found, "c_custkey").select("c_custkey", "lat", "lon", "geo_precision")


@query("""SELECT o_orderkey, c.lat, c.lon, CASE WHEN c.k IS NULL THEN 'pending' WHEN c.lat IS NULL THEN 'none' ELSE 'cep' END AS geo_precision
 FROM orders LEFT JOIN (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS k, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 90 AS DOUBLE) END AS lat, CASE WHEN c_custkey % 4 <> 0 THEN 1.0::DOUBLE END AS lon FROM customer WHERE c_custkey % 3 <> 0) c
 ON lpad(regexp_replace(CAST(o_custkey AS VARCHAR) || '-', '[^0-9]', '', 'g'), 8, '0') = c.k""")
def three_state(spark, d):
    k, some = F.col("c_custkey"), F.col("c_custkey") % 4 != 0
    cache = t(spark, d, "customer").where("c_custkey % 3 != 0").select(k.cast("string").alias("cep"), F.when(some, (k % 90).cast("double")).alias("lat"), F.when(some, 1.0).alias("lon"))
    pois = t(spark, d, "orders").select("o_orderkey", F.concat(F.col("o_custkey").cast("string"), F.lit("-")).alias("cep"))
    return geocode.three_state(pois, cache).drop("cep")


@query("""SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cep FROM orders WHERE o_custkey % 3 <> 0""")
def missing_keys(spark, d):
    cache = t(spark, d, "customer").where("c_custkey % 3 = 0").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("cep"))
    return geocode.missing_keys(t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("cep")), cache)


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""")
def json_extract(spark, d):
    return t(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("double").alias("k"))


_BODIES = """CASE event_id % 4 WHEN 0 THEN '{"results":[]}' WHEN 1 THEN '{"results":[{"type":"Street","position":{"lat":' || event_id || ',"lon":-1.5}}]}'
 WHEN 2 THEN '{"results":[{"type":"Moon","position":{"lat":1,"lon":2}}]}' ELSE '{}' END"""


@query(f"""SELECT event_id, TRY_CAST(json_extract_string(b, '$.results[0].position.lat') AS DOUBLE) AS lat, CASE event_id % 4 WHEN 1 THEN 'tomtom_street' WHEN 2 THEN 'tomtom_unknown' ELSE 'none' END AS geo_precision
 FROM (SELECT event_id, {_BODIES} AS b FROM events)""")
def label_map(spark, d):
    at = geocode.parse_structured(F.expr(_BODIES.replace("event_id ||", "cast(event_id as string) ||")))
    return t(spark, d, "events").select("event_id", at.alias("x")).select("event_id", "x.lat", "x.geo_precision")


@query("""SELECT c_custkey, coalesce(nullif(trim(a), ''), '') || CASE WHEN trim(a) <> '' AND trim(b) <> '' THEN ' ' ELSE '' END || coalesce(nullif(trim(b), ''), '') AS line
 FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN ' ' || c_mktsegment ELSE ' ' END AS a, CASE WHEN c_custkey % 4 <> 0 THEN c_name || ' ' ELSE '' END AS b FROM customer) WHERE trim(a) <> '' OR trim(b) <> ''""")
def address_line(spark, d):
    a = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit(" "), "c_mktsegment")).otherwise(" ")
    b = F.when(F.col("c_custkey") % 4 != 0, F.concat("c_name", F.lit(" "))).otherwise("")
    return t(spark, d, "customer").select("c_custkey", geocode.street_line(a, b).alias("line")).where("line is not null")


# --- validation -----------------------------------------------------------------------


@query("""SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def strata_counts(spark, d):
    return validate.strata(t(spark, d, "events"), "event_type", None)


def _allocated(spark, d, n: int = 101) -> dict[str, int]:
    rows = validate.strata(t(spark, d, "events"), "event_type", None).collect()  # a row for each stratum
    return validate.allocate({r.event_type: r.n for r in rows}, n)


#: Rounded shares of 101, trimmed or topped up from the largest stratum on.
_SQL_ALLOC = """WITH c AS (SELECT event_type, count(*) AS c FROM events GROUP BY 1), s AS (SELECT event_type, c, CAST(least(greatest(1, round_even(101.0 * c / sum(c) OVER (), 0)), c) AS BIGINT) AS s FROM c),
 o AS (SELECT *, sum(s) OVER () - 101 AS over, row_number() OVER (ORDER BY s DESC, c DESC, event_type) AS i, row_number() OVER (ORDER BY c DESC, event_type) AS j FROM s),
 alloc AS (SELECT event_type, CAST(CASE WHEN over > 0 AND i = 1 THEN s - over WHEN over < 0 AND j = 1 THEN s - over ELSE s END AS BIGINT) AS k FROM o)"""


@query(f"{_SQL_ALLOC} SELECT event_type, k FROM alloc")
def alloc_counts(spark, d):
    return spark.createDataFrame(sorted(_allocated(spark, d).items()), "event_type string, k long")


@query(f"{_SQL_ALLOC} SELECT event_id, event_type FROM (SELECT event_id, event_type, k, row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS r FROM events JOIN alloc USING (event_type)) WHERE r <= k")
def stratified_sample(spark, d):
    order = F.md5(F.col("event_id").cast("string").cast("binary"))
    return validate.sample(t(spark, d, "events"), _allocated(spark, d), "event_type", "event_id", order=order).select("event_id", "event_type")


def _distances(spark, d) -> DataFrame:
    e = t(spark, d, "events")
    error = F.when(F.col("event_id") % 11 == 0, "no_results").when(F.col("event_id") % 13 == 0, "timeout")
    return e.select("event_id", "event_type", F.when(error.isNull(), F.col("value") * (1 + F.col("event_id") % 60)).alias("distance_m"), error.alias("tt_error"))


_SQL_D = """SELECT event_id, event_type, CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN value * (1 + event_id % 60) END AS distance_m,
 CASE WHEN event_id % 11 = 0 THEN 'no_results' WHEN event_id % 13 = 0 THEN 'timeout' END AS tt_error FROM events"""


def _sql_stats(keys: str) -> str:
    at = ", ".join(f"round(list_sort(list(distance_m))[CAST(floor(0.{p} * count(*)) AS BIGINT) + 1], 6) AS p{p}" for p in (50, 90, 95, 99))
    return f"""SELECT {keys} count(*) AS n, round(avg(distance_m), 4) AS mean, round(stddev_pop(distance_m), 4) AS std, round(min(distance_m), 6) AS min, round(max(distance_m), 6) AS max,
 count(*) FILTER (distance_m < 50) AS below_50, count(*) FILTER (distance_m >= 5000) AS from_5000, {at} FROM ({_SQL_D}) WHERE distance_m IS NOT NULL"""


def _rounded(df: DataFrame) -> DataFrame:
    for c in ("min", "max", "p50", "p90", "p95", "p99"):
        df = df.withColumn(c, r6(F.col(c)))
    return df.withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


@query(_sql_stats(""))
def dist_stats(spark, d):
    return _rounded(validate.distance_stats(_distances(spark, d)))


@query(f"{_sql_stats('event_type,')} GROUP BY event_type UNION ALL {_sql_stats(chr(39) + 'ALL' + chr(39) + ' AS event_type,')}")
def layer_stats_all(spark, d):
    return _rounded(validate.distance_stats(_distances(spark, d), by=["event_type"], total="ALL"))


_SQL_B = "(0, '<50 m', 0.0, 50.0), (1, '50-200 m', 50.0, 200.0), (2, '200-500 m', 200.0, 500.0), (3, '500 m-1 km', 500.0, 1000.0), (4, '1-5 km', 1000.0, 5000.0), (5, '>5 km', 5000.0, 1e300)"


@query(f"""SELECT b.i AS bucket, b.l AS label, count(x.event_id) AS n, round(100.0 * count(x.event_id) / sum(count(x.event_id)) OVER (), 6) AS percent
 FROM (VALUES {_SQL_B}) AS b(i, l, lo, hi) LEFT JOIN ({_SQL_D}) x ON x.distance_m >= b.lo AND x.distance_m < b.hi GROUP BY 1, 2""")
def dist_buckets(spark, d):
    return validate.buckets(_distances(spark, d)).withColumn("percent", r6(F.col("percent")))


@query(f"SELECT event_type, count(*) AS n, round(avg(distance_m), 4) AS mean, round(stddev_pop(distance_m), 4) AS std FROM ({_SQL_D}) WHERE distance_m IS NOT NULL AND event_type IN ('click', 'view', 'purchase') GROUP BY 1")
def layer_means(spark, d):
    out = validate.layer_stats(_distances(spark, d), "event_type", layers=("click", "view", "purchase"))
    return out.withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


@query(f"SELECT count(*) AS n, count(distance_m) AS matched, round(100.0 * count(distance_m) / count(*), 6) AS match_rate, count(*) FILTER (tt_error = 'no_results') AS no_result, count(*) FILTER (tt_error <> 'no_results') AS errors FROM ({_SQL_D})")
def match_rate(spark, d):
    return validate.outcome(_distances(spark, d)).withColumn("match_rate", r6(F.col("match_rate")))


_LABELS = "['l1', 'l3', 'none']"
_SQL_OLD_NEW = f"SELECT event_id, ({_LABELS})[event_id % 3 + 1] AS old_precision, CASE WHEN event_id % 10 <> 0 THEN ({_LABELS})[event_id % 7 % 3 + 1] END AS new_precision FROM events"


@query(f"SELECT old_precision, coalesce(new_precision, 'none') AS new_precision, count(*) AS n FROM ({_SQL_OLD_NEW}) WHERE old_precision <> coalesce(new_precision, 'none') GROUP BY 1, 2")
def layer_moves(spark, d):
    k, labels = F.col("event_id"), F.lit(["l1", "l3", "none"])
    df = t(spark, d, "events").select(F.get(labels, (k % 3).cast("int")).alias("old_precision"), F.when(k % 10 != 0, F.get(labels, (k % 7 % 3).cast("int"))).alias("new_precision"))
    return validate.moves(df)


@query("""SELECT (SELECT count(*) FROM (SELECT event_id FROM events WHERE event_id % 2 = 0 EXCEPT SELECT event_id FROM events WHERE event_id % 3 = 0)) AS gained,
 (SELECT count(*) FROM (SELECT event_id FROM events WHERE event_id % 3 = 0 EXCEPT SELECT event_id FROM events WHERE event_id % 2 = 0)) AS dropped""")
def gained_dropped(spark, d):
    e = t(spark, d, "events").select("event_id")
    return validate.gained_dropped(e.where("event_id % 3 = 0"), e.where("event_id % 2 = 0"), "event_id")


@query(f"""SELECT c_custkey, round(n, 2) AS new_distance_m, round(n - 1000, 2) AS delta_m FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN {_sql_haversine('lat', 'lon', 'lat + 0.01', 'lon')} END AS n FROM ({_SQL_AT}))""")
def resample_delta(spark, d):
    x = _at(spark, d)
    old = x.select(F.col("c_custkey").alias("cnpj"), F.lit("apt_fuzzy").alias("old_precision"), F.lit(1000.0).alias("old_distance_m"), (F.col("lat") + 0.01).alias("ref_lat"), F.col("lon").alias("ref_lon"))
    new = x.where("c_custkey % 4 != 0").select(F.col("c_custkey").alias("cnpj"), "lat", "lon", F.lit("apt_street_exact").alias("geo_precision"))
    out = validate.compare(old, new)
    return out.select(F.col("cnpj").alias("c_custkey"), F.round("new_distance_m", 2).alias("new_distance_m"), F.round("delta_m", 2).alias("delta_m"))


@query("SELECT p_partkey, printf('%.1f', p_retailprice) AS metres, printf('%.7f', p_retailprice / 7) AS degrees FROM part")
def formatted(spark, d):
    df = t(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("metres"), (F.col("p_retailprice") / 7).alias("degrees"))
    return validate.coordinates_as_text(df, ["metres"], ["degrees"])


# --- outputs --------------------------------------------------------------------------


@query(f"""SELECT c_custkey, '{{"type":"Feature","geometry":' || CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE '{{"type":"Point","coordinates":[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']}}' END
 || ',"properties":{{"c_custkey":' || c_custkey || ',"c_nationkey":' || c_nationkey || '}}}}' AS feature FROM ({_SQL_AT})""")
def geojson_features(spark, d):
    df = _at(spark, d).withColumn("lat", F.when(F.col("c_custkey") % 3 != 0, F.col("lat")))
    return df.select("c_custkey", feature(df).alias("feature"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active, enriched rows by label and tag."""
    return star_enrich(spark, sf_dir)
