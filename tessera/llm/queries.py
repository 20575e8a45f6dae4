"""One query for each operator of this subpackage, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contamination, is_contaminated

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark")).withColumn("contaminated", is_contaminated())
    return found.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        F.col("contamination.n_hit").alias("n_hit"),
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(F.transform("contamination.items", lambda i: i.cast("string"))), ","), 256).alias("items_sha256"),
        "contaminated",
    )


def held_out(doc_id: str = "doc_id"):
    """Rows that no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score, train

    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~held_out()))
    scored = docs.select("doc_id", held_out().alias("held_out"), score(model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sketches import edited, in_hex, resemblance, with_next, with_sketch

    docs = with_next(table(spark, sf_dir, "documents").select("doc_id", "text"), sketch=True)
    docs = docs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    docs = with_sketch(docs, F.col("edited"), "edited_sketch")
    return docs.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        in_hex(F.col("text_sketch")).alias("fingerprint"),
        in_hex(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("text_sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("text_sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import default_model, scan, written

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, default_model(docs))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(written(F.filter("spans", lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer(), end_id=2)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string")))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["license"]))), ",").alias("licenses"),
        F.array_join(spans, ",").alias("spans"),
        F.coalesce(F.aggregate("licenses", F.lit(0), lambda acc, x: acc + F.size(x["differences"])), F.lit(0)).cast("long").alias("n_differences"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import classes

    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).documents().select("doc_id", "size", "source_size", "target", "taken")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import removed

    return removed(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p + 1 : p + n], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(greatest(1, len(w) - 12))) AS p FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win
), dg AS (
  SELECT doc_id, n, p, array_to_string(w[p + 1 : p + n], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS p FROM dw, sizes WHERE len(w) >= n)
), hits AS (SELECT dg.doc_id, dg.p, dg.n, win.item_id FROM dg JOIN win ON dg.n = win.n AND dg.g = win.g
), n_hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id
), it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN n_hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

#: Payloads are grouped by their digests; base 32 is read off the digest's hexadecimal digits, five bits at a time.
OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha1(h) AS x FROM p),
k AS (SELECT n, x, max(page_id) AS keep FROM d GROUP BY n, x)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
FROM d JOIN k USING (n, x)
"""

#: Every 50-byte string, by its MD5, with the least document that it starts in, over hexadecimal digits, a few thousand at a time.
OP10_SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, j, substr(h, 4000 * j + 1, 4098) AS c FROM (SELECT doc_id, h, unnest(range((length(h) // 2 + 1950) // 2000)) AS j FROM t WHERE length(h) >= 100)),
w AS (SELECT doc_id, 2000 * j + p AS p, md5_number(substr(c, 2 * p + 1, 100)) AS g FROM (SELECT doc_id, j, c, unnest(range(length(c) // 2 - 49)) AS p FROM b)),
f AS (SELECT g, min(doc_id) AS first FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
c AS (SELECT doc_id, p FROM w JOIN f USING (g) WHERE first < doc_id),
r AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b
      FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run
            FROM (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM c))
      GROUP BY doc_id, run),
e AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
s AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM e JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM t LEFT JOIN s USING (doc_id)
"""

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_fingerprints": op3_fingerprints,
    "op4_secrets": op4_secrets,
    "op5_token_files": op5_token_files,
    "op6_licenses": op6_licenses,
    "op7_simhash": op7_simhash,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_repeats": op10_repeats,
}
ORACLE_SQL = {"op1_decontamination": OP1_SQL, "op8_warc": OP8_SQL, "op10_repeats": OP10_SQL}
