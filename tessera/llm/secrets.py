"""Secret scans: patterns, and character Markov models; DataFrame functions only.

Strings of `least` or more key characters that no pattern covers are candidates. Two
first-order models of characters, of random strings and of ordinary identifiers, give each
the log-likelihood ratio of its transitions; those far enough on the random side are added
to the patterns' spans. The models are counted from made random strings and from the ordinary
strings of all documents; they are one table of 128 x 128 ratios, which travels as a literal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import below, let, running

#: The kinds of span and their patterns.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KEY = r"[A-Za-z0-9+/_=-]{16,}"
#: What the base spans cover.
SECRET = "|".join([ASSIGN.removesuffix("+)") + "{12,})", ACCESS, HEX])
KINDS = ("assign", "access", "hex", "random")

SPAN = "array<struct<start:int,end:int,kind:int,value:string>>"


def spans(text: Column, pattern: str, kind: int, value: int = 0, least: int = 1) -> Column:
    """The leftmost non-overlapping matches of `pattern`, none of them empty, as spans in code
    points; those whose group `value` is shorter than `least` are dropped.

    Positions are running sums of the lengths of the matches and of the pieces that split() leaves between them.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.arrays_zip(whole.alias("m"), F.split(text, pattern).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(value)).alias("v"))
    found = F.filter(found, lambda x: x["m"].isNotNull())  # split() leaves one piece more

    def placed(f: Column) -> Column:
        ends = running(F.transform(f, lambda x: F.char_length(x["gap"]) + F.char_length(x["m"])))
        one = lambda x, end: F.struct((end - F.char_length(x["m"])).alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["v"].alias("value"))
        return F.filter(F.zip_with(f, ends, one), lambda x: F.char_length(x["value"]) >= least)

    return F.when(text.rlike(pattern), let(found, placed)).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """The spans of the patterns, by start and then kind."""
    return F.array_sort(F.concat(spans(text, ASSIGN, 0, 2, 12), spans(text, ACCESS, 1), spans(text, HEX, 2)))


def _transitions(value: Column) -> Column:
    """Each character and the next one, as 128 times the first's code and the second's."""
    pairs = F.regexp_extract_all(value, F.lit("(?s)(?=(..))"), F.lit(1))
    return F.transform(pairs, lambda p: F.ascii(p) * 128 + F.ascii(F.substring(p, 2, 1)))


def _ratio(table: Column, value: Column) -> Column:
    """The sum of the table's ratios over the value's transitions."""
    return F.aggregate(_transitions(value), F.lit(0.0), lambda acc, p: acc + F.get(table, p))


def samples(docs: DataFrame, *, text: str = "text", made: int = 4096) -> DataFrame:
    """Labelled strings (value, label, n): 1 for random ones, made from SHA-256 digests in three
    alphabets; 0 for ordinary ones of all documents, n of each, and a few made ones: dates, numbers, rules.

    Ordinary are, outside the patterns, the words of six letters and more, the joints of names
    and paths of two such words, and all other strings of key characters that are too short
    for a candidate. Longer ones, but for words in lower case, aren't counted, as those that are
    random would make themselves ordinary.
    """
    spark = docs.sparkSession
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    base = F.base64(F.unhex(digest))
    one = lambda values, label: (F.explode(F.array(*values)).alias("value"), F.lit(label).alias("label"), F.lit(1).cast("long").alias("n"))
    random = spark.range(made).select(*one([F.substring(digest, 1, 40), F.translate(base, "=", ""), F.substring(F.translate(F.upper(base), "+/=", "QXZ"), 1, 20)], 1))
    i = F.col("id")
    date = [i % 45 + 1990, i % 12 + 1, i % 28 + 1, i % 24, i * 7 % 60, i * 13 % 60]
    ruled = [F.repeat(F.lit(c), 16) for c in "=-_+/"]
    plain = spark.range(made // 32).select(*one([F.format_string("%04d-%02d-%02d-%02d-%02d-%02d", *date), F.format_string("/%04d/%02d/%02d/", *date[:3]), F.format_string("_%d_%d-v%d", *date[3:]), *ruled], 0))
    free = F.regexp_replace(F.col(text), SECRET, " ")
    runs = docs.select(F.regexp_extract_all(free, F.lit("(?<![A-Za-z0-9])(?:[A-Za-z]{6,15}|[A-Z]?[a-z]{15,})(?![A-Za-z0-9])"), F.lit(0)).alias("w"), F.filter(F.regexp_extract_all(free, F.lit(KEY.replace("{16,}", "{2,}")), F.lit(0)), lambda x: (F.char_length(x) < 16) & ~x.rlike("^[A-Za-z]{6,}$")).alias("s"))
    last, first = (lambda x: F.substring(x, -1, 1)), (lambda i, n: F.substring(F.coalesce(F.get("w", i + 1), F.lit("id")), 1, n))
    sign = lambda i: F.get(F.array(*map(F.lit, "_-/=")), i % 8)
    joints = F.filter(F.transform("w", lambda x, i: F.when(i % 8 < 4, F.concat(last(x), sign(i), first(i, 1))).when(i % 8 < 6, F.concat(last(x), F.initcap(first(i, 2))))), lambda x: x.isNotNull())
    ordinary = runs.select(F.explode(F.concat("w", "s", joints)).alias("value"), F.lit(0).alias("label")).groupBy("value", "label").agg(F.count("*").alias("n"))
    return random.unionByName(plain).unionByName(ordinary)


def train(labelled: DataFrame, smooth: float = 0.5, back: float = 4.0) -> list[float]:
    """The 128 x 128 log-likelihood ratios of transitions, random over ordinary, from (value,
    label, n). Each model's transitions count `back` more, shared as its characters are, and
    each character `smooth` more."""
    value = F.regexp_replace("value", r"[^A-Za-z0-9+/_=-]", "")
    counts = labelled.select(value.alias("v"), "label", "n").where("char_length(v) > 1").select("label", "n", F.explode(_transitions(F.col("v"))).alias("p")).groupBy("label", "p").agg(F.sum("n").alias("n"))
    alphabet = [c for c in range(128) if chr(c).isalnum() or chr(c) in "+/_=-"]
    model = {y: [0.0] * (128 * 128) for y in (0, 1)}
    for r in counts.collect():  # 2 * 67 * 67 rows at most
        model[r.label][r.p] = float(r.n)
    share: dict[int, dict[tuple[int, int], float]] = {}
    for y, n in model.items():
        ends = {b: sum(n[a * 128 + b] for a in alphabet) + smooth for b in alphabet}
        whole = sum(ends.values())
        for a in alphabet:  # a character that is rarely left says little of its own; then the ends' overall shares hold
            left = sum(n[a * 128 + b] for b in alphabet) + back
            share.setdefault(y, {}).update({(a, b): (n[a * 128 + b] + back * ends[b] / whole) / left for b in alphabet})
    out = [0.0] * (128 * 128)
    for a, b in share[0]:
        out[a * 128 + b] = round(math.log(share[1][a, b] / share[0][a, b]), 4)
    return out


def scan(docs: DataFrame, ratios: list[float], *, text: str = "text", into: str = "spans", threshold: float = 12.0) -> DataFrame:
    """`docs` with all spans of each text, by start and then kind (an index of KINDS).

    A candidate is added if its ratios sum to `threshold` nats or more and no base span
    overlaps it. All steps take time in proportion to the text, but for a factor of the
    logarithm of its number of spans. Defined cases: null and empty texts have no spans; other
    columns stay, one named like `into` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")

    def added(x: Column) -> Column:
        """x: the base spans, and their starts and ends, each ascending. As many spans end before a free place as begin before its end."""
        free = lambda k: below(x["starts"], k["end"]) == below(x["ends"], k["start"], equal=True)
        return F.array_sort(F.concat(x["base"], F.filter(spans(whole, KEY, 3), lambda k: free(k) & (_ratio(table, k["value"]) >= threshold))))

    edges = lambda base: F.struct(base.alias("base"), F.transform(base, lambda b: b["start"]).alias("starts"), F.array_sort(F.transform(base, lambda b: b["end"])).alias("ends"))
    return docs.withColumn(into, let(let(base_spans(whole), edges), added))


def written(spans_: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.lit(list(KINDS))
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def default_model(docs: DataFrame, **columns) -> list[float]:
    return train(samples(docs, **columns))
