"""Quality rules: base counts and distribution divergence, DataFrame functions only.

Each document gets two histograms: characters by class, and the common words
of its language (with one bin for all other words).  A language's reference is
the sum of the histograms of all its documents that pass the base rules.  A
document fails if the Jensen-Shannon distance (base 2, 0 to 1) between its
histogram and its language's is above a limit.  Short texts scatter, so each
comparison has a minimum length, under which it isn't made.

A document whose language has no word list here is compared with the pooled
reference ``und`` of all such documents, with common words of every list.

Defined results: a null or empty text has no words, all counts 0 and fails the
base rules; a null language is ``und``; a histogram without a reference
(nothing passed the base rules) is not compared; repeated rows count each.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, pick, stored, table

MIN_WORDS = 50
#: Percent of words in repeated 3-word windows above which the base rules fail.
MAX_REPEAT_PERCENT = 50
#: Limits of the distances as (least words, limit), the last that fits holds;
#: shorter texts aren't compared.
CHAR_LIMITS = ((50, 0.30), (150, 0.18))
WORD_LIMITS = ((100, 0.262),)

#: Common words of each language.
COMMON = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that for it as was with be by on not he his from".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au".split(),
}
UND = "und"
VOCABULARY = {**COMMON, UND: sorted({w for words in COMMON.values() for w in words[:8]})}
BINS = max(map(len, VOCABULARY.values())) + 1

#: Character classes in order; what no class takes is the last bin.
CLASSES = ("[a-z]", "[A-Z]", "[^\\x00-\\x7F]", "[0-9]", WS, "[.,;:!?'\"()-]")


def words_of(text: Column) -> Column:
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WS + "+"))


def matched(text: Column, cls: str) -> Column:
    """Characters of a text in a class."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, cls + "+", ""))).cast("long")


def placed(hashes: Column) -> Column:
    """Hashes with their places, in order of hash: equal ones are neighbours."""
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance of two histograms (arrays of counts of equal length)."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    share = lambda a: F.transform(a, lambda x: x / total(a))
    term = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)
    s = F.zip_with(share(p), share(q), lambda x, y: (term(x, y) + term(y, x)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), total(s)))


def vocabulary(key: Column) -> Column:
    """The common words of a language key, as an array."""
    out = F.lit(VOCABULARY[UND])
    for lang in COMMON:
        out = F.when(key == lang, F.lit(VOCABULARY[lang])).otherwise(out)
    return out


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts and both histograms of every row; reads each text once."""
    d = pick(df, doc_id=id_col, text=text_col, lang=lang_col)
    d = d.select("doc_id", F.coalesce("text", F.lit("")).alias("t"),
                 F.when(F.col("lang").isin(list(COMMON)), F.col("lang")).otherwise(UND).alias("key"))
    d = d.withColumn("w", words_of(F.col("t"))).withColumn("n", F.size("w"))
    d = d.withColumn("hs", F.when(F.col("n") >= 3, F.transform(
        F.sequence(F.lit(0), F.col("n") - 3),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).otherwise(F.array().cast("array<bigint>")))
    # only texts with an equal pair of windows are sorted
    d = d.withColumn("at", F.when(F.size(F.array_distinct("hs")) < F.size("hs"), placed(F.col("hs"))))
    hit = F.filter("at", lambda x, j: x["h"].eqNullSafe(F.get("at", j - 1)["h"]) | x["h"].eqNullSafe(F.get("at", j + 1)["h"]))
    d = d.withColumn("hit", F.transform(hit, lambda x: x["i"]))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    d = d.withColumn("ls", lines).withColumn("vocab", vocabulary(F.col("key")))
    common = sorted({w for words in VOCABULARY.values() for w in words})
    d = d.withColumn("cw", F.concat(F.lit(" "), F.array_join(F.filter("w", lambda x: x.isin(common)), "  "), F.lit(" ")))
    counts = F.transform("vocab", lambda v: (
        (F.octet_length("cw") - F.octet_length(F.replace(F.col("cw"), F.concat(F.lit(" "), v, F.lit(" ")), F.lit("")))) / (F.octet_length(v) + 2)))
    taken = [matched(F.col("t"), c) for c in CLASSES]
    d = d.select(
        "doc_id", "key", F.col("n").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.char_length("t") - F.char_length(F.regexp_replace("t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.size(F.array_distinct(F.flatten(F.transform("hit", lambda p: F.array(p, p + 1, p + 2))))), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(*taken, F.char_length("t").cast("long")).alias("c"), counts.alias("k"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    chars = F.transform(F.slice("c", 1, len(CLASSES)), lambda x: x.cast("double"))
    rest = F.get("c", F.lit(len(CLASSES))).cast("double")
    return d.select(
        "doc_id", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.concat(chars, F.array(rest - total(chars))).alias("char_hist"),
        F.concat("k", F.array_repeat(F.lit(0.0), F.lit(BINS - 1) - F.size("k")), F.array(F.col("n_words") - total(F.col("k")))).alias("word_hist"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def references(rows: DataFrame) -> DataFrame:
    """Sums of the histograms by language key: at most one row for each word list."""
    sums = [F.sum(F.get(h, F.lit(i))).alias(f"{h}_{i}") for h, n in (("char_hist", len(CLASSES) + 1), ("word_hist", BINS)) for i in range(n)]
    g = rows.groupBy("key").agg(*sums)
    return g.select("key", F.array(*[f"char_hist_{i}" for i in range(len(CLASSES) + 1)]).alias("ref_chars"),
                    F.array(*[f"word_hist_{i}" for i in range(BINS)]).alias("ref_words"))


def limit(limits: tuple) -> Column:
    """The limit for a row's length, null below the least."""
    out = F.lit(None).cast("double")
    for least, most in limits:
        out = F.when(F.col("n_words") >= least, F.lit(most)).otherwise(out)
    return out


def compared(rows: DataFrame, ref: DataFrame) -> DataFrame:
    """Rows with their distances, null where no comparison is made."""
    near = rows.join(F.broadcast(ref), "key", "left")
    apart = lambda hist, ref, limits: F.when((F.col("n_words") >= limits[0][0]) & F.col(ref).isNotNull(), jensen_shannon(F.col(hist), F.col(ref)))
    return near.withColumns({"char_distance": apart("char_hist", "ref_chars", CHAR_LIMITS),
                             "word_distance": apart("word_hist", "ref_words", WORD_LIMITS)}).drop("ref_chars", "ref_words")


def within() -> Column:
    return (F.coalesce(F.col("char_distance") <= limit(CHAR_LIMITS), F.lit(True))
            & F.coalesce(F.col("word_distance") <= limit(WORD_LIMITS), F.lit(True)))


def judged(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts, distances (null where no comparison is made) and verdict."""
    rows = stored(measured(df, id_col, text_col, lang_col), "rule_rows")
    passed = rows.filter(~base_failed())
    ref = references(compared(passed, references(passed)).filter(within()))
    d = compared(rows, ref).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        "char_distance", "word_distance")
    return d.withColumn("kept", ~F.col("base_failed") & within())


def op1_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = judged(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))


def _sql_limit(limits: tuple) -> str:
    return "CASE " + " ".join(f"WHEN n_words >= {a} THEN {b}" for a, b in reversed(limits)) + " END"


def _sql_distances(name: str, where: str) -> str:
    """CTEs: reference over the rows that ``where`` takes, distances to it."""
    return f"""
q_{name} AS (SELECT key, kind, i, sum(x) / sum(sum(x)) OVER (PARTITION BY key, kind) AS q FROM h WHERE base_ok AND {where} GROUP BY key, kind, i),
d_{name} AS (SELECT doc_id, n_words, max(CASE WHEN kind = 'c' THEN dist END) AS c, max(CASE WHEN kind = 'w' THEN dist END) AS w
  FROM (SELECT doc_id, n_words, kind, sqrt(greatest(0.0, sum(
          (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))) AS dist
        FROM h JOIN q_{name} USING (key, kind, i)
        WHERE n_words >= CASE WHEN kind = 'c' THEN {CHAR_LIMITS[0][0]} ELSE {WORD_LIMITS[0][0]} END GROUP BY doc_id, n_words, kind) GROUP BY doc_id, n_words),
f_{name} AS (SELECT doc_id, c, w, coalesce(c <= {_sql_limit(CHAR_LIMITS)}, true) AND coalesce(w <= {_sql_limit(WORD_LIMITS)}, true) AS fits FROM d_{name})"""


def _sql_op1() -> str:
    quote = lambda v: "'" + v.replace("'", "''") + "'"
    vocab = "CASE key " + " ".join(f"WHEN {quote(k)} THEN [{', '.join(map(quote, v))}]" for k, v in VOCABULARY.items()) + " END"
    chars = ", ".join(f"length(t) - length(regexp_replace(t, {quote(c)}, '', 'g'))" for c in CLASSES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({', '.join(map(quote, COMMON))}) THEN lang ELSE '{UND}' END AS key FROM documents),
s AS (SELECT *, list_filter(regexp_split_to_array(t, '{WS}+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM s)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM
          (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM win) WHERE k > 1) GROUP BY doc_id),
m AS (SELECT doc_id, key, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(rep.n, 0) AS n_repeat_words, [{chars}] AS cs, length(t) AS nc,
        list_transform({vocab}, lambda v: len(list_filter(w, lambda x: x = v))) AS ks FROM s LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
bins AS (SELECT doc_id, key, n_words, NOT base_failed AS base_ok, 'c' AS kind, unnest(list_append(cs, nc - list_sum(cs))) AS x,
           unnest(range(1, len(cs) + 2)) AS i FROM b
         UNION ALL SELECT doc_id, key, n_words, NOT base_failed, 'w', unnest(list_append(ks, n_words - list_sum(ks))), unnest(range(1, len(ks) + 2)) FROM b),
h AS (SELECT *, x / nullif(sum(x) OVER (PARTITION BY doc_id, kind), 0) AS p FROM bins),
{_sql_distances('one', 'true').strip()},
{_sql_distances('two', 'doc_id NOT IN (SELECT doc_id FROM f_one WHERE NOT fits)').strip()}
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(fits, true) AS kept,
       round(f_two.c, 6) AS char_distance, round(f_two.w, 6) AS word_distance
FROM b LEFT JOIN f_two USING (doc_id)
"""


QUERIES = {"op1_divergence_rules": op1_divergence_rules}
SQL: dict[str, str] = {"op1_divergence_rules": _sql_op1()}
