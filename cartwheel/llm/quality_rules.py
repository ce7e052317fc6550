"""Operator 11, quality rules with risk-controlled thresholds (DataFrame only).

Each rule rejects a text whose measure exceeds a cutoff.  Cutoffs come from
labelled documents, per stratum and rule:

1. Labelled texts are split by md5 into a fit half and a holdout; equal texts
   of a stratum count once.
2. Holdout: a cutoff is certified if the exact binomial test rejects "it drops
   more than ``alpha / rules`` of the good texts", i.e. if P(Bin(good, alpha /
   rules) <= good texts dropped) <= ``delta / tests``.  ``tests`` counts every
   stratum, rule and cutoff tried (Bonferroni), so with probability
   ``1 - delta`` all certified cutoffs keep their limit at once, and the rules
   of a stratum together drop at most ``alpha`` of its good texts.
3. Fit half: of the certified cutoffs the one with the largest gain (share of
   bad texts dropped less ``PRICE`` times the share of good ones) is used, the
   highest one on ties; a rule without a gain isn't used.

The measures are integers, so a verdict never hangs on rounding.  Base rules
(too few words, too many repeated words) hold beside the thresholds; a base
failure never counts as a rejection by a threshold.

Defined cases: a null or empty text has no words, zero measures and fails the
base rules; a null stratum is a stratum of its own; a stratum with too few
labels to certify anything, or no labels at all, uses no threshold; labels of
unknown, null or repeated ids, or without a verdict, are ignored or count once
(good if any label says so); a null id is never labelled; an empty table gives
no rows; other columns, whatever their names, are ignored."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import table, written
from cartwheel.llm.registry import query
from cartwheel.session import bounded_broadcast

ALPHA, DELTA = 0.05, 0.05
PRICE = 5                      # a good text dropped weighs as much as five bad ones
STRATA_BROADCAST = 10_000      # strata whose cutoffs are broadcast; beyond, they are joined by a shuffle
WORD = r"[^\x20\x09-\x0D]+"

# measure -> cutoffs tried; all per thousand but word_length (hundredths of a character)
CUTOFFS = {
    "symbols": [5, 20, 50, 100, 200, 500],          # #*$%&|<> to a thousand words
    "dup_lines": [100, 200, 300, 400, 500, 700],    # to a thousand lines with a word
    "repeated": [25, 50, 100, 150],                 # words in repeated windows
    "same_words": [300, 400, 500, 600, 700, 800],   # words that occurred before
    "word_length": [580, 620, 660, 700, 750, 800],  # mean length
    "short_words": [210, 220, 230, 240, 250, 270],  # words to a thousand characters in words
}


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", window: int = 5) -> DataFrame:
    """One row per row of ``docs``: id, stratum, half, text_md5, n_words, word_chars,
    n_symbols, n_dup_lines, n_lines, n_repeat_words, n_distinct.

    Repeated windows are found by 64-bit hashes inside one text."""
    long = lambda c: c.cast("long")
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: x.rlike(WORD))
    base = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"), t.alias("t"))
    base = base.select("id", "stratum", F.md5(F.col("t").cast("binary")).alias("text_md5"),
                       F.regexp_extract_all("t", F.lit(WORD), 0).alias("w"), lines.alias("lines"),
                       long(F.regexp_count("t", F.lit("[#*$%&|<>]"))).alias("n_symbols"))
    n = F.size("w")
    # hashes of one word, then of runs of 1, 2, 4, ... words joined to runs of ``window``
    hashed = base.select("*", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    have, runs = 1, F.col("h")
    while have < window:
        step = min(have, window - have)
        ahead = F.greatest(F.size(runs) - step, F.lit(0))
        # the later run overlaps the earlier one where the window isn't a power of two
        runs = F.zip_with(F.slice(runs, 1, ahead), F.slice(runs, step + 1, ahead), lambda a, b: F.xxhash64(a, b))
        have += step
        hashed = hashed.withColumn("h", runs)
        runs = F.col("h")
    several = F.size(F.array_distinct("h")) < F.size("h")
    placed = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hashed = hashed.withColumn("s", F.when(several, placed))
    # neighbours in hash order that are equal both lie in a repeated window
    m = F.size("s") - 1
    twice = F.zip_with(F.slice("s", 1, m), F.slice("s", 2, m), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    at = F.sort_array(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull()))))
    covered = F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                          lambda a, i: F.struct((a["n"] + i + window - F.greatest(i, a["end"])).alias("n"), (i + window).alias("end")),
                          lambda a: a["n"])
    return hashed.select(
        "id", "stratum", F.when(F.col("text_md5") < "8", "fit").otherwise("holdout").alias("half"), "text_md5",
        long(n).alias("n_words"), long(F.length(F.array_join("w", ""))).alias("word_chars"), "n_symbols",
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), long(F.size("lines")).alias("n_lines"),
        long(F.when(F.col("s").isNull(), 0).otherwise(covered)).alias("n_repeat_words"),
        long(F.size(F.array_distinct("w"))).alias("n_distinct"))


def values() -> dict[str, Column]:
    """The measures that the cutoffs hold against, as integers."""
    c = F.col
    return {"symbols": F.expr("1000 * n_symbols div n_words"), "dup_lines": F.expr("1000 * n_dup_lines div n_lines"),
            "repeated": F.expr("1000 * n_repeat_words div n_words"),
            "same_words": F.expr("1000 * (n_words - n_distinct) div n_words"),
            "word_length": F.expr("100 * word_chars div n_words"), "short_words": F.expr("1000 * n_words div word_chars")}


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _log_factorial(n: Column) -> Column:
    """Exact up to 20, then the Stirling series (error below 1e-12)."""
    x = n.cast("double")
    series = ((x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi)
              + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x))
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) where k lies below the mean; 1 elsewhere.

    Terms are added downwards from k.  They fall faster than a normal density,
    so those beyond twelve standard deviations are below double precision."""
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    terms = F.least(k, F.ceil(12 * F.sqrt(n * p)) + 100)
    falling = F.aggregate(
        F.when(terms > 0, F.sequence(F.lit(0).cast("long"), terms - 1)).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, j: F.struct((a["term"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("term"),
                              (a["sum"] + a["term"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("sum")),
        lambda a: a["sum"])
    return F.when((n > 0) & (k < n * p), top * falling).otherwise(1.0)


def select_cutoffs(rows: DataFrame, labels: DataFrame, label_id: str = "doc_id", label_col: str = "quality",
                   alpha: float = ALPHA, delta: float = DELTA, cutoffs: dict[str, list[int]] = CUTOFFS) -> DataFrame:
    """One row per stratum and rule in use: stratum, rule, cutoff, and the counts
    behind it.  ``rows`` are ``measures``; a label above zero means good."""
    known = (labels.select(F.col(label_id).alias("id"), F.col(label_col).alias("y")).where("id is not null and y is not null")
             .groupBy("id").agg((F.max("y") > 0).alias("good")))
    texts = (rows.where(~base_failed()).join(known, "id")
             .groupBy("stratum", "half", "text_md5", *MEASURED).agg(F.max("good").alias("good")))
    cell = lambda half, good, cut=None: F.count_if(
        (F.col("half") == half) & (F.col("good") == good) & (F.lit(True) if cut is None else cut))
    wide = texts.select("stratum", "half", "good", *[v.alias(r) for r, v in values().items()])
    sums = [cell(h, g).alias(f"{h}_{g}") for h in ("fit", "holdout") for g in (True, False)]
    for r, own in cutoffs.items():
        sums += [cell(h, g, F.col(r) > c).alias(f"{h}_{g}_{r}_{c}") for c in own for h, g in (("fit", True), ("fit", False), ("holdout", True))]
    counts = wide.groupBy("stratum").agg(*sums)
    tried = F.explode(F.array(*[F.struct(
        F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"holdout_True_{r}_{c}").alias("dropped_good"),
        (F.col(f"fit_False_{r}_{c}") * F.col("fit_True") - PRICE * F.col(f"fit_True_{r}_{c}") * F.col("fit_False")).alias("gain"))
        for r, own in cutoffs.items() for c in own]))
    counts = written(counts)  # a row per stratum
    tests = counts.count() * sum(map(len, cutoffs.values()))
    p = binomial_tail(F.col("dropped_good"), F.col("good"), alpha / len(cutoffs))
    sure = (counts.select("stratum", F.col("holdout_True").alias("good"), tried.alias("x")).select("stratum", "good", "x.*")
            .withColumn("p_value", p).where(F.col("p_value") <= delta / max(1, tests)).where("gain > 0"))
    best = F.max_by(F.struct("cutoff", "good", "dropped_good", "p_value"), F.struct("gain", "cutoff"))
    return sure.groupBy("stratum", "rule").agg(best.alias("b")).select("stratum", "rule", "b.*")


MEASURED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_distinct"]


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          label_col: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per row of ``docs``: id, the measures, base_failed, rejected_by
    (rules whose cutoff is exceeded), kept."""
    rows = written(measures(docs, id_col, text_col, stratum_col))
    cuts = select_cutoffs(rows, labels, id_col, label_col, alpha, delta)
    by_stratum = cuts.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))
    by_stratum = bounded_broadcast(written(by_stratum.withColumnRenamed("stratum", "s")), STRATA_BROADCAST)
    # null-safe, and no longer than the rules
    over = F.array_compact(F.array(*[F.when(v > F.col("cuts")[r], F.lit(r)) for r, v in values().items()]))
    out = rows.join(by_stratum, F.col("stratum").eqNullSafe(F.col("s")), "left").withColumn("base_failed", base_failed())
    out = out.withColumn("rejected_by", F.when(F.col("base_failed") | F.col("cuts").isNull(), F.array().cast("array<string>")).otherwise(over))
    return out.select(F.col("id").alias(id_col), *MEASURED, "base_failed", "rejected_by",
                      (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"))


def _sql() -> str:
    """The query in DuckDB's SQL; the binomial terms come from its lgamma."""
    limit = ALPHA / len(CUTOFFS)
    value = {"symbols": "1000 * n_symbols // n_words", "dup_lines": "1000 * n_dup_lines // n_lines",
             "repeated": "1000 * n_repeat_words // n_words", "same_words": "1000 * (n_words - n_distinct) // n_words",
             "word_length": "100 * word_chars // n_words", "short_words": "1000 * n_words // word_chars"}
    rules = ", ".join(f"('{r}', {c})" for r, own in CUTOFFS.items() for c in own)
    measured = " UNION ALL ".join(f"SELECT rid, '{r}' AS rule, {v} AS v FROM m WHERE NOT base_failed" for r, v in value.items())
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, lang, t, regexp_extract_all(t, '{word}') AS w FROM d),
win AS (SELECT rid, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
        FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
rep AS (SELECT rid, count(DISTINCT j) AS n FROM
        (SELECT rid, unnest(range(i, i + 5)) AS j FROM
         (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1) GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT l) AS u FROM ln WHERE regexp_matches(l, '{word}') GROUP BY rid),
m0 AS (SELECT w.rid, doc_id, lang, md5(t) AS h, len(w) AS n_words, coalesce(length(list_aggregate(w, 'string_agg', '')), 0) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n - lines.u, 0) AS n_dup_lines,
         coalesce(lines.n, 0) AS n_lines, coalesce(rep.n, 0) AS n_repeat_words, len(list_distinct(w)) AS n_distinct
       FROM w LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m0),
v AS ({measured}),
y AS (SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
x AS (SELECT min(rid) AS rid, lang, h < '8' AS fit, bool_or(good) AS good FROM m JOIN y USING (doc_id) WHERE NOT base_failed GROUP BY lang, h),
r AS (SELECT * FROM (VALUES {rules}) AS r(rule, cutoff)),
n AS (SELECT lang, count(*) FILTER (fit AND good) AS fg, count(*) FILTER (fit AND NOT good) AS fb,
             count(*) FILTER (NOT fit AND good) AS hg FROM x GROUP BY lang),
c AS (SELECT lang, rule, cutoff, count(*) FILTER (fit AND good AND v > cutoff) AS fgr,
             count(*) FILTER (fit AND NOT good AND v > cutoff) AS fbr, count(*) FILTER (NOT fit AND good AND v > cutoff) AS k
      FROM x JOIN v USING (rid) JOIN r USING (rule) GROUP BY lang, rule, cutoff),
p AS (SELECT c.lang, rule, cutoff, fbr * fg - {PRICE} * fgr * fb AS gain,
             CASE WHEN k < hg * {limit!r} THEN
               list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(hg + 1) - lgamma(j + 1) - lgamma(hg - j + 1)
                                                                  + j * ln({limit!r}) + (hg - j) * ln(1 - {limit!r})))) ELSE 1 END AS p
      FROM c JOIN n ON c.lang IS NOT DISTINCT FROM n.lang),
used AS (SELECT lang, rule, max_by(cutoff, gain * 10000 + cutoff) AS cutoff FROM p
         WHERE gain > 0 AND p <= {DELTA!r} / ((SELECT count(*) FROM n) * {sum(map(len, CUTOFFS.values()))}) GROUP BY lang, rule),
bad AS (SELECT DISTINCT rid FROM m JOIN v USING (rid) JOIN used ON used.rule = v.rule AND used.lang IS NOT DISTINCT FROM m.lang
        WHERE v.v > used.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept FROM m"""


@query("op11_quality_rules", _sql())
def op11(spark, sf_dir):
    """Base counts and verdicts of all documents; thresholds from the labels, per language."""
    found = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
