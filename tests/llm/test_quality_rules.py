"""Quality rules: base counts against plain Python, the binomial bound against
exact sums, certified cutoffs against brute force, and edge cases."""

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import functions as F

from cartwheel.llm import quality_rules as Q
from conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    rep = {j for i in range(len(words) - 4) if seen[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(lines), len(rep), len(set(words)))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "x", 3, "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, stratum string, id int, kept string")


def test_counts_match_plain_python(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    texts += [None, "", " \n ", "a", "a b c d e", "a b c d e a b c d e", "x " * 200, "a a a a a a", "x y   z 🙂🙂", "one\n\none\none \r\n#&#",
              "q" * 50_000, "a b c d e f " * 3_000]
    got = {r.id: r for r in Q.measures(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][c] for c in Q.MEASURED) == plain(t), (i, t and t[:50])
        assert got[i].half == ("fit" if hashlib.md5((t or "").encode()).hexdigest() < "8" else "holdout")


def test_binomial_tail_is_exact(spark):
    cases = [(k, n, p) for p in (0.05 / 6, 0.3) for n in (0, 1, 5, 20, 21, 40, 600, 3000) for k in (0, 1, 2, 7, 19, 24, 60, 150, 900) if k <= n]
    df = spark.createDataFrame([(k, n, p) for k, n, p in cases], "k long, n long, p double")
    for p in (0.05 / 6, 0.3):
        for r in df.where(F.col("p") == p).withColumn("t", Q.binomial_tail(F.col("k"), F.col("n"), p)).collect():
            want = math.fsum(math.comb(r.n, j) * p**j * (1 - p)**(r.n - j) for j in range(r.k + 1)) if r.n and r.k < r.n * p else 1.0
            assert abs(r.t - want) <= 1e-10 * want + 1e-200, (r, want)


def labelled(spark, n=24_000):
    """Two strata: symbols mark bad texts in one of them only; a third has few labels."""
    i = F.col("id")
    good = i % 4 != 0
    rare = F.pmod(F.xxhash64(i), F.lit(1000)) < 2  # good texts with many symbols
    symbols = F.when(~good & (i % 3 != 1), 60).when(good & rare, 40).otherwise(i % 2)
    rows = spark.range(n).select(
        "id", F.when(i % 3 == 0, "a").when(i % 3 == 1, "b").when(i < 300, "c").otherwise(None).alias("stratum"),
        F.when(F.pmod(F.xxhash64(i + 7), F.lit(2)) == 0, "fit").otherwise("holdout").alias("half"), F.md5(i.cast("string")).alias("text_md5"),
        F.lit(100).cast("long").alias("n_words"), F.lit(500).cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
        *[F.lit(v).cast("long").alias(c) for c, v in (("n_dup_lines", 0), ("n_lines", 5), ("n_repeat_words", 0), ("n_distinct", 90))])
    return rows, rows.select(F.col("id").alias("doc_id"), good.cast("int").alias("quality"))


def test_cutoffs_keep_the_risk(spark):
    rows, labels = labelled(spark)
    got = {(r.stratum, r.rule): r for r in Q.select_cutoffs(rows, labels).collect()}
    data = rows.join(labels, F.col("id") == F.col("doc_id")).collect()
    tests = 4 * sum(map(len, Q.CUTOFFS.values()))
    want = {}
    for s in {r.stratum for r in data}:
        own = [r for r in data if r.stratum == s]
        fit, hold = ([r for r in own if r.half == h] for h in ("fit", "holdout"))
        n, p = sum(r.quality for r in hold), Q.ALPHA / len(Q.CUTOFFS)
        for rule, value in (("symbols", lambda r: 1000 * r.n_symbols // 100), ("same_words", lambda r: 100), ("word_length", lambda r: 500)):
            ranked = []
            for c in Q.CUTOFFS[rule]:
                k = sum(r.quality and value(r) > c for r in hold)
                tail = math.fsum(math.comb(n, j) * p**j * (1 - p)**(n - j) for j in range(k + 1)) if n and k < n * p else 1
                bad, g = [r for r in fit if not r.quality], [r for r in fit if r.quality]
                gain = sum(value(r) > c for r in bad) * len(g) - Q.PRICE * sum(value(r) > c for r in g) * len(bad)
                if gain > 0 and tail <= Q.DELTA / tests:
                    ranked.append((gain, c))
            if ranked:
                want[s, rule] = max(ranked)[1]
    assert {k: r.cutoff for k, r in got.items()} == want and ("a", "symbols") in want and (None, "symbols") in want
    assert not any(s in ("b", "c") for s, _ in got)
    for r in got.values():
        assert r.dropped_good <= Q.ALPHA / len(Q.CUTOFFS) * r.good


def test_verdicts_and_edges(spark):
    """Thresholds act per stratum; without labels only the base rules hold."""
    word = F.concat(F.lit("w"), F.col("id").cast("string"))
    body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda j: F.concat(F.substring(F.md5(F.concat(word, j.cast("string"))), 1, 5))), " ")
    docs = spark.range(9_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, F.concat(body, F.lit(" # # $ $ % % & & | |"))).otherwise(body).alias("text"),
        F.when(F.col("id") % 2 == 0, "en").alias("lang"), F.lit(1).alias("s"), F.lit(2).alias("cuts"), F.lit(3).alias("n_words"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 4 != 0, 1).otherwise(0).alias("quality"), F.lit(0).alias("lang"))
    extra = spark.createDataFrame([(None, 1, 0), (5, None, 0), (10**9, 1, 0), (6, 1, 0)], "doc_id long, quality int, lang int")
    got = Q.judge(docs, labels.unionByName(extra)).where("not base_failed")
    assert got.where("doc_id % 4 = 0 and kept").count() == 0 and got.where("doc_id % 4 != 0 and not kept").count() == 0
    assert all("symbols" in r.rejected_by for r in got.where("not kept").select("rejected_by").distinct().collect())
    none = Q.judge(docs, labels.limit(0))
    assert none.where("kept = base_failed").count() == 0 and none.count() == 9_000
    assert Q.judge(docs.limit(0), labels).count() == 0
    plan = none._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
