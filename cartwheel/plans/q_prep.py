"""Queries: feature preparation (F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import neighbours as N
from cartwheel.operators import prep, quality
from cartwheel.plans.catalog import query
from cartwheel.sources import tables as V

NUM2 = ["l_quantity", "l_extendedprice"]
NUM4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("f1_iqr_clip", """WITH q AS (SELECT quantile_cont(l_quantity, [0.25, 0.75]) AS a, quantile_cont(l_extendedprice, [0.25, 0.75]) AS b FROM lineitem)
SELECT least(greatest(l_quantity, a[1] - 1.5 * (a[2] - a[1])), a[2] + 1.5 * (a[2] - a[1])) AS l_quantity,
       round(least(greatest(l_extendedprice, b[1] - 0.5 * (b[2] - b[1])), b[2] + 0.5 * (b[2] - b[1])), 6) AS l_extendedprice
FROM lineitem, q""")
def q_f1(t):
    d = V.num(t).select(*NUM2)
    # DataFrame form for one column, the fitted MLlib-style estimator for the other
    d = prep.iqr_clip(d, prep.iqr_bounds(d, ["l_quantity"], 1.5), ["l_quantity"])
    m = prep.IqrClip(inputCols=["l_extendedprice"], lam=0.5).fit(V.num(t))
    return m.transform(d).select("l_quantity", F.round("l_extendedprice", 6).alias("l_extendedprice"))


@query("f2_impute_mean", """SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM numn)), 6) AS l_quantity,
  round(coalesce(l_extendedprice, (SELECT avg(l_extendedprice) FROM numn)), 6) AS l_extendedprice FROM numn""", ("numn",))
def q_f2(t):
    d = V.numn(t).select("l_orderkey", "l_linenumber", *NUM2)
    o = prep.impute(d, NUM2, "mean")
    return o.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in NUM2])


@query("f2_impute_median", """SELECT l_orderkey, l_linenumber, coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM numn)) AS l_quantity,
  round(coalesce(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.5) FROM numn)), 6) AS l_extendedprice FROM numn""", ("numn",))
def q_f2m(t):
    d = V.numn(t).select("l_orderkey", "l_linenumber", *NUM2)
    o = prep.impute(d, NUM2, "median")
    return o.select("l_orderkey", "l_linenumber", "l_quantity", F.round("l_extendedprice", 6).alias("l_extendedprice"))


@query("f3_impute_mode", """WITH m AS (SELECT l_quantity AS v FROM numn WHERE l_quantity IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
SELECT l_orderkey, l_linenumber, coalesce(l_quantity, (SELECT v FROM m)) AS l_quantity FROM numn""", ("numn",))
def q_f3(t):
    d = V.numn(t).select("l_orderkey", "l_linenumber", "l_quantity")
    return prep.impute(d, ["l_quantity"], "mode")


# the distance is taken on a projection of all dimensions but the target's
EMBN = """e AS (SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN NULL ELSE CAST(embedding[1] AS DOUBLE) END AS e0,
  {} AS e1, {} AS e2 FROM embeddings)""".format(*V.plane_sql("embedding[2:]"))


def _embn(t):
    e = t.embeddings
    x, y = V.plane(F.slice("embedding", F.lit(2), F.greatest(F.size("embedding") - 1, F.lit(0))))
    return e.select("vec_id", F.when(F.col("vec_id") % 5 == 0, F.lit(None)).otherwise(F.get("embedding", F.lit(0)).cast("double")).alias("e0"),
                    x.alias("e1"), y.alias("e2"))


@query("f4_impute_knn", f"""WITH {EMBN},
c AS (SELECT n.vec_id, d.vec_id AS did, d.e0 AS dv, sqrt(pow(n.e1 - d.e1, 2) + pow(n.e2 - d.e2, 2)) AS dist
      FROM e n, e d WHERE n.e0 IS NULL AND d.e0 IS NOT NULL),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, did) AS r FROM c) WHERE r <= 5),
f AS (SELECT vec_id, sum(dv / greatest(dist, 1e-12)) / sum(1 / greatest(dist, 1e-12)) AS fill, max(CASE WHEN dist = 0 THEN dv END) AS ex
      FROM top GROUP BY 1)
SELECT e.vec_id, round(coalesce(e.e0, f.ex, f.fill), 6) AS e0, round(e1, 6) AS e1, round(e2, 6) AS e2 FROM e LEFT JOIN f ON e.vec_id = f.vec_id""")
def q_f4(t):
    o = prep.impute_knn(_embn(t), "vec_id", "e0", ["e1", "e2"], k=5)
    return o.select("vec_id", *[F.round(c, 6).alias(c) for c in ("e0", "e1", "e2")])


# fixed values: features to fill and what they are divided by
CLF_KNN = {"n_chars": 1000.0, "n_words": 200.0, "mean_word_len": 1.0, "distinct_share": 0.1}


def _knn_columns_sql():
    """Each column of the documents' features from all pairs of rows."""
    cols = CLF_KNN
    null = ", ".join(f"CASE WHEN doc_id % {4 + i} = {i} THEN NULL ELSE {c} / {s!r} END AS {c}" for i, (c, s) in enumerate(cols.items()))
    ctes, joins, out = [], [], []
    for c in cols:
        rest = [o for o in cols if o != c]
        both = " + ".join(f"(a.{o} IS NOT NULL AND b.{o} IS NOT NULL)::INT" for o in rest)
        d2 = " + ".join(f"coalesce(pow(a.{o} - b.{o}, 2), 0)" for o in rest)
        ctes.append(f"""n_{c} AS (SELECT a.doc_id, b.{c} AS dv, sqrt(({d2}) * {len(rest)} / ({both})) AS dist, b.doc_id AS did FROM d a, d b
  WHERE a.{c} IS NULL AND b.{c} IS NOT NULL AND ({both}) > 0),
t_{c} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dist, did) AS r FROM n_{c}) WHERE r <= 5),
f_{c} AS (SELECT doc_id, coalesce(avg(dv) FILTER (dist = 0), sum(dv / greatest(dist, 1e-12)) / sum(1 / greatest(dist, 1e-12))) AS fill FROM t_{c} GROUP BY 1)""")
        joins.append(f"LEFT JOIN f_{c} ON f_{c}.doc_id = d.doc_id")
        out.append(f"round(coalesce(d.{c}, f_{c}.fill, (SELECT avg({c}) FROM d)), 6) AS {c}")
    return f"WITH d AS (SELECT doc_id, {null} FROM clf), " + ", ".join(ctes) + f" SELECT d.doc_id, {', '.join(out)} FROM d {' '.join(joins)}"


@query("f4_impute_knn_columns", _knn_columns_sql(), ("clf",))
def q_f4c(t):
    d = V.clf(t).select("doc_id", *[F.when(F.col("doc_id") % (4 + i) != i, F.col(c) / s).alias(c) for i, (c, s) in enumerate(CLF_KNN.items())])
    o = N.impute_knn_columns(d, "doc_id", list(CLF_KNN))
    return o.select("doc_id", *[F.round(c, 6).alias(c) for c in CLF_KNN])


@query("f5_min_max", """SELECT round((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 6) AS l_quantity,
  round((l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 6) AS l_extendedprice
FROM lineitem""")
def q_f5(t):
    return prep.min_max(V.num(t).select(*NUM2), NUM2).select(*[F.round(c, 6).alias(c) for c in NUM2])


@query("f6_standardize", """SELECT round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity,
  round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 6) AS l_extendedprice FROM lineitem""")
def q_f6(t):
    return prep.standardize(V.num(t).select(*NUM2), NUM2).select(*[F.round(c, 6).alias(c) for c in NUM2])


@query("f7_robust_scale", """WITH q AS (SELECT quantile_cont(l_quantity, [0.25, 0.5, 0.75]) AS a, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS b FROM lineitem)
SELECT round((l_quantity - a[2]) / (a[3] - a[1]), 6) AS l_quantity, round((l_extendedprice - b[2]) / (b[3] - b[1]), 6) AS l_extendedprice
FROM lineitem, q""")
def q_f7(t):
    return prep.robust_scale(V.num(t).select(*NUM2), NUM2).select(*[F.round(c, 6).alias(c) for c in NUM2])


CLF4 = ["n_chars", "n_words", "mean_word_len", "distinct_share"]


@query("f8_scale_mixed", """WITH s AS (SELECT skewness(n_chars) > 1 AS a, skewness(n_words) > 1 AS b, skewness(mean_word_len) > 1 AS c,
  skewness(distinct_share) > 1 AS d FROM clf)
SELECT (SELECT a FROM s) AS n_chars_skewed, (SELECT b FROM s) AS n_words_skewed, (SELECT c FROM s) AS mean_word_len_skewed,
  (SELECT d FROM s) AS distinct_share_skewed""", ("clf",))
def q_f8_flags(t):
    summ = quality.numeric_summary(V.clf(t), CLF4)
    flags = summ.select("column", (F.col("skew") > 1).alias("sk"))
    return flags.groupBy().pivot("column", CLF4).agg(F.first("sk")).toDF(*[f"{c}_skewed" for c in CLF4])


@query("f8_scale_mixed_values", """WITH l AS (SELECT doc_id, ln(1 + n_chars) AS n_chars, ln(1 + n_words) AS n_words, mean_word_len, distinct_share FROM clf),
q AS (SELECT quantile_cont(n_chars, [0.25, 0.5, 0.75]) AS a, quantile_cont(n_words, [0.25, 0.5, 0.75]) AS b,
             avg(mean_word_len) AS mc, stddev_pop(mean_word_len) AS sc, avg(distinct_share) AS md, stddev_pop(distinct_share) AS sd FROM l)
SELECT doc_id, round((n_chars - a[2]) / (a[3] - a[1]), 6) AS n_chars, round((n_words - b[2]) / (b[3] - b[1]), 6) AS n_words,
  round((mean_word_len - mc) / sc, 6) AS mean_word_len, round((distinct_share - md) / sd, 6) AS distinct_share FROM l, q""", ("clf",))
def q_f8(t):
    d = V.clf(t).select("doc_id", *CLF4)
    o = prep.scale_mixed(d, CLF4, ["n_chars", "n_words"])
    return o.select("doc_id", *[F.round(c, 6).alias(c) for c in CLF4])


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("f9_one_hot", "SELECT customer_id, " + ", ".join(
    f"CAST(customer_type = '{s}' AS INTEGER) AS customer_type_{s}" for s in SEGMENTS) + " FROM cust", ("cust",))
def q_f9(t):
    # vocabulary fitted on the customers with a positive balance (one row per
    # category reaches the driver); values outside it map to all zeros
    cats = [r[0] for r in V.cust(t).filter(F.col("x") > 0).select("customer_type").distinct().orderBy("customer_type").collect()]
    return prep.one_hot(V.cust(t).select("customer_id", "customer_type"), "customer_type", cats)


@query("f10_rare_bucket", """WITH c AS (SELECT source, count(*) AS n FROM clf WHERE quality = 1 GROUP BY 1), t AS (SELECT sum(n) AS tot FROM c),
m AS (SELECT source, CASE WHEN n / tot < 0.06 THEN '__rare__' ELSE source END AS code FROM c, t)
SELECT doc_id, coalesce(code, '__rare__') AS source FROM clf LEFT JOIN m ON clf.source = m.source""", ("clf",))
def q_f10(t):
    c = V.clf(t)
    return prep.rare_bucket(c.select("doc_id", "source"), "source", 0.06, fit_on=c.filter(F.col("quality") == 1))


@query("f12_class_weights", """WITH c AS (SELECT quality AS cls, count(*) AS n FROM clf GROUP BY 1)
SELECT cls, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight,
  round((SELECT n FROM c WHERE cls = 0) / (SELECT n FROM c WHERE cls = 1), 6) AS neg_pos_ratio FROM c""", ("clf",))
def q_f12(t):
    return prep.class_weights(V.clf(t), "quality")


RANKS = """r AS (SELECT id, feature, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS rk
  FROM (SELECT * FROM (SELECT row_number() OVER () AS id, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
        UNPIVOT (value FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax)))),
w AS (PIVOT r ON feature IN ('l_quantity', 'l_extendedprice', 'l_discount', 'l_tax') USING first(rk) GROUP BY id)"""


def _spearman_sql():
    pairs = [(a, b) for i, a in enumerate(NUM4) for b in NUM4[i + 1:]]
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS rho FROM w" for a, b in pairs)


@query("f13_spearman", f"WITH {RANKS} {_spearman_sql()}")
def q_f13(t):
    d = t.lineitem.select(F.monotonically_increasing_id().alias("_id"), *NUM4)
    return prep.spearman(d, NUM4, "_id")


@query("f14_centrality", f"""WITH {RANKS}, c AS ({_spearman_sql()})
SELECT feature, round(sum(abs(rho)), 6) AS centrality FROM (SELECT a AS feature, rho FROM c UNION ALL SELECT b, rho FROM c) GROUP BY 1""")
def q_f14(t):
    d = t.lineitem.select(F.monotonically_increasing_id().alias("_id"), *NUM4)
    return prep.centrality(prep.spearman(d, NUM4, "_id"))


# fixed values: the group of each number
GROUPS = {"l_quantity": "size", "l_extendedprice": "size", "l_discount": "rate", "l_tax": "rate"}


@query("f14_representatives", f"""WITH {RANKS}, c AS ({_spearman_sql()}),
z AS (SELECT feature, round(sum(abs(rho)), 6) AS centrality FROM (SELECT a AS feature, rho FROM c UNION ALL SELECT b, rho FROM c) GROUP BY 1),
g AS (SELECT * FROM (VALUES {", ".join(f"('{f}', '{g}')" for f, g in GROUPS.items())}) AS v(feature, grp))
SELECT grp AS "group", arg_max(feature, centrality) AS representative FROM (SELECT * FROM z JOIN g USING (feature) ORDER BY centrality DESC, feature) GROUP BY 1""")
def q_f14r(t):
    d = t.lineitem.select(F.monotonically_increasing_id().alias("_id"), *NUM4)
    groups = t.spark.createDataFrame(list(GROUPS.items()), "feature string, group string")
    return prep.pick_representatives(prep.centrality(prep.spearman(d, NUM4, "_id")), groups)
