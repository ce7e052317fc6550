"""Queries: models, clustering, scoring (M*), interpretability and rules (X*,
W14, A19, T4), model-side preparation (F11, F15) and persistence (S14, S15).

Model fits are not SQL-expressible: those queries are rows-checked (plus the
pytest invariants); everything derived deterministically carries a twin."""

from __future__ import annotations

import functools
import itertools
import math
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators import density as D
from cartwheel.operators import explain as X
from cartwheel.operators import extra_trees as E
from cartwheel.operators import models as M
from cartwheel.operators import guided as S
from cartwheel.operators import prep, splits, topk, windows
from cartwheel.operators import silhouette as SIL
from cartwheel.operators import trees as R
from cartwheel.plans.catalog import query
from cartwheel.plans.q_prep import NUM4, RANKS, _spearman_sql
from cartwheel.session import materialize, shared_path
from cartwheel.sources import io
from cartwheel.sources import tables as V

CLF4 = ["n_chars", "n_words", "mean_word_len", "distinct_share"]


def _clf_split(t):
    c = V.clf(t).withColumn("label", F.col("quality").cast("double"))
    s = splits.stratified_split(c, "label", 1 / 3, 42, "doc_id")
    s = prep.with_weight_col(s, "label")
    s = M.assemble(s, CLF4)
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


def _multi(t):
    e = t.embeddings.select("vec_id", F.col("label").cast("double").alias("label"),
                            array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    return prep.with_weight_col(e, "label")


# ------------------------------------------------------------------ M1-M4, M17, M18

@query("m1_fit_logreg")
def q_m1(t):
    tr, te = _clf_split(t)
    m = M.fit_logreg(tr, "label", "weight", regParam=0.01)
    return M.score(te, m, ["doc_id", "label"])


@query("m2_fit_forest")
def q_m2(t):
    tr, te = _clf_split(t)
    m = M.fit_forest(tr, "forest", "label", "weight", numTrees=30, maxDepth=5)
    return M.score(te, m, ["doc_id", "label"])


@query("m2_fit_tree")
def q_m2t(t):
    tr, te = _clf_split(t)
    return M.score(te, M.fit_forest(tr, "tree", "label", "weight", maxDepth=4), ["doc_id", "label"])


@query("m2_fit_extra_trees")
def q_m2e(t):
    tr, te = _clf_split(t)
    return M.score(te, M.fit_forest(tr, "extra_trees", "label", "weight", numTrees=30), ["doc_id", "label"])


def _extra_root_sql():
    """The first split of every tree: two drawn features, a drawn threshold each, the better gain."""
    u = lambda *k: f"('0x' || substr(md5({' || chr(124) || '.join(k)}), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
    long = " UNION ALL ".join(f"SELECT {i} AS f, {c}::DOUBLE AS x, quality FROM clf" for i, c in enumerate(CLF4))
    gini = lambda p, n: f"(2 * {p} / {n} * (1 - {p} / {n}))"
    return f"""WITH l AS ({long}), lim AS (SELECT f, min(x) AS lo, max(x) AS hi FROM l GROUP BY f),
tr AS (SELECT unnest(range(0, 12)) AS tree), pick AS (SELECT tree, f, lo, hi, row_number() OVER (PARTITION BY tree ORDER BY {u("'7'", "tree", "'1'", "f", "'pick'")}, f) AS rn FROM tr, lim),
cut AS (SELECT tree, f, lo + {u("'7'", "tree", "'1'", "f")} * (hi - lo) AS th FROM pick WHERE rn <= 2),
st AS (SELECT tree, cut.f, th, count(*) AS n, sum((quality = 1)::INT) AS p, count(*) FILTER (x <= th) AS nl, count(*) FILTER (x <= th AND quality = 1) AS pl
       FROM cut JOIN l ON l.f = cut.f GROUP BY tree, cut.f, th),
g AS (SELECT *, {gini("p", "n")} - (nl * {gini("pl", "nl")} + (n - nl) * {gini("(p - pl)", "(n - nl)")}) / n AS gain FROM st WHERE nl BETWEEN 1 AND n - 1)
SELECT tree, CAST(f AS INTEGER) AS feature, round(th, 6) AS threshold, n, nl AS n_left, round(gain, 6) AS gain FROM (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY gain DESC, f) AS rn FROM g WHERE gain > 1e-12) WHERE rn = 1"""


@query("m2_extra_trees_roots", _extra_root_sql(), ("clf",))
def q_m2r(t):
    """The first split of each of twelve extremely randomised trees."""
    nodes = E.fit_extra_trees(V.clf(t), CLF4, "quality", n_trees=12, max_depth=1)
    child = nodes.where("node = 2").select("tree", F.col("n").alias("n_left"))
    return nodes.where("node = 1 and left > 0").join(child, "tree").select(
        F.col("tree").cast("long").alias("tree"), "feature", F.round("threshold", 6).alias("threshold"), "n", "n_left", F.round("gain", 6).alias("gain"))


@query("m2_extra_trees_grown", "SELECT count(*) AS n_scored, true AS is_share, true AS children_add_up, true AS unlike_forest FROM clf", ("clf",))
def q_m2g(t):
    """Scores are shares, children hold their parent's rows, and no threshold is one that a forest finds."""
    c = materialize(V.clf(t).withColumn("label", F.col("quality").cast("double")))
    nodes = materialize(E.fit_extra_trees(c, CLF4, "label", n_trees=20, max_depth=4))
    kids = nodes.select("tree", F.expr("node div 2").cast("int").alias("node"), F.col("n").alias("c")).groupBy("tree", "node").agg(F.sum("c").alias("c"))
    whole = nodes.where("left > 0").join(kids, ["tree", "node"], "left").agg(F.every(F.col("n") == F.col("c")).alias("children_add_up"))
    forest = R.node_table(M.fit_forest(M.assemble(c, CLF4), "forest", numTrees=20, maxDepth=4), t.spark)
    same = nodes.where("left > 0").join(forest.select("feature", "threshold"), ["feature", "threshold"], "left_semi").agg((F.count("*") == 0).alias("unlike_forest"))
    s = E.score_trees(nodes, c, CLF4, ["doc_id"]).agg(F.count("*").alias("n_scored"), F.every(F.col("proba").between(0, 1.000000001)).alias("is_share"))
    return s.crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(same))  # one row each


@query("m3_fit_gbt")
def q_m3(t):
    tr, te = _clf_split(t)
    tr = tr.withColumn("is_valid", V.md5_bucket(F.col("doc_id"), 5, 5) == 0)
    m = M.fit_gbt(tr, "label", valid_col="is_valid", maxIter=20, maxDepth=3)
    return M.score(te, m, ["doc_id", "label"])


@query("m4_fit_multiclass")
def q_m4(t):
    e = _multi(t)
    m = M.fit_multiclass(e, "label", "weight", numTrees=20, maxDepth=6)
    return m.transform(e).select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"))


def _pipeline_model(t):
    c = V.clf(t).withColumn("label", F.col("quality").cast("double"))
    pre = prep.build_preprocess(CLF4, ["lang"], scaler="standard")
    lr = LogisticRegression(labelCol="label", featuresCol="features", maxIter=50, regParam=0.01)
    return Pipeline(stages=pre.getStages() + [lr]).fit(c), c


@query("m17_score")
def q_m17(t):
    m, c = _pipeline_model(t)
    return M.score(c, m, ["doc_id"])


@query("m18_calibrate")
def q_m18(t):
    m, c = _pipeline_model(t)
    s = M.score(c, m, ["doc_id", "label"])
    iso = M.calibrate(s, "label")
    return iso.transform(s.withColumn("score", F.col("proba").cast("double"))).select("doc_id", "proba", "calibrated")


@query("f11_build_preprocess")
def q_f11(t):
    c = V.clf(t)
    pm = prep.build_preprocess(CLF4, ["lang", "source"], scaler="robust").fit(c)
    return pm.transform(c).select("doc_id", vector_to_array("features").alias("features"))


def _f11_sql():
    q = {c: f"quantile_cont(v{i}, 0.5)" for i, c in enumerate(CLF4)}
    fill = ", ".join(f"coalesce(v{i}, (SELECT {q[c]} FROM d)) AS z{i}" for i, c in enumerate(CLF4))
    z = ", ".join(f"round((z{i} - avg(z{i}) OVER ()) / nullif(stddev_samp(z{i}) OVER (), 0), 6) AS {c}" for i, c in enumerate(CLF4))
    null = ", ".join(f"CASE WHEN doc_id % {5 + 2 * i} <> 0 THEN {c} END AS v{i}" for i, c in enumerate(CLF4))
    return f"""WITH d AS (SELECT doc_id, lang, source, {null} FROM clf),
k AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) AS place FROM d WHERE source IS NOT NULL GROUP BY source
      HAVING count(*) >= 0.08 * (SELECT count(*) FROM d)),
f AS (SELECT doc_id, source, {fill} FROM d)
SELECT doc_id, {z}, CAST(coalesce(place, (SELECT count(*) + 1 FROM k)) AS INTEGER) AS source_place FROM f LEFT JOIN k USING (source)"""


@query("f11_fitted_matrix", _f11_sql(), ("clf",))
def q_f11m(t):
    """Exact medians in place of missing numbers, standardised, and the place of the one-hot flag of ``source`` with its rare bucket."""
    c = V.clf(t)
    d = c.select("doc_id", "lang", "source", *[F.when(F.col("doc_id") % (5 + 2 * i) != 0, F.col(x)).alias(x) for i, x in enumerate(CLF4)])
    m = prep.build_preprocess(CLF4, ["source"], min_share=0.08).fit(d)
    path = shared_path(t.spark, f"f11_{uuid.uuid4().hex}")
    m.write().overwrite().save(path)  # the matrix is that of the loaded pipeline
    x = PipelineModel.load(path).transform(d).select("doc_id", vector_to_array("features").alias("x"))
    return x.select("doc_id", *[F.round(F.col("x")[i], 6).alias(n) for i, n in enumerate(CLF4)],
                    (F.array_position(F.slice("x", 5, F.size("x")), 1.0)).cast("int").alias("source_place"))


@query("f15_pca")
def q_f15(t):
    d, cols = V.emb_wide(t, "vec_id")
    out, _ = prep.pca(d, cols, k=3)
    return out.select("vec_id", vector_to_array("pca").alias("pca"))


@query("s14_save_load_model")
def q_s14(t):
    m, c = _pipeline_model(t)
    path = shared_path(t.spark, f"s14_model_{uuid.uuid4().hex}")
    M.save_model(m, path, {"features": ",".join(CLF4), "kind": "logreg"}, t.spark)
    loaded, meta = M.load_model(path, t.spark)
    return M.score(c, loaded, ["doc_id"]).crossJoin(F.broadcast(meta.filter(F.col("key") == "kind").select(F.col("value").alias("kind"))))


@query("s15_materialize_matrix")
def q_s15(t):
    tr, _ = _clf_split(t)
    path = shared_path(t.spark, f"s15_train_matrix_{uuid.uuid4().hex}")
    return io.materialize_matrix(tr.select("doc_id", "label", vector_to_array("features").alias("x")), path)


# ------------------------------------------------------------------ M5-M9

@query("m5_can_train", """SELECT count(DISTINCT quality) AS n_classes, count(DISTINCT quality) >= 2 AS can_train,
  CASE WHEN count(DISTINCT quality) >= 2 THEN 'ok' ELSE 'only one class present' END AS reason FROM clf
UNION ALL SELECT count(DISTINCT quality), count(DISTINCT quality) >= 2,
  CASE WHEN count(DISTINCT quality) >= 2 THEN 'ok' ELSE 'only one class present' END FROM clf WHERE quality = 1""", ("clf",))
def q_m5(t):
    c = V.clf(t)
    return M.can_train(c, "quality").unionByName(M.can_train(c.filter(F.col("quality") == 1), "quality"))


SPACE = {"regParam": (1e-4, 1.0, "log"), "elasticNetParam": (0.0, 1.0), "maxIter": (20, 80, "int")}


def _make_lr(p):
    return LogisticRegression(labelCol="label", featuresCol="features", weightCol="weight", **p)


@query("m6_search")
def q_m6(t):
    tr, te = _clf_split(t)
    return M.search(tr, te, _make_lr, SPACE, n=4, seed=3, label="label", objective="pr_auc", parallel=2)


def _three_parts(t):
    """TRAIN, VALID and TEST documents: md5 buckets 0-5, 6-7 and 8-9 of ten."""
    c = materialize(V.clf(t).withColumn("label", F.col("quality").cast("double")).withColumn("_b", V.md5_bucket(F.col("doc_id"), 21, 10)))
    return [c.where(F.col("_b").between(*x)).drop("_b") for x in ((0, 5), (6, 7), (8, 9))]


PARTS_SQL = """(SELECT CASE WHEN b < 6 THEN 'train' WHEN b < 8 THEN 'valid' ELSE 'test' END AS split, quality FROM
  (SELECT quality, ('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|21'), 1, 8))::BIGINT % 10 AS b FROM clf))"""


@query("m6_guided_search", "SELECT 6 AS n_trials, 0 AS n_failed, 10 AS n_params, true AS scored, true AS named_in_order", ())
def q_m6g(t):
    """Six trials in two rounds of random and guided draws, as the run log has them."""
    train, valid, _ = _three_parts(t)
    path = shared_path(t.spark, f"m6_runs_{uuid.uuid4().hex}")
    space = S.SPACE | {"maxIter": (3, 8, "int"), "maxDepth": (2, 4, "int")}
    S.guided_search(train, valid, CLF4, ["lang", "source"], "label", path, 4, space, parallel=4, startup=3)
    runs = S.guided_search(train, valid, CLF4, ["lang", "source"], "label", path, 2, space, parallel=2, startup=3)
    return runs.agg(F.count("*").alias("n_trials"), F.count("artifact").alias("n_failed"), F.max(F.size("params")).alias("n_params"),
                    F.every(F.col("metrics")["pr_auc"].between(0, 1)).alias("scored"),
                    (F.array_sort(F.collect_list("run_name")) == F.array(*[F.lit(f"trial_{i:04d}") for i in range(6)])).alias("named_in_order"))


@query("m7_report_best", f"SELECT split, count(*) AS n_rows, count(*) FILTER (quality = 1) AS n_pos, true AS one_threshold FROM {PARTS_SQL} GROUP BY split", ("clf",))
def q_m7r(t):
    """The best of two trials on VALID, reported on the three parts with VALID's threshold."""
    parts = _three_parts(t)
    path = shared_path(t.spark, f"m7_runs_{uuid.uuid4().hex}")
    space = S.SPACE | {"maxIter": (3, 6, "int"), "maxDepth": (2, 3, "int")}
    runs = S.guided_search(parts[0], parts[1], CLF4, ["lang"], "label", path, 2, space, parallel=2)
    got = S.report_best(runs, *parts, CLF4, ["lang"], "label", space)
    cut = got.agg(F.count_distinct("threshold").alias("k"))
    pos = None
    for name, p in zip(("train", "valid", "test"), parts):
        one = p.agg(F.lit(name).alias("split"), F.count_if(F.col("label") == 1).alias("n_pos"))
        pos = one if pos is None else pos.unionByName(one)
    ok = F.col("pr_auc").between(0, 1) & F.col("roc_auc").between(0, 1) & F.col("f1").between(0, 1)
    return (got.join(pos, "split").crossJoin(F.broadcast(cut)).groupBy("split", "n_rows", "n_pos").agg(F.every(ok & (F.col("k") == 1)).alias("one_threshold")))


@query("m7_fit_best")
def q_m7(t):
    tr, te = _clf_split(t)
    runs = M.search(tr, te, _make_lr, SPACE, n=4, seed=3, label="label", parallel=2)
    best = runs.filter(F.col("status") == "ok").orderBy(F.desc("objective"), "trial").first()
    p = {k: (int(v) if k == "maxIter" else float(v)) for k, v in best["params"].items()}
    m = _make_lr(p).fit(tr)
    rows = []
    for name, part in (("train", tr), ("test", te)):
        r = M.eval_scored(M.score(part, m, ["label"]), "label")
        rows.append((name, r["pr_auc"], r["roc_auc"], r["threshold"], r["f1"]))
    return t.spark.createDataFrame(rows, "split string, pr_auc double, roc_auc double, threshold double, f1 double")


@query("m8_leaderboard")
def q_m8(t):
    tr, te = _clf_split(t)
    cands = {"logreg": M.make_classifier("logreg", "label", weight="weight"),
             "tree": M.make_classifier("tree", "label", weight="weight", maxDepth=4),
             "forest": M.make_classifier("forest", "label", weight="weight", numTrees=20),
             "gbt": M.make_classifier("gbt", "label", maxIter=15, maxDepth=3)}
    return M.leaderboard(tr, te, cands, "label", parallel=2)


THRESHOLDS = [0.3, 0.4, 0.5, 0.6]


@query("m8_leaderboard_report", "SELECT * FROM (VALUES ('forest', true, true), ('logreg', true, true), ('tree', true, true)) AS v(model, shares, in_order)")
def q_m8r(t):
    """Three models ordered on VALID and reported on TEST."""
    parts = [M.assemble(p, CLF4) for p in _three_parts(t)]
    got = M.leaderboard_report(*parts, {"logreg": M.make_classifier("logreg", "label"), "tree": M.make_classifier("tree", "label", maxDepth=3),
                                        "forest": M.make_classifier("forest", "label", numTrees=10)}, "label", parallel=3)
    w = Window.orderBy("rank")  # a row a model
    ok = [F.col(c).between(0, 1) for c in ("valid_pr_auc", "valid_f1", "threshold", "test_pr_auc", "test_f1")]
    return got.select("model", functools.reduce(lambda a, b: a & b, ok).alias("shares"),
                      F.coalesce(F.lag("valid_pr_auc").over(w) >= F.col("valid_pr_auc"), F.lit(True)).alias("in_order"))


@query("m9_select_champion", "SELECT model, accuracy FROM (" + " UNION ALL ".join(
    f"SELECT 't{int(x * 10)}' AS model, round(avg(CAST(CAST(score >= {x} AS INTEGER) = y AS INTEGER)), 6) AS accuracy FROM sc"
    for x in THRESHOLDS) + ") ORDER BY accuracy DESC, model LIMIT 1", ("sc",))
def q_m9(t):
    s = V.sc(t)
    evals = s.groupBy().agg(*[F.round(F.avg(((F.col("score") >= x).cast("int") == F.col("y")).cast("int")), 6).alias(f"t{int(x * 10)}")
                              for x in THRESHOLDS])
    long = evals.unpivot([], [f"t{int(x * 10)}" for x in THRESHOLDS], "model", "accuracy")
    return M.select_champion(long, "accuracy")


# ------------------------------------------------------------------ clustering / anomalies

@query("m10_kmeans")
def q_m10(t):
    _, pred = M.kmeans(_multi(t), 10)
    return pred.select("vec_id", "cluster")


@query("m11_gmm_select")
def q_m11(t):
    return M.gmm_select(M.assemble(V.emb_plane(t), ["x", "y"]), [3, 4, 5])


@query("m12_membership")
def q_m12(t):
    from pyspark.ml.clustering import GaussianMixture
    d = M.assemble(V.emb_plane(t), ["x", "y"])
    pred = GaussianMixture(k=3, seed=7).fit(d).transform(d)
    return M.membership(pred).select("id", "prediction", F.round("max_posterior", 6).alias("max_posterior"), "membership")


@query("m13_dbscan", f"""WITH p AS ({V.EMB_PLANE_SQL}),
nb AS (SELECT a.id AS i, b.id AS j FROM p a JOIN p b ON sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.05),
deg AS (SELECT i, count(*) AS n FROM nb GROUP BY i), core AS (SELECT i FROM deg WHERE n >= 4)
SELECT p.id, coalesce(d.n, 0) AS n_neighbors,
  CASE WHEN p.id IN (SELECT i FROM core) THEN 'core'
       WHEN EXISTS (SELECT 1 FROM nb WHERE nb.i = p.id AND nb.j IN (SELECT i FROM core)) THEN 'border' ELSE 'noise' END AS kind
FROM p LEFT JOIN deg d ON d.i = p.id""")
def q_m13(t):
    return M.dbscan(V.emb_plane(t), 0.05, 4).select("id", "n_neighbors", "kind")


@query("m13_dbscan_clusters")
def q_m13c(t):
    return M.dbscan(V.emb_plane(t), 0.05, 4)


@query("m13_dbscan_labels", f"""WITH RECURSIVE p AS ({V.EMB_PLANE_SQL}),
nb AS (SELECT a.id AS i, b.id AS j FROM p a JOIN p b ON sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.05),
core AS (SELECT i FROM nb GROUP BY i HAVING count(*) >= 4),
ce AS (SELECT nb.i, nb.j FROM nb JOIN core a ON a.i = nb.i JOIN core b ON b.i = nb.j),
reach AS (SELECT i, i AS r FROM core UNION SELECT ce.j, reach.r FROM reach JOIN ce ON ce.i = reach.i),
lab AS (SELECT i, min(r) AS label FROM reach GROUP BY i),
edge AS (SELECT nb.i, min(lab.label) AS label FROM nb JOIN lab ON lab.i = nb.j WHERE nb.i NOT IN (SELECT i FROM core) GROUP BY nb.i)
SELECT p.id, CASE WHEN lab.label IS NOT NULL THEN 'core' WHEN edge.label IS NOT NULL THEN 'border' ELSE 'noise' END AS kind,
  coalesce(lab.label, edge.label, -1) AS cluster FROM p LEFT JOIN lab ON lab.i = p.id LEFT JOIN edge ON edge.i = p.id""")
def q_m13l(t):
    return D.dbscan_cells(V.emb_plane(t), 0.05, 4)


@query("m14_silhouette")
def q_m14(t):
    m, pred = M.kmeans(_multi(t), 10)
    return t.spark.createDataFrame([(M.silhouette(pred),)], "silhouette double")


@query("m14_silhouette_exact", """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
d AS (SELECT a.vec_id, a.label AS own, b.label AS other, count(*) AS n,
        sum(sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))) AS s FROM e a, e b GROUP BY 1, 2, 3),
m AS (SELECT vec_id, own, max(CASE WHEN own = other THEN s / greatest(n - 1, 1) END) AS a, max(CASE WHEN own = other THEN n END) AS size,
        min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY 1, 2),
r AS (SELECT own, CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS x FROM m)
SELECT CAST(own AS BIGINT) AS cluster, count(*) AS n, round(avg(x), 6) AS silhouette FROM r GROUP BY own UNION ALL SELECT NULL, count(*), round(avg(x), 6) FROM r""")
def q_m14e(t):
    """The given labels as clusters of the embeddings."""
    return SIL.silhouette_exact(t.embeddings, "vec_id", "embedding", "label").withColumn("silhouette", F.round("silhouette", 6))


@query("m15_isolation_forest")
def q_m15(t):
    d, cols = V.emb_wide(t, "vec_id")
    return M.isolation_forest(d, "vec_id", cols, n_trees=50, sample_size=128).select("vec_id", "anomaly_score", "anomaly")


@query("m16_proxy_eval", """WITH d AS (SELECT l_quantity * l_discount AS s, l_extendedprice AS v FROM lineitem),
c AS (SELECT quantile_cont(s, 0.99) AS cs, quantile_cont(v, 0.99) AS cv FROM d),
f AS (SELECT CAST(v > cv AS INTEGER) AS y, CAST(s >= cs AS INTEGER) AS yh FROM d, c),
k AS (SELECT count(*) FILTER (WHERE y = 1 AND yh = 1) AS tp, count(*) FILTER (WHERE y = 0 AND yh = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND yh = 0) AS fn, count(*) FILTER (WHERE y = 0 AND yh = 0) AS tn FROM f),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM k)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(p, 6) AS precision, round(r, 6) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM m""")
def q_m16(t):
    d = t.lineitem.select((F.col("l_quantity") * F.col("l_discount")).alias("s"), F.col("l_extendedprice").alias("v"))
    from cartwheel.functions.quantiles import quantile_row
    cut = quantile_row(d, ["s"], [0.99]).select(F.col("_q_s")[0].alias("_c"))
    flags = d.crossJoin(F.broadcast(cut)).withColumn("anomaly", (F.col("s") >= F.col("_c")).cast("int")).drop("_c")
    return M.proxy_eval(flags, "v", "anomaly", 0.99)


# ------------------------------------------------------------------ interpretability

@query("x1_importances")
def q_x1(t):
    tr, _ = _clf_split(t)
    m = M.fit_forest(tr, "forest", "label", "weight", numTrees=30, maxDepth=5)
    return t.spark.createDataFrame(X.importances(m, CLF4), "feature string, importance double")


def _lr_model(t):
    tr, te = _clf_split(t)
    return M.fit_logreg(tr, "label", "weight", regParam=0.01), tr, te


# fixed values: a hand-made ensemble over the document features (tree, node, left, right, feature, threshold)
TREES = [(0, 0, 1, 2, 1, 250.0), (0, 1, 3, 4, 3, 0.75), (0, 2, 5, 6, 2, 4.9), (0, 3, -1, -1, None, None), (0, 4, -1, -1, None, None),
         (0, 5, -1, -1, None, None), (0, 6, 7, 8, 0, 4000.0), (0, 7, -1, -1, None, None), (0, 8, -1, -1, None, None),
         (1, 0, 1, 2, 2, 5.2), (1, 1, 3, 4, 2, 4.8), (1, 2, 5, 6, 3, 0.7), (1, 3, -1, -1, None, None), (1, 4, -1, -1, None, None),
         (1, 5, -1, -1, None, None), (1, 6, -1, -1, None, None)]


def _fixed_nodes(t):
    nodes = t.spark.createDataFrame([(*r, None, None, None, None) for r in TREES], R.NODES)
    return R.measured(nodes, V.clf(t), CLF4, "quality")


def _tree_sql():
    """Counts of every node, from the conditions on its path, and per leaf its path."""
    rows = {(r[0], r[1]): r for r in TREES}
    paths = {}

    def walk(key, path):
        paths[key] = path
        _, _, left, right, f, th = rows[key]
        if left >= 0:
            walk((key[0], left), [*path, (f, f"{CLF4[f]} <= {th!r}", key, (key[0], left))])
            walk((key[0], right), [*path, (f, f"{CLF4[f]} > {th!r}", key, (key[0], right))])

    for tree in sorted({k[0] for k in rows}):
        walk((tree, 0), [])
    name = lambda k: f"{k[0]}_{k[1]}"
    cond = {k: " AND ".join(x[1] for x in p) or "true" for k, p in paths.items()}
    stats = "st AS (SELECT " + ", ".join(
        f"count(*) FILTER ({c}) AS n_{name(k)}, count(*) FILTER ({c} AND quality = 1) AS p_{name(k)}" for k, c in cond.items()) + " FROM clf)"
    leaves = [(k, p) for k, p in paths.items() if rows[k][2] < 0]
    n_trees = len({k[0] for k in rows})
    return stats, leaves, rows, name, n_trees


def _x1_kinds_sql():
    stats, _, rows, name, _ = _tree_sql()
    share = lambda k: f"coalesce(p_{name(k)} / nullif(n_{name(k)}, 0), 0)"
    gini = lambda k: f"(2 * {share(k)} * (1 - {share(k)}))"
    n = lambda k: f"n_{name(k)}"
    splits = []
    for k, (t, _, left, right, f, _) in rows.items():
        if left >= 0:
            a, b = (t, left), (t, right)
            gain = f"coalesce({gini(k)} - ({n(a)} * {gini(a)} + {n(b)} * {gini(b)}) / nullif({n(k)}, 0), 0)"
            splits.append(f"SELECT '{CLF4[f]}' AS feature, {n(k)} AS n, {gain} AS gain FROM st")
    feats = ", ".join(f"('{c}')" for c in CLF4)
    return f"""WITH {stats}, s AS ({' UNION ALL '.join(splits)}), a AS (SELECT feature, count(*) AS weight, avg(n) AS cover, avg(gain) AS gain FROM s GROUP BY 1),
f AS (SELECT v.feature, coalesce(weight, 0) AS weight, coalesce(cover, 0) AS cover, coalesce(gain, 0) AS gain FROM (VALUES {feats}) AS v(feature) LEFT JOIN a USING (feature)),
l AS (SELECT feature, 'weight' AS kind, weight AS v FROM f UNION ALL SELECT feature, 'cover', cover FROM f UNION ALL SELECT feature, 'gain', gain FROM f),
i AS (SELECT kind, feature, v / sum(v) OVER (PARTITION BY kind) AS x FROM l)
SELECT kind, feature, round(x, 6) AS importance, CAST(row_number() OVER (PARTITION BY kind ORDER BY x DESC, feature) AS INTEGER) AS rank FROM i"""


@query("x1_importances_by_kind", _x1_kinds_sql(), ("clf",))
def q_x1k(t):
    i = R.importances_by_kind(_fixed_nodes(t), CLF4)
    return i.select("kind", "feature", F.round("importance", 6).alias("importance"), F.col("rank").cast("int").alias("rank"))


@query("x1_importances_fitted", "SELECT * FROM (VALUES ('cover', true), ('gain', true), ('weight', true)) AS v(kind, sums_to_one)")
def q_x1f(t):
    """Every kind of a fitted boosted ensemble sums to one."""
    tr, _ = _clf_split(t)
    nodes = R.node_table(M.fit_gbt(tr, "label", maxIter=10, maxDepth=3), t.spark)
    i = R.importances_by_kind(nodes, CLF4)
    return i.groupBy("kind").agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))


def _x4_tree_sql():
    """All 16 coalitions: the margin where known features decide and the others count by their share of rows."""
    stats, leaves, _, name, n_trees = _tree_sql()

    def worth(subset):
        parts = []
        for k, path in leaves:
            factors = [f"CAST({c} AS INTEGER)" if f in subset else f"coalesce(n_{name(b)} / nullif(n_{name(a)}, 0), 0)" for f, c, a, b in path]
            parts.append(f"coalesce(p_{name(k)} / nullif(n_{name(k)}, 0), 0) / {n_trees} * " + " * ".join(factors))
        return " + ".join(parts)

    subsets = [tuple(j for j in range(4) if b >> j & 1) for b in range(16)]
    values = ", ".join(f"{worth(s)} AS v{b}" for b, s in enumerate(subsets))
    weight = [1 / 4, 1 / 12, 1 / 12, 1 / 4]
    phi = [" + ".join(f"{weight[bin(b).count('1')]!r} * (v{b | 1 << i} - v{b})" for b in range(16) if not b >> i & 1) for i in range(4)]
    long = " UNION ALL ".join(f"SELECT doc_id, '{CLF4[i]}' AS feature, {phi[i]} AS x FROM w" for i in range(4))
    return f"""WITH {stats}, w AS (SELECT doc_id, {values} FROM clf, st)
SELECT doc_id, feature, round(x, 6) AS contribution FROM ({long}) UNION ALL SELECT doc_id, '(base)', round(v0, 6) FROM w"""


@query("x4_shapley_trees", _x4_tree_sql(), ("clf",))
def q_x4t(t):
    """Shapley values of the hand-made ensemble for every document, and its base value."""
    nodes, c = _fixed_nodes(t), V.clf(t)
    phi = R.tree_contributions(nodes, c, CLF4, "doc_id").withColumn("contribution", F.round("contribution", 6))
    base = c.select("doc_id", F.lit("(base)").alias("feature"), F.round(F.lit(R.base_value(nodes)), 6).alias("contribution"))
    return phi.unionByName(base)


@query("x4_shapley_fitted", "SELECT count(*) AS n_rows, true AS additive FROM clf", ("clf",))
def q_x4f(t):
    """Contributions of a fitted boosted ensemble and its base value add up to the model's own margin on every row."""
    tr, te = _clf_split(t)
    m = M.fit_gbt(tr, "label", maxIter=10, maxDepth=4)
    nodes, rows = R.node_table(m, t.spark), tr.unionByName(te)
    total = R.tree_contributions(nodes, rows, CLF4, "doc_id").groupBy("doc_id").agg(F.sum("contribution").alias("s"))
    margin = m.transform(rows).select("doc_id", vector_to_array("rawPrediction")[1].alias("m"))
    off = F.abs(F.col("s") + R.base_value(nodes) - F.col("m"))
    return margin.join(total, "doc_id").agg(F.count("*").alias("n_rows"), (F.max(off) < 1e-9).alias("additive"))


@query("x2_permutation_importance")
def q_x2(t):
    m, _, te = _lr_model(t)
    return X.permutation_importance(m, te.drop("features"), CLF4, "label", "doc_id", repeats=5)


@query("x3_pdp")
def q_x3(t):
    m, tr, _ = _lr_model(t)
    return X.pdp(m, tr.drop("features"), CLF4, "distinct_share", grid=10)


@query("x4_shapley_sampled")
def q_x4s(t):
    m, tr, te = _lr_model(t)
    return X.sampled_shapley(m, te.drop("features"), CLF4, "doc_id", tr, n_perm=8)


@query("x7_interactions")
def q_x7(t):
    m, _, te = _lr_model(t)
    return X.interactions(m, te.drop("features"), CLF4, "doc_id")


@query("x8_rfe")
def q_x8(t):
    _, tr, te = _lr_model(t)
    return X.rfe(tr.drop("features"), te.drop("features"), CLF4, "label",
                 lambda: LogisticRegression(labelCol="label", featuresCol="features", weightCol="weight"), [1, 2, 3, 4])


@query("x8_rfe_refit", "SELECT * FROM (VALUES (1, 1, true), (2, 2, true), (3, 3, true), (4, 4, true)) AS v(k, n_features, nested)")
def q_x8r(t):
    """Each set of features is the one before without its least important."""
    train, valid, _ = _three_parts(t)
    got = X.rfe_refit(train, valid, CLF4, "label", lambda: LogisticRegression(labelCol="label", featuresCol="features", maxIter=30))
    w = Window.orderBy(F.desc("k"))  # a row a number of features
    before = F.lag("features").over(w)
    nested = before.isNull() | (F.array_sort(F.slice(before, 1, F.size(before) - 1)) == F.array_sort("features"))
    one = F.sum(F.col("chosen").cast("int")).over(Window.partitionBy()) == 1
    ok = [F.col(c).between(0, 1) for c in ("accuracy", "precision", "recall", "f1")]
    return got.select("k", F.size("features").alias("n_features"), (nested & one & functools.reduce(lambda a, b: a & b, ok)).alias("nested"))


@query("x11_find_rule")
def q_x11(t):
    c = V.clf(t)
    row = c.orderBy(F.desc("n_words"), "doc_id").first().asDict()
    trail = X.find_rule(c, row, CLF4, "quality", 0.95)
    return t.spark.createDataFrame(trail, "predicate string, precision double, covered long")


# the rows to explain and the precision to reach
ANCHORS = [("most words", "n_words DESC, doc_id", 0.95), ("fewest words", "n_words, doc_id", 0.8), ("longest words", "mean_word_len DESC, doc_id", 0.7)]


def _anchor_sql():
    """Every conjunction of the row's quartiles, and the choice among them by definition."""
    rules = [r for k in range(1, 5) for r in itertools.combinations(range(4), k)]
    need = -math.log(0.05 / len(rules))
    bins = ", ".join(f"CAST({c} > quantile_cont({c}, 0.25) OVER () AS INT) + CAST({c} > quantile_cont({c}, 0.5) OVER () AS INT) "
                     f"+ CAST({c} > quantile_cont({c}, 0.75) OVER () AS INT) AS q{i}" for i, c in enumerate(CLF4))
    parts = []
    for what, order, target in ANCHORS:
        fits = [(r, " AND ".join(f"b.q{i} = r.q{i}" for i in r)) for r in rules]
        text = lambda r: " || ' AND ' || ".join(f"'{CLF4[i]} in quartile ' || (any_value(r.q{i}) + 1)" for i in r)
        seen = " UNION ALL ".join(
            f"SELECT {k} AS place, {len(r)} AS len, {text(r)} AS rule, count(*) FILTER ({m}) AS n, count(*) FILTER ({m} AND b.quality = r.quality) AS h, count(*) AS total FROM b, r"
            for k, (r, m) in enumerate(fits))
        far = f"n * (h / n * ln(h / n / g) + CASE WHEN h < n THEN (1 - h / n) * ln((1 - h / n) / (1 - g)) ELSE 0 END) >= {need!r}"
        parts.append(f"""SELECT '{what}' AS which, rule, n AS covered, round(n / total, 6) AS coverage, round(h / n, 6) AS precision, bound AS lower_bound,
  bound >= {target} AS reached FROM (WITH r AS (SELECT * FROM b ORDER BY {order} LIMIT 1), seen AS ({seen}),
  c AS (SELECT *, CASE WHEN h = 0 THEN 0 ELSE coalesce(list_max(list_filter(list_transform(range(1, CAST(floor(h / n * 1e4) AS BIGINT) + 1), lambda x: x / 1e4),
        lambda g: {far})), 0) END AS bound FROM seen),
  ok AS (SELECT min(len) AS len FROM c WHERE bound >= {target})
  SELECT c.* FROM c, ok ORDER BY (bound >= {target} AND c.len = ok.len) DESC NULLS LAST,
    CASE WHEN ok.len IS NULL THEN -bound ELSE 0 END, n DESC, c.len, place LIMIT 1)""")
    return f"WITH b AS (SELECT *, {bins} FROM clf) " + " UNION ALL ".join(f"({p})" for p in parts)


@query("x11_anchor_rule", _anchor_sql(), ("clf",))
def q_x11a(t):
    """Rules with a guaranteed precision for three documents, or the word that there is none."""
    c, rows = materialize(V.clf(t)), []
    edges = X.quartile_edges(c, CLF4)
    for what, order, target in ANCHORS:
        row = c.orderBy(*[F.expr(x.split()[0]).desc() if "DESC" in x else F.expr(x) for x in order.split(", ")]).first().asDict()
        r = X.anchor_rule(c, row, CLF4, "quality", target, edges=edges)
        rows.append((what, r["rule"], r["covered"], round(r["coverage"], 6), round(r["precision"], 6), r["lower_bound"], r["reached"]))
    return t.spark.createDataFrame(rows, "which string, rule string, covered long, coverage double, precision double, lower_bound double, reached boolean")


WEIGHTS = {"n_chars": 0.0001, "n_words": 0.001, "mean_word_len": 0.3, "distinct_share": -2.0}
CONTRIB_SQL = "contrib AS (" + " UNION ALL ".join(
    f"SELECT doc_id, '{c}' AS feature, {w!r}::DOUBLE * ({c} - (SELECT avg({c}) FROM clf)) AS contribution FROM clf"
    for c, w in WEIGHTS.items()) + ")"


def _contrib(t):
    return X.linear_contributions(V.clf(t), WEIGHTS, "doc_id")


@query("x4_shapley_linear", f"WITH {CONTRIB_SQL} SELECT doc_id, feature, round(contribution, 6) AS contribution FROM contrib", ("clf",))
def q_x4(t):
    return _contrib(t).withColumn("contribution", F.round("contribution", 6))


@query("x5_global_contrib", f"""WITH {CONTRIB_SQL}
SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs FROM contrib GROUP BY 1 ORDER BY mean_abs DESC, feature LIMIT 10""", ("clf",))
def q_x5(t):
    return X.global_contrib(_contrib(t))


@query("x6_local_contrib", f"""WITH {CONTRIB_SQL},
ch AS ((SELECT doc_id, 'highest' AS which FROM sc ORDER BY score DESC, doc_id LIMIT 1)
  UNION ALL (SELECT doc_id, 'nearest_threshold' FROM sc ORDER BY abs(score - 0.5), doc_id LIMIT 1)
  UNION ALL (SELECT doc_id, 'lowest' FROM sc ORDER BY score, doc_id LIMIT 1))
SELECT doc_id, which, feature, round(contribution, 6) AS contribution, CAST(rank AS INTEGER) AS rank FROM (
  SELECT c.*, ch.which, row_number() OVER (PARTITION BY c.doc_id ORDER BY abs(contribution) DESC, feature) AS rank
  FROM contrib c JOIN ch ON c.doc_id = ch.doc_id) WHERE rank <= 10""", ("clf", "sc"))
def q_x6(t):
    chosen = X.choose_rows(V.sc(t), "doc_id", 0.5)
    r = X.local_contrib(_contrib(t), chosen, "doc_id")
    return r.select("doc_id", "which", "feature", F.round("contribution", 6).alias("contribution"), F.col("rank").cast("int").alias("rank"))


# fixed values: the rule table (rule, column, op, lo, hi) evaluated on the document features
RULES = [(1, "n_words", ">", 500.0, None), (1, "distinct_share", "<=", 0.6, None),
         (2, "mean_word_len", "between", 4.5, 6.0),
         (3, "n_chars", ">=", 2000.0, None), (3, "n_words", ">", 300.0, None), (3, "distinct_share", "<", 0.7, None)]


def _rules(t):
    return t.spark.createDataFrame(RULES, "rule int, column string, op string, lo double, hi double")


def _rules_sql():
    conds = {}
    for r, c, op, lo, hi in RULES:
        e = f"({c} > {lo!r} AND {c} <= {hi!r})" if op == "between" else f"{c} {op} {lo!r}"
        conds.setdefault(r, []).append(e)
    n = {r: len(v) for r, v in conds.items()}
    fired = " UNION ALL ".join(f"SELECT doc_id, {r} AS rule, {n[r]} AS n_conditions FROM clf WHERE {' AND '.join(v)}"
                               for r, v in conds.items())
    return f"fired AS ({fired})"


@query("x9_fire_rules", f"WITH {_rules_sql()} SELECT doc_id, CAST(rule AS INTEGER) AS rule, CAST(n_conditions AS BIGINT) AS n_conditions FROM fired",
       ("clf",))
def q_x9(t):
    return X.fire_rules(V.clf(t), _rules(t), "doc_id", CLF4)


EVAL_SQL = f"""{_rules_sql()},
j AS (SELECT f.*, c.quality FROM fired f JOIN clf c ON f.doc_id = c.doc_id),
ev AS (SELECT rule, count(*) AS covered, avg(quality) AS precision FROM j GROUP BY rule
       UNION ALL SELECT -1, count(*), avg(quality) FROM (SELECT DISTINCT doc_id, quality FROM j))"""


@query("x10_evaluate_rules", f"""WITH {EVAL_SQL}
SELECT CAST(rule AS INTEGER) AS rule, covered, round(covered / (SELECT count(*) FROM clf), 6) AS coverage, round(precision, 6) AS precision FROM ev""",
       ("clf",))
def q_x10(t):
    c = V.clf(t)
    return X.evaluate_rules(c, X.fire_rules(c, _rules(t), "doc_id", CLF4), "doc_id", "quality")


@query("w14_resolve_rules", f"""WITH {EVAL_SQL}
SELECT doc_id, CAST(rule AS INTEGER) AS rule FROM (
  SELECT f.doc_id, f.rule, row_number() OVER (PARTITION BY f.doc_id ORDER BY f.n_conditions DESC, e.precision DESC, f.rule) AS rn
  FROM fired f JOIN ev e ON e.rule = f.rule) WHERE rn = 1""", ("clf",))
def q_w14(t):
    c = V.clf(t)
    fired = X.fire_rules(c, _rules(t), "doc_id", CLF4)
    prec = X.evaluate_rules(c, fired, "doc_id", "quality").select("rule", "precision")
    f2 = fired.join(prec, "rule").withColumnRenamed("doc_id", "row_id")
    return windows.resolve_rules(f2).withColumnRenamed("row_id", "doc_id")


# fixed values: weights of the one-hot language columns in the linear contribution example
LANG_WEIGHTS = {"de": 0.75, "en": 0.5, "es": 1.0, "fr": -0.25}


@query("a19_contribution_by_prefix", "WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{lang}' AS category, {w!r}::DOUBLE * (CAST(lang = '{lang}' AS INTEGER) - (SELECT avg(CAST(lang = '{lang}' AS INTEGER)) FROM documents)) AS contribution FROM documents"
    for lang, w in LANG_WEIGHTS.items()) + """)
SELECT category, mean_abs, CAST(row_number() OVER (ORDER BY mean_abs DESC, category) AS INTEGER) AS rank FROM (
  SELECT category, round(avg(abs(contribution)), 6) AS mean_abs FROM c GROUP BY 1 ORDER BY mean_abs DESC, category LIMIT 10)""")
def q_a19(t):
    from cartwheel.operators.aggs import contribution_by_prefix
    d = prep.one_hot(t.documents.select("doc_id", "lang"), "lang", list(LANG_WEIGHTS))
    w = {f"lang_{k}": v for k, v in LANG_WEIGHTS.items()}
    c = X.linear_contributions(d, w, "doc_id")
    return contribution_by_prefix(c, "lang").withColumn("rank", F.col("rank").cast("int"))


@query("t4_top_pairs", f"""WITH {RANKS}, c0 AS ({_spearman_sql()}),
c AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b, rho FROM c0),
pos AS (SELECT *, 'positive' AS sign FROM c WHERE rho > 0 ORDER BY rho DESC, a, b LIMIT 10),
neg AS (SELECT *, 'negative' AS sign FROM c WHERE rho < 0 ORDER BY rho, a, b LIMIT 10)
SELECT * FROM pos UNION ALL SELECT * FROM neg""")
def q_t4(t):
    d = t.lineitem.select(F.monotonically_increasing_id().alias("_id"), *NUM4)
    return topk.top_pairs(prep.spearman(d, NUM4, "_id"))


# ------------------------------------------------------------------ weekly jobs

def _weekly_inputs(t):
    from cartwheel.plans.features import clean_transactions  # noqa: F401 - same cleaning as the job
    return V.txd(t), V.cust(t), V.brand_dim(t)


@query("d5_choose_model")
def q_d5(t):
    from cartwheel.plans import weekly as W
    c = V.clf(t).withColumn("label", F.col("quality").cast("double"))
    half = V.md5_bucket(F.col("doc_id"), 1, 2) == 0
    path = W.model_dir(t.spark, f"d5_{uuid.uuid4().hex}")
    rows = []
    # first call: nothing saved → retrain; second call on the same halves: reuse or retrain by the gate
    for _ in range(2):
        ch = W.choose_model(c, c.filter(half), c.filter(~half), path, features=CLF4)
        rows.append((ch.decision, ch.reason))
    return t.spark.createDataFrame(rows, "decision string, reason string")


@query("d7_weekly_run")
def q_d7(t):
    from cartwheel.plans import weekly as W
    tx, cust, prod = _weekly_inputs(t)
    ranking, _, _ = W.weekly_run(tx, cust, prod, W.model_dir(t.spark, f"d7_{uuid.uuid4().hex}"), k=10)
    return ranking


@query("d8_score_week")
def q_d8(t):
    from cartwheel.plans import weekly as W
    tx, cust, prod = _weekly_inputs(t)
    import datetime
    last = datetime.date.fromisoformat(V.last_order(t)[:10])
    week = last - datetime.timedelta(days=last.weekday() + 35)  # a Monday, five weeks before the last one
    return W.score_week(tx, cust, prod, str(week), 26, W.model_dir(t.spark, f"d8_{uuid.uuid4().hex}"), k=10)
