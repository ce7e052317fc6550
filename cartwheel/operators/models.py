"""Models, clustering, search and scoring (M1-M18) on MLlib.

Estimators train distributed; searches run their trials as concurrent
Spark jobs from a small thread pool; every metric is the exact aggregate
from ``operators.metrics``.  Iterative algorithms (density clustering)
checkpoint to the shared folder to cut lineage.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators import density, metrics
from cartwheel.session import materialize


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


# M1-M4
def make_classifier(kind: str, label: str = "label", features: str = "features", weight: str | None = None, **params):
    """'logreg' | 'tree' | 'forest' | 'extra_trees' | 'gbt' → an MLlib estimator."""
    common = dict(labelCol=label, featuresCol=features)
    if kind == "logreg":
        est = LogisticRegression(**common, maxIter=params.pop("maxIter", 100), **params)
    elif kind == "tree":
        est = DecisionTreeClassifier(**common, seed=params.pop("seed", 7), **params)
    elif kind in ("forest", "extra_trees"):
        # MLlib has no extremely randomised trees; a forest with all-feature
        # bootstrap off is the closest distributed analogue
        if kind == "extra_trees":
            params.setdefault("bootstrap", False)
            params.setdefault("featureSubsetStrategy", "sqrt")
        est = RandomForestClassifier(**common, seed=params.pop("seed", 7), **params)
    elif kind == "gbt":
        est = GBTClassifier(**common, seed=params.pop("seed", 7), **params)
    else:
        raise ValueError(kind)
    if weight:
        est.setWeightCol(weight)
    return est


def fit_logreg(df: DataFrame, label: str = "label", weight: str | None = "weight", **p):
    return make_classifier("logreg", label, weight=weight, **p).fit(df)


def fit_forest(df: DataFrame, kind: str = "forest", label: str = "label", weight: str | None = None, **p):
    return make_classifier(kind, label, weight=weight, **p).fit(df)


def fit_gbt(df: DataFrame, label: str = "label", valid_col: str | None = None, **p):
    est = make_classifier("gbt", label, **p)
    if valid_col:
        est.setValidationIndicatorCol(valid_col)
    return est.fit(df)


def fit_multiclass(df: DataFrame, label: str = "label", weight: str | None = "weight", **p):
    return make_classifier("forest", label, weight=weight, **p).fit(df)


# M5
def can_train(df: DataFrame, label: str, force: bool = False) -> DataFrame:
    """(n_classes, can_train, reason): a single-class target is skipped unless forced."""
    c = df.agg(F.count_distinct(label).alias("n_classes"))
    ok = (F.col("n_classes") >= 2) | F.lit(force)
    return c.select("n_classes", ok.alias("can_train"),
                    F.when(F.col("n_classes") >= 2, F.lit("ok"))
                    .when(F.lit(force), F.lit("forced with one class"))
                    .otherwise(F.lit("only one class present")).alias("reason"))


# M17
def score(df: DataFrame, model, ids: Sequence[str], out: str = "proba") -> DataFrame:
    """ids + P(class 1) as float."""
    s = model.transform(df)
    return s.select(*ids, vector_to_array("probability")[1].cast("float").alias(out))


def eval_scored(scored: DataFrame, label: str, p: str = "proba") -> dict:
    """Exact PR-AUC (AP), ROC AUC and best-F1 threshold of a scored frame."""
    s = scored.select(F.col(label).alias("y"), F.col(p).cast("double").alias("score"))
    ap = metrics.average_precision(s).first()[0]
    auc = metrics.roc_auc(s).first()[0]
    b = metrics.best_threshold(s).first()
    return {"pr_auc": ap, "roc_auc": auc, "threshold": b["threshold"], "f1": b["f1"]}


# M6 / M7 / M8
def sample_space(space: dict, n: int, seed: int) -> list[dict]:
    """Seeded random search space: each entry is (low, high[, 'log'|'int']) or a list of choices."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        p = {}
        for k, v in space.items():
            if isinstance(v, list):
                p[k] = v[int(rng.integers(len(v)))]
            else:
                lo, hi, *kind = v
                if kind and kind[0] == "log":
                    p[k] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
                elif kind and kind[0] == "int":
                    p[k] = int(rng.integers(lo, hi + 1))
                else:
                    p[k] = float(rng.uniform(lo, hi))
        out.append(p)
    return out


def search(train: DataFrame, valid: DataFrame, make: Callable[[dict], object], space: dict, n: int, seed: int,
           label: str = "label", objective: str = "pr_auc", parallel: int = 4) -> DataFrame:
    """Random search; each trial fits on TRAIN and scores VALID.  Trials are
    concurrent Spark jobs; failures are recorded (never silently scored 0)."""
    params = sample_space(space, n, seed)

    def trial(i):
        t0 = time.time()
        try:
            m = make(params[i]).fit(train)
            r = eval_scored(score(valid, m, [label]), label)
            return (i, {k: str(v) for k, v in params[i].items()}, {**r, "seconds": time.time() - t0}, "ok")
        except Exception as e:  # noqa: BLE001 - recorded in the run log
            return (i, {k: str(v) for k, v in params[i].items()}, {"seconds": time.time() - t0}, f"failed: {e!r}"[:500])

    with ThreadPoolExecutor(max_workers=parallel) as ex:
        rows = list(ex.map(trial, range(n)))
    spark = train.sparkSession
    schema = "trial int, params map<string,string>, metrics map<string,double>, status string"
    runs = spark.createDataFrame(rows, schema)
    return runs.withColumn("objective", F.col("metrics")[objective])


def leaderboard(train: DataFrame, valid: DataFrame, candidates: dict[str, object], label: str = "label",
                parallel: int = 4) -> DataFrame:
    """Fit each candidate, time it, exact PR/ROC and best-F1 threshold; ordered by PR then F1."""
    def run(name):
        t0 = time.time()
        m = candidates[name].fit(train)
        fit_s = time.time() - t0
        r = eval_scored(score(valid, m, [label]), label)
        return (name, fit_s, r["pr_auc"], r["roc_auc"], r["threshold"], r["f1"])

    with ThreadPoolExecutor(max_workers=parallel) as ex:
        rows = list(ex.map(run, list(candidates)))
    spark = train.sparkSession
    df = spark.createDataFrame(rows, "model string, fit_seconds double, pr_auc double, roc_auc double, threshold double, f1 double")
    return df.orderBy(F.desc("pr_auc"), F.desc("f1"), "model")


def leaderboard_report(train: DataFrame, valid: DataFrame, test: DataFrame, candidates: dict[str, object], label: str = "label",
                       parallel: int = 4) -> DataFrame:
    """Candidates fitted on TRAIN and ordered on VALID (PR-AUC, then F1); TEST only
    reports: its PR-AUC and its F1 at VALID's threshold.  Columns rank, model,
    fit_seconds, valid_pr_auc, valid_f1, threshold, test_pr_auc, test_f1."""
    def run(name):
        t0 = time.time()
        m = candidates[name].fit(train)
        seconds = time.time() - t0
        v = eval_scored(score(valid, m, [label]), label)
        s = score(test, m, [label]).select(F.col(label).alias("y"), F.col("proba").cast("double").alias("score"))
        c = s.agg(F.count_if((F.col("score") >= v["threshold"]) & (F.col("y") == 1)).alias("tp"), F.count_if(F.col("score") >= v["threshold"]).alias("pp"),
                  F.count_if(F.col("y") == 1).alias("p")).first()
        f1 = 2 * c["tp"] / (c["pp"] + c["p"]) if c["pp"] + c["p"] else 0.0
        return (name, seconds, v["pr_auc"], v["f1"], v["threshold"], metrics.average_precision(s).first()[0], f1)

    with ThreadPoolExecutor(max_workers=parallel) as ex:
        rows = sorted(ex.map(run, list(candidates)), key=lambda r: (-r[2], -r[3], r[0]))
    return train.sparkSession.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)],
                                              "rank int, model string, fit_seconds double, valid_pr_auc double, valid_f1 double, threshold double, test_pr_auc double, test_f1 double")


def select_champion(evals: DataFrame, metric: str = "accuracy") -> DataFrame:
    """M9: best model by metric (desc), ties by name."""
    return evals.orderBy(F.desc(metric), "model").limit(1)


# M10
def kmeans(df: DataFrame, k: int, features: str = "features", seed: int = 7):
    m = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)
    return m, m.transform(df)


# M11
def gmm_select(df: DataFrame, ks: Sequence[int], features: str = "features", seed: int = 7) -> DataFrame:
    """Gaussian mixtures for each k: log-likelihood, AIC, BIC, ΔBIC to the best."""
    n = df.count()
    d = len(df.select(features).first()[0])
    rows = []
    for k in ks:
        m = GaussianMixture(k=k, seed=seed, featuresCol=features).fit(df)
        ll = m.summary.logLikelihood
        n_params = k * d + k * d * (d + 1) / 2 + (k - 1)
        rows.append((k, ll, 2 * n_params - 2 * ll, n_params * math.log(n) - 2 * ll))
    out = df.sparkSession.createDataFrame(rows, "k int, log_likelihood double, aic double, bic double")
    best = out.agg(F.min("bic").alias("_b"))
    return out.crossJoin(F.broadcast(best)).select("*", (F.col("bic") - F.col("_b")).alias("delta_bic"),
                                                   (F.col("bic") == F.col("_b")).alias("best")).drop("_b")


# M12
def membership(pred: DataFrame, t: float = 0.70, prob: str = "probability") -> DataFrame:
    mx = F.array_max(vector_to_array(prob))
    return pred.withColumn("max_posterior", mx).withColumn("membership", F.when(mx >= t, "core").otherwise("border"))


# M13
def dbscan(df: DataFrame, eps: float, min_pts: int, id_col: str = "id", cols: Sequence[str] = ("x", "y")) -> DataFrame:
    """Density clustering: core = ≥ min_pts neighbours within eps (self
    included); clusters = connected components of core points; border points
    take the smallest label of an adjacent core; the rest is noise (−1).

    Neighbours are counted in tiles and clusters found by cells (``density``),
    so no pair of neighbours becomes a row."""
    deg = density.neighbour_counts(df, eps, id_col, cols)
    found = density.dbscan_cells(df, eps, min_pts, id_col, cols).groupBy("id").agg(F.min(F.struct(
        F.array_position(F.array(*[F.lit(k) for k in ("core", "border", "noise")]), F.col("kind")).alias("_k"), "cluster", "kind")).alias("f"))
    out = df.select(F.col(id_col).alias("id")).join(found, "id", "left").join(deg, "id", "left")
    return out.select("id", F.coalesce("n_neighbors", F.lit(0)).alias("n_neighbors"), F.coalesce("f.kind", F.lit("noise")).alias("kind"),
                      F.coalesce("f.cluster", F.lit(-1)).alias("cluster"))


# M14
def silhouette(pred: DataFrame, features: str = "features", cluster: str = "cluster") -> float | None:
    """Silhouette (squared Euclidean, MLlib), noise (−1) excluded, None under two clusters."""
    p = pred.filter(F.col(cluster) >= 0)
    if p.select(cluster).distinct().limit(2).count() < 2:
        return None
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=cluster, distanceMeasure="squaredEuclidean")
    return ev.evaluate(p.withColumn(cluster, F.col(cluster).cast("int")))


# M15 --------------------------------------------------------------- isolation forest
def isolation_forest(df: DataFrame, id_col: str, cols: Sequence[str], n_trees: int = 100, sample_size: int = 256,
                     contamination: float = 0.01, seed: int = 7) -> DataFrame:
    """Anomaly scores 2^(−E[h(x)]/c(ψ)); the top ``contamination`` share
    (exact quantile of the scores) is flagged.

    Subsamples: each tree draws ~3ψ of all rows by a hash of (id, tree) and
    keeps the first ψ in hash order; a row is copied only for the trees that
    drew it, in the scan.  Trees grow in ``groupBy(tree).applyInPandas``; the forest
    (≤ n_trees · 2ψ nodes, bounded) is broadcast to a pandas UDF scoring
    batches of rows."""
    # helpers are nested so the tasks receive them by value (no package import on executors)
    def _c_factor(n: float) -> float:
        if n <= 1:
            return 0.0
        return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


    def _grow(pdf: pd.DataFrame, cols: list[str], seed: int) -> pd.DataFrame:
        """Grow one isolation tree on its subsample (runs inside applyInPandas)."""
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed * 100003 + tree)
        X = pdf[cols].to_numpy(dtype=float)
        limit = math.ceil(math.log2(max(len(X), 2)))
        nodes = []

        def build(idx, depth):
            nid = len(nodes)
            nodes.append(None)
            if depth >= limit or len(idx) <= 1:
                nodes[nid] = (tree, nid, -1, 0.0, -1, -1, len(idx))
                return nid
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            ok = np.where(hi > lo)[0]
            if len(ok) == 0:
                nodes[nid] = (tree, nid, -1, 0.0, -1, -1, len(idx))
                return nid
            f = int(rng.choice(ok))
            thr = float(rng.uniform(lo[f], hi[f]))
            left = build(idx[sub[:, f] < thr], depth + 1)
            right = build(idx[sub[:, f] >= thr], depth + 1)
            nodes[nid] = (tree, nid, f, thr, left, right, len(idx))
            return nid

        build(np.arange(len(X)), 0)
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "size"])

    cols = list(cols)
    spark = df.sparkSession
    n = df.count()
    psi = min(sample_size, n)
    draw = lambda t: F.pmod(F.xxhash64(F.col(id_col).cast("string"), t, F.lit(seed)), F.lit(1 << 53))
    cut = int(min(1.0, 3.0 * psi / max(n, 1)) * (1 << 53))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: draw(t) < F.lit(cut))
    cand = df.select(id_col, *cols, F.explode(drawn).alias("tree")).withColumn("_h", draw(F.col("tree")))
    w = Window.partitionBy("tree").orderBy("_h", id_col)
    sample = cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi).drop("_r", "_h")
    schema = "tree int, node int, feature int, threshold double, left int, right int, size int"
    forest = sample.groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, cols, seed), schema)
    nodes = forest.toPandas()  # bounded: n_trees × (2ψ − 1) nodes
    by_tree = {t: g.set_index("node").sort_index() for t, g in nodes.groupby("tree")}
    bc = spark.sparkContext.broadcast(by_tree)
    c_psi = _c_factor(psi)

    @F.pandas_udf(T.DoubleType())
    def path_score(*arrs: pd.Series) -> pd.Series:
        X = np.column_stack([a.to_numpy(dtype=float) for a in arrs])
        total = np.zeros(len(X))
        for t, g in bc.value.items():
            feat, thr = g["feature"].to_numpy(), g["threshold"].to_numpy()
            left, right, size = g["left"].to_numpy(), g["right"].to_numpy(), g["size"].to_numpy()
            node = np.zeros(len(X), dtype=int)
            depth = np.zeros(len(X))
            active = feat[node] >= 0
            while active.any():
                ix = np.where(active)[0]
                f = feat[node[ix]]
                go_left = X[ix, f] < thr[node[ix]]
                node[ix] = np.where(go_left, left[node[ix]], right[node[ix]])
                depth[ix] += 1
                active = feat[node] >= 0
            total += depth + np.array([_c_factor(s) for s in size[node]])
        mean = total / max(len(bc.value), 1)
        return pd.Series(np.power(2.0, -mean / c_psi) if c_psi > 0 else np.zeros(len(X)))

    # scored once: the quantile below reads the scores in several rounds
    scored = materialize(df.withColumn("anomaly_score", path_score(*[F.col(c) for c in cols])))
    from cartwheel.functions.quantiles import quantile_row
    cut = quantile_row(scored, ["anomaly_score"], [1.0 - contamination]).select(F.col("_q_anomaly_score")[0].alias("_cut"))
    return scored.crossJoin(F.broadcast(cut)).withColumn("anomaly", (F.col("anomaly_score") >= F.col("_cut")).cast("int")).drop("_cut")


# M16
def proxy_eval(flags: DataFrame, col: str, flag: str = "anomaly", q: float = 0.99) -> DataFrame:
    """Anomaly flags against a proxy truth (value above the q-quantile)."""
    from cartwheel.functions.quantiles import quantile_row
    cut = quantile_row(flags, [col], [q]).select(F.col(f"_q_{col}")[0].alias("_cut"))
    j = flags.crossJoin(F.broadcast(cut)).withColumn("y", (F.col(col) > F.col("_cut")).cast("int"))
    return metrics.binary_metrics(j.withColumn("y_hat", F.col(flag)), "y", "y_hat")


# M18
def calibrate(scored: DataFrame, label: str, p: str = "proba"):
    """Isotonic calibration of scores (MLlib IsotonicRegression)."""
    from pyspark.ml.regression import IsotonicRegression
    d = scored.select(F.col(p).cast("double").alias("score"), F.col(label).cast("double").alias("label"))
    return IsotonicRegression(featuresCol="score", labelCol="label", predictionCol="calibrated").fit(d)


# S14
def save_model(model, path: str, metadata: dict, spark) -> None:
    model.write().overwrite().save(path + "/model")
    spark.createDataFrame([(k, str(v)) for k, v in metadata.items()], "key string, value string") \
        .write.mode("overwrite").parquet(path + "/metadata")


def load_model(path: str, spark, fallback=None):
    """Load a saved pipeline; fall back to ``fallback`` (explicitly) when absent."""
    try:
        return PipelineModel.load(path + "/model"), spark.read.parquet(path + "/metadata")
    except Exception:  # noqa: BLE001 - missing or unreadable model
        if fallback is None:
            raise
        return fallback, None
