"""Evaluation (K1-K12): exact metrics as aggregates.

Ranking metrics first collapse rows to one row per distinct score (map-side
combine), then take running sums with ``running_sums`` — never a global
single-partition window over the scored rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.prefix import running_sums
from cartwheel.functions.scalars import qcut
from cartwheel.operators.topk import pair_sets


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


# K1
def confusion(df: DataFrame, y: str = "y", yhat: str = "y_hat") -> DataFrame:
    return df.groupBy(F.col(y).alias("y_true"), F.col(yhat).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))


# K2
def binary_metrics(df: DataFrame, y: str = "y", yhat: str = "y_hat") -> DataFrame:
    c = df.agg(
        F.count_if((F.col(y) == 1) & (F.col(yhat) == 1)).alias("tp"),
        F.count_if((F.col(y) == 0) & (F.col(yhat) == 1)).alias("fp"),
        F.count_if((F.col(y) == 1) & (F.col(yhat) == 0)).alias("fn"),
        F.count_if((F.col(y) == 0) & (F.col(yhat) == 0)).alias("tn"),
    )
    p = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(
        "tp", "fp", "fn", "tn",
        F.round(_safe_div(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")), 6).alias("accuracy"),
        F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"),
        F.round(_safe_div(2 * p * r, p + r), 6).alias("f1"),
    )


# K3
def classification_report(df: DataFrame, y: str = "y", yhat: str = "y_hat") -> DataFrame:
    """Per-class precision / recall / f1 / support plus macro and weighted
    averages, built from the (small) confusion table."""
    cm = confusion(df, y, yhat)
    true_c = cm.groupBy(F.col("y_true").alias("cls")).agg(F.sum("n").alias("support"))
    pred_c = cm.groupBy(F.col("y_pred").alias("cls")).agg(F.sum("n").alias("predicted"))
    tp_c = cm.filter(F.col("y_true") == F.col("y_pred")).select(F.col("y_true").alias("cls"), F.col("n").alias("tp"))
    per = (true_c.join(pred_c, "cls", "full_outer").join(tp_c, "cls", "left")
           .na.fill({"support": 0, "predicted": 0, "tp": 0}))
    p = _safe_div(F.col("tp"), F.col("predicted"))
    r = _safe_div(F.col("tp"), F.col("support"))
    per = per.select(F.col("cls").cast("string").alias("label"), p.alias("precision"), r.alias("recall"),
                     _safe_div(2 * p * r, p + r).alias("f1"), F.col("support").cast("bigint").alias("support"))
    tot = per.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").cast("bigint").alias("n"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                       F.col("mf").alias("f1"), F.col("n").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                          F.col("wf").alias("f1"), F.col("n").alias("support"))
    out = per.unionByName(macro).unionByName(weighted)
    return out.select("label", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


def score_counts(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """One row per distinct score with positive and negative counts."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))


# K4
def roc_auc(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """Exact ROC AUC with ties (Mann–Whitney); null when one class is absent."""
    c = running_sums(score_counts(df, score, y), "score", ["neg"])
    t = c.agg(F.sum(F.col("pos") * (F.col("neg_cum") - F.col("neg") + 0.5 * F.col("neg"))).alias("u"),
              F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return t.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                           F.round(F.col("u") / (F.col("P") * F.col("N")), 6)).alias("roc_auc"))


# K6
def pr_curve(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """Precision and recall when predicting positive at score ≥ each distinct score."""
    c = running_sums(score_counts(df, score, y), "score", ["pos", "neg"], descending=True)
    P = c.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("_P"))  # the counts hold it already
    j = c.crossJoin(F.broadcast(P))
    return j.select(
        "_P",
        F.col("score").alias("threshold"),
        (F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))).alias("precision"),
        F.when(F.col("_P") > 0, F.col("pos_cum") / F.col("_P")).alias("recall"),
        F.col("pos").alias("_pos"),
    )


# K5
def average_precision(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """Σ (R_i − R_{i−1}) · P_i over distinct thresholds (stepwise, no interpolation)."""
    c = pr_curve(df, score, y)
    t = c.agg(F.sum(F.when(F.col("_P") > 0, F.col("_pos") / F.col("_P") * F.col("precision"))).alias("ap"), F.max("_P").alias("_P"))
    return t.select(F.when(F.col("_P") > 0, F.round("ap", 6)).alias("average_precision"))


# K7
def best_threshold(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """Threshold maximising F1 = 2PR/(P+R+1e-12); lowest threshold on ties."""
    c = pr_curve(df, score, y).withColumn(
        "f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-12))
    best = c.agg(F.max_by(F.struct("threshold", "precision", "recall", "f1"),
                          F.struct(F.round("f1", 12), (-F.col("threshold")))).alias("b"))
    return best.select(F.col("b.threshold").alias("threshold"), F.round("b.precision", 6).alias("precision"),
                       F.round("b.recall", 6).alias("recall"), F.round("b.f1", 6).alias("f1"))


# K8
def brier(df: DataFrame, p: str = "score", y: str = "y") -> DataFrame:
    """Brier score on P(class 1) (Q7)."""
    return df.agg(F.round(F.avg(F.pow(F.col(p) - F.col(y), 2)), 6).alias("brier"))


# K9
def calibration_curve(df: DataFrame, n_bins: int = 10, p: str = "score", y: str = "y") -> DataFrame:
    """Reliability curve on quantile bins: (bin, mean predicted, fraction positive, n)."""
    b = qcut(df.select(p, y), p, n_bins, out="bin")
    return b.groupBy(F.col("bin").cast("int").alias("bin")).agg(
        F.round(F.avg(p), 6).alias("mean_predicted"), F.round(F.avg(y), 6).alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"))


def _set_cols(tp, fp, fn):
    prec = tp / (tp + fp + 1e-9)
    rec = tp / (tp + fn + 1e-9)
    return [F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
            F.round(2 * prec * rec / (prec + rec + 1e-9), 6).alias("f1")]


# K10
def set_metrics(pred: DataFrame, truth: DataFrame, keys: Sequence[str] = ("customer_id", "product_id")) -> DataFrame:
    s = pair_sets(pred, truth, keys)
    return s.select("tp", "fp", "fn", *_set_cols(F.col("tp"), F.col("fp"), F.col("fn")))


# K11
def batch_trend(preds: DataFrame, truths: DataFrame, batch: str = "batch",
                keys: Sequence[str] = ("customer_id", "product_id")) -> DataFrame:
    """Per prediction batch: predicted/real pair counts and set metrics; the
    metrics are null when the batch has no truth."""
    keys = [batch, *keys]
    p = preds.select(*keys).distinct().withColumn("_p", F.lit(1))
    t = truths.select(*keys).distinct().withColumn("_t", F.lit(1))
    u = p.join(t, keys, "full_outer")
    g = u.groupBy(batch).agg(
        F.count_if(F.col("_p").isNotNull()).alias("n_pred"), F.count_if(F.col("_t").isNotNull()).alias("n_true"),
        F.count_if(F.col("_p").isNotNull() & F.col("_t").isNotNull()).alias("tp"))
    fp = F.col("n_pred") - F.col("tp")
    fn = F.col("n_true") - F.col("tp")
    names = ["precision", "recall", "f1"]
    cols = _set_cols(F.col("tp"), fp, fn)
    return g.filter(F.col("n_pred") > 0).select(
        batch, "n_pred", "n_true", "tp",
        *[F.when(F.col("n_true") > 0, c).alias(nm) for c, nm in zip(cols, names)])


# K12
def jaccard_stability(top_sets: DataFrame, run: str = "run", item: str = "item") -> DataFrame:
    """Jaccard of every pair of runs' sets: |A∩B| / |A∪B|, by a self-join on the item."""
    s = top_sets.select(run, item).distinct()
    sizes = s.groupBy(run).agg(F.count(F.lit(1)).alias("_n"))
    a = s.select(F.col(run).alias("run_a"), item)
    b = s.select(F.col(run).alias("run_b"), item)
    inter = a.join(b, item).filter(F.col("run_a") < F.col("run_b")).groupBy("run_a", "run_b").agg(
        F.count(F.lit(1)).alias("inter"))
    pairs = (sizes.select(F.col(run).alias("run_a"), F.col("_n").alias("na"))
             .crossJoin(sizes.select(F.col(run).alias("run_b"), F.col("_n").alias("nb")))
             .filter(F.col("run_a") < F.col("run_b")))
    j = pairs.join(inter, ["run_a", "run_b"], "left").na.fill({"inter": 0})
    return j.select("run_a", "run_b", "inter",
                    F.round(F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter")), 6).alias("jaccard"))
