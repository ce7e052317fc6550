"""Drift (D1-D4): label-rate gate, two-sample KS, chi-square, drift score."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.prefix import running_sums


# D1
def rate_drift(ref: DataFrame, new: DataFrame, label: str, threshold: float = 0.1, weight: str | None = None) -> DataFrame:
    """|new − ref| / max(ref, 1e-6) of the positive rate → 'retrain' or 'skip'.
    With ``weight`` a row stands for so many."""
    y = F.col(label).cast("double")
    rate = F.try_divide(F.sum(y * F.col(weight)), F.sum(weight)) if weight else F.avg(y)
    r = ref.agg(rate.alias("ref_rate"))
    n = new.agg(rate.alias("new_rate"))
    j = r.crossJoin(n)
    rel = F.abs(F.col("new_rate") - F.col("ref_rate")) / F.greatest(F.col("ref_rate"), F.lit(1e-6))
    return j.select(F.round("ref_rate", 6).alias("ref_rate"), F.round("new_rate", 6).alias("new_rate"),
                    F.round(rel, 6).alias("rel_change"),
                    F.when(rel >= threshold, "retrain").otherwise("skip").alias("decision"))


def _long(ref: DataFrame, new: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    def melt(df, tag):
        s = df.select(*[F.col(c).cast(cast).alias(c) for c in cols])
        return s.unpivot([], list(cols), "feature", "value").withColumn("sample", F.lit(tag))
    return melt(ref, "ref").unionByName(melt(new, "new")).filter(F.col("value").isNotNull())


# D2
def ks_drift(ref: DataFrame, new: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Two-sample KS per numeric feature: D = max |F_ref − F_new| over the
    pooled values (value-level counts + distributed running sums), p from the
    asymptotic Kolmogorov series."""
    long = _long(ref, new, cols, "double")
    cnt = long.groupBy("feature", "value").agg(
        F.count_if(F.col("sample") == "ref").alias("a"), F.count_if(F.col("sample") == "new").alias("b"))
    cum = running_sums(cnt, "value", ["a", "b"], keys=["feature"])
    tot = cnt.groupBy("feature").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    j = cum.join(F.broadcast(tot), "feature")  # one row per feature
    d = j.groupBy("feature", "na", "nb").agg(
        F.max(F.abs(F.col("a_cum") / F.col("na") - F.col("b_cum") / F.col("nb"))).alias("D"))
    ne = F.col("na") * F.col("nb") / (F.col("na") + F.col("nb"))
    lam = (F.sqrt(ne) + 0.12 + 0.11 / F.sqrt(ne)) * F.col("D")
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                         lambda acc, j_: acc + F.pow(F.lit(-1.0), j_ - 1) * F.exp(-2.0 * j_ * j_ * lam * lam))
    p = F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0))
    return d.select("feature", F.round("D", 6).alias("statistic"), F.round(p, 6).alias("p_value"),
                    (p < alpha).cast("int").alias("drift"))


# D3
def chi2_drift(ref: DataFrame, new: DataFrame, cols: Sequence[str], min_freq: float = 0.01) -> DataFrame:
    """Chi-square statistic per categorical feature on the category × sample
    table; categories under ``min_freq`` of the reference share one bucket."""
    long = _long(ref, new, cols, "string")
    cnt = long.groupBy("feature", "value", "sample").agg(F.count(F.lit(1)).alias("n"))
    refc = cnt.filter(F.col("sample") == "ref")
    share = refc.groupBy("feature").agg(F.sum("n").alias("_rt"))
    rare = (refc.join(share, "feature").filter(F.col("n") / F.col("_rt") < min_freq)
            .select("feature", "value").withColumn("_rare", F.lit(True)))
    c2 = (cnt.join(rare, ["feature", "value"], "left")
          .withColumn("value", F.when(F.coalesce(F.col("_rare"), F.lit(False)), "__rare__").otherwise(F.col("value")))
          .groupBy("feature", "value", "sample").agg(F.sum("n").alias("n")))
    rows = c2.groupBy("feature", "value").agg(F.sum("n").alias("rt"))
    cols_ = c2.groupBy("feature", "sample").agg(F.sum("n").alias("ct"))
    tot = c2.groupBy("feature").agg(F.sum("n").alias("_total"))
    grid = rows.join(cols_, "feature").join(tot, "feature")
    full = grid.join(c2, ["feature", "value", "sample"], "left").na.fill({"n": 0})
    e = F.col("rt") * F.col("ct") / F.col("_total")
    stat = full.groupBy("feature").agg(
        F.sum(F.pow(F.col("n") - e, 2) / e).alias("chi2"),
        F.count_distinct("value").alias("k"), F.count_distinct("sample").alias("s"))
    return stat.select("feature", F.round("chi2", 6).alias("statistic"),
                       ((F.col("k") - 1) * (F.col("s") - 1)).cast("bigint").alias("dof"))


def chi2_tail(stat, dof):
    """P(a chi-square with ``dof`` degrees of freedom exceeds ``stat``): one less
    the series of the lower incomplete gamma function."""
    a, x = dof / 2.0, stat / 2.0
    whole = F.floor(dof / 2).cast("int")
    # ln gamma(a + 1) from gamma(1) or gamma(1/2) upwards
    half = dof % 2 == 1
    first = F.when(half, F.lit(0.5)).otherwise(F.lit(1.0))
    log_gamma = F.aggregate(F.sequence(F.lit(0), whole), F.when(half, F.lit(0.5 * math.log(math.pi))).otherwise(F.lit(0.0)),
                            lambda s, i: s + F.when(half | (i < whole), F.log(first + i)).otherwise(0.0))
    terms = F.ceil(F.least(x, F.lit(2000.0)) * 2 + 200).cast("int")
    series = F.aggregate(F.sequence(F.lit(1), terms), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
                         lambda c, n: F.struct((c["t"] * x / (a + n)).alias("t"), (c["s"] + c["t"] * x / (a + n)).alias("s")), lambda c: c["s"])
    lower = F.exp(a * F.log(x) - x - log_gamma) * series
    # far beyond the mean nothing is left (and the series would be long)
    return F.when(stat <= 0, 1.0).when(x > a + 30 * F.sqrt(a) + 60, 0.0).otherwise(F.least(F.greatest(1 - lower, F.lit(0.0)), F.lit(1.0)))


def chi2_flags(stats: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``chi2_drift`` with p_value and the flag; a feature with one category has p 1."""
    p = F.when(F.col("dof") > 0, chi2_tail(F.col("statistic"), F.greatest(F.col("dof"), F.lit(1)))).otherwise(1.0)
    return stats.withColumn("p_value", p).withColumn("drift", (F.col("p_value") < alpha).cast("int"))


# D4
def drift_score(flags: DataFrame, gate: float = 0.3, flag: str = "drift") -> DataFrame:
    """Share of flagged features and the gate decision."""
    s = flags.agg(F.avg(F.col(flag).cast("double")).alias("score"), F.count(F.lit(1)).alias("n_features"))
    return s.select(F.round("score", 6).alias("drift_score"), "n_features",
                    (F.col("score") >= gate).alias("drifted"))
