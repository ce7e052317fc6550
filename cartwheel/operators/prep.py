"""Feature preparation (F1-F15): fit on TRAIN, apply anywhere.

Every fitted state is a one-row (or one-row-per-category) parameter table
produced by a single aggregate and broadcast back — the data never passes
through the driver.  The MLlib estimators (Imputer, MinMaxScaler,
OneHotEncoder, PCA, Pipeline) are exposed where they exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.prefix import running_sums
from cartwheel.functions.quantiles import quantile_row


def _quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row of exact quantile arrays (multi-round selection, no column
    gathered into one task; see functions/quantiles.py)."""
    return quantile_row(df, cols, probs)


# F1 ---------------------------------------------------------------- IQR clip
def iqr_bounds(df: DataFrame, cols: Sequence[str], lam: float = 1.5) -> DataFrame:
    """One row: lo_<c>, hi_<c> = Q1 − λ·IQR, Q3 + λ·IQR."""
    q = _quantile_row(df, cols, [0.25, 0.75])
    out = []
    for c in cols:
        q1, q3 = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        out += [(q1 - lam * (q3 - q1)).alias(f"lo_{c}"), (q3 + lam * (q3 - q1)).alias(f"hi_{c}")]
    return q.select(*out)


def iqr_clip(df: DataFrame, bounds: DataFrame, cols: Sequence[str]) -> DataFrame:
    j = df.crossJoin(F.broadcast(bounds))
    return j.select(*[F.least(F.greatest(F.col(c), F.col(f"lo_{c}")), F.col(f"hi_{c}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


class IqrClip(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """MLlib-style estimator: learns IQR bounds on fit, clips (not drops) on transform."""
    lam = Param(Params._dummy(), "lam", "IQR multiplier", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, lam=1.5):
        super().__init__()
        self._setDefault(lam=1.5)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        row = iqr_bounds(df, cols, self.getOrDefault(self.lam)).first()  # 2 numbers per column
        m = IqrClipModel()
        m._set(inputCols=cols, bounds=[[row[f"lo_{c}"], row[f"hi_{c}"]] for c in cols])
        return m


class IqrClipModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    bounds = Param(Params._dummy(), "bounds", "per-column [lo, hi]", typeConverter=TypeConverters.toList)

    def __init__(self):
        super().__init__()

    def _transform(self, df):
        cols = self.getInputCols()
        b = dict(zip(cols, self.getOrDefault(self.bounds)))
        return df.select(*[F.least(F.greatest(F.col(c), F.lit(b[c][0])), F.lit(b[c][1])).alias(c) if c in b else F.col(c)
                           for c in df.columns])


# F2 / F3 ------------------------------------------------------------ imputation
def impute_stats(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    if strategy == "mean":
        return df.agg(*[F.avg(c).alias(f"fill_{c}") for c in cols])
    if strategy == "median":
        q = _quantile_row(df, cols, [0.5])
        return q.select(*[F.col(f"_q_{c}")[0].alias(f"fill_{c}") for c in cols])
    raise ValueError(strategy)


def mode_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column, smallest on ties (one row)."""
    parts = []
    for c in cols:
        cnt = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(cnt.agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias(f"fill_{c}")))
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)
    return out


def apply_fill(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    j = df.crossJoin(F.broadcast(stats))
    return j.select(*[F.coalesce(F.col(c), F.col(f"fill_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean", fit_on: DataFrame | None = None) -> DataFrame:
    src = fit_on if fit_on is not None else df
    st = mode_stats(src, cols) if strategy == "mode" else impute_stats(src, cols, strategy)
    return apply_fill(df, st, cols)


def mllib_imputer(cols: Sequence[str], strategy: str = "mean"):
    from pyspark.ml.feature import Imputer
    return Imputer(inputCols=list(cols), outputCols=[f"{c}_imp" for c in cols], strategy=strategy)


# F4 ------------------------------------------------------------------ kNN imputation
def impute_knn(df: DataFrame, id_col: str, target: str, features: Sequence[str], k: int = 5) -> DataFrame:
    """Fill ``target`` where null with the inverse-distance-weighted mean of the
    k nearest donors (rows with a target).

    The distance is taken over the features that both rows have, scaled up to
    the number of all features; with none in common the row takes the donors'
    mean; a donor at distance 0 gives its value (the largest, if there are
    several).  No donor at all leaves nulls.  The search is that of
    ``neighbours``: a partition tree over all features with true boxes, in two
    rounds.  ``neighbours.impute_knn_columns`` fills several columns."""
    from cartwheel.operators.neighbours import fill_from_neighbours
    return fill_from_neighbours(df, id_col, target, features, k)


# F5 / F6 / F7 ----------------------------------------------------------- scaling
def min_max(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    src = fit_on if fit_on is not None else df
    st = src.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.max(c).alias(f"mx_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(st))
    def sc(c):
        rng = F.col(f"mx_{c}") - F.col(f"mn_{c}")
        return F.when(rng > 0, (F.col(c) - F.col(f"mn_{c}")) / rng).otherwise(F.lit(0.0)).alias(c)
    return j.select(*[sc(c) if c in cols else F.col(c) for c in df.columns])


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x − mean) / population std (0 when the std is 0)."""
    src = fit_on if fit_on is not None else df
    st = src.agg(*[F.avg(c).alias(f"mu_{c}") for c in cols], *[F.stddev_pop(c).alias(f"sd_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(st))
    def sc(c):
        return F.when(F.col(f"sd_{c}") > 0, (F.col(c) - F.col(f"mu_{c}")) / F.col(f"sd_{c}")).otherwise(F.lit(0.0)).alias(c)
    return j.select(*[sc(c) if c in cols else F.col(c) for c in df.columns])


def robust_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x − median) / IQR (IQR 0 → scale 1), exact percentiles."""
    src = fit_on if fit_on is not None else df
    q = _quantile_row(src, cols, [0.25, 0.5, 0.75])
    j = df.crossJoin(F.broadcast(q))
    def sc(c):
        a = F.col(f"_q_{c}")
        iqr = a[2] - a[0]
        return ((F.col(c) - a[1]) / F.when(iqr > 0, iqr).otherwise(F.lit(1.0))).alias(c)
    return j.select(*[sc(c) if c in cols else F.col(c) for c in df.columns])


# F8
def scale_mixed(df: DataFrame, cols: Sequence[str], skewed: Sequence[str]) -> DataFrame:
    """log1p + robust scaling for the skewed columns, standard scaling for the rest."""
    logged = df.select(*[F.log1p(F.col(c)).alias(c) if c in skewed else F.col(c) for c in df.columns])
    r = robust_scale(logged, [c for c in cols if c in skewed]) if skewed else logged
    rest = [c for c in cols if c not in skewed]
    return standardize(r, rest) if rest else r


# F9 / F10 ------------------------------------------------------------- encoding
def category_table(df: DataFrame, col: str, min_freq: float = 0.0) -> DataFrame:
    """Categories seen on the fitting data with their share; below ``min_freq``
    they map to '__rare__'."""
    cnt = df.groupBy(F.col(col).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    tot = cnt.agg(F.sum("n").alias("_t"))
    j = cnt.crossJoin(F.broadcast(tot))
    return j.select("category", F.when(F.col("n") / F.col("_t") < min_freq, F.lit("__rare__"))
                    .otherwise(F.col("category")).alias("code"))


def one_hot(df: DataFrame, col: str, categories: Sequence[str], rare: bool = False) -> DataFrame:
    """0/1 column per known category; unseen values get all zeros, or the
    '__rare__' column when ``rare``."""
    x = F.col(col)
    out = [F.col(c) for c in df.columns if c != col]
    known = [c for c in categories if c != "__rare__"]
    for c in known:
        out.append((x == F.lit(c)).cast("int").alias(f"{col}_{c}"))
    if rare:
        out.append((~x.isin(known) | x.isNull()).cast("int").alias(f"{col}___rare__"))
    return df.select(*out)


def rare_bucket(df: DataFrame, col: str, min_freq: float, fit_on: DataFrame | None = None) -> DataFrame:
    """Replace categories whose TRAIN share is below ``min_freq`` (and unseen
    ones) by '__rare__' via a join on the fitted category table."""
    src = fit_on if fit_on is not None else df
    t = category_table(src, col, min_freq)
    j = df.join(t.withColumnRenamed("category", col), col, "left")
    return j.withColumn(col, F.coalesce(F.col("code"), F.lit("__rare__"))).drop("code")


class FillMissing(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the exact median or the mean of each column on fit; null and NaN take it on transform."""
    strategy = Param(Params._dummy(), "strategy", "median or mean", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, strategy="median"):
        super().__init__()
        self._setDefault(strategy="median")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        seen = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
        row = impute_stats(seen, cols, self.getOrDefault(self.strategy)).first()  # a number per column
        m = FillMissingModel()
        m._set(inputCols=cols, fills=[float(row[f"fill_{c}"]) if row[f"fill_{c}"] is not None else 0.0 for c in cols])
        return m


class FillMissingModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A column without any value on fit is filled with 0."""
    fills = Param(Params._dummy(), "fills", "value per column", typeConverter=TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def _transform(self, df):
        fill = dict(zip(self.getInputCols(), self.getOrDefault(self.fills)))
        return df.withColumns({f"{c}__imp": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(v)) for c, v in fill.items()})


class RareBucket(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the categories whose share is at least ``minShare`` on fit (at most
    1 / minShare a column); on transform the others, unseen ones and null are
    '__rare__', or with ``bucket`` false '__other__', which no column encodes."""
    minShare = Param(Params._dummy(), "minShare", "least share of a category", typeConverter=TypeConverters.toFloat)
    bucket = Param(Params._dummy(), "bucket", "whether rare categories have a column", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols=None, minShare=0.01, bucket=True):
        super().__init__()
        self._setDefault(minShare=0.01, bucket=True)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols, least = self.getInputCols(), self.getOrDefault(self.minShare)
        if least <= 0:
            raise ValueError("minShare bounds the categories that are kept; it must be above 0")
        n = df.count()
        kept = []
        for c in cols:
            rows = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).count().where(F.col("count") >= least * n)
            kept.append([r.v for r in rows.orderBy(F.desc("count"), "v").collect()])
        m = RareBucketModel()
        m._set(inputCols=cols, kept=kept, bucket=self.getOrDefault(self.bucket))
        return m


class RareBucketModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``<column>__oh``: a 0/1 vector, a place for each kept category by falling count, then one for the rare ones."""
    kept = Param(Params._dummy(), "kept", "kept categories per column", typeConverter=TypeConverters.toList)
    bucket = Param(Params._dummy(), "bucket", "whether rare categories have a column", typeConverter=TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()

    def _transform(self, df):
        from pyspark.ml.functions import array_to_vector
        rare, out = self.getOrDefault(self.bucket), {}
        for c, kept in zip(self.getInputCols(), self.getOrDefault(self.kept)):
            v = F.col(c).cast("string")
            flags = [F.coalesce((v == k).cast("double"), F.lit(0.0)) for k in kept]
            if rare:
                flags.append(F.lit(1.0) - sum(flags, F.lit(0.0)))
            out[f"{c}__oh"] = array_to_vector(F.array(*flags) if flags else F.array().cast("array<double>"))
        return df.withColumns(out)


def build_preprocess(num: Sequence[str], cat: Sequence[str], scaler: str = "standard",
                     impute_strategy: str = "median", min_share: float = 0.01, rare: bool = True) -> Pipeline:
    """one fitted pipeline — exact impute → assemble → scale numerics; rare
    bucket → one-hot categoricals (with ``rare`` the categories below
    ``min_share`` and unseen ones share a column, else they are all zeros); one
    features vector."""
    from pyspark.ml.feature import MinMaxScaler, RobustScaler, StandardScaler, VectorAssembler
    stages = []
    if num:
        stages.append(FillMissing(inputCols=list(num), strategy=impute_strategy))
        stages.append(VectorAssembler(inputCols=[f"{c}__imp" for c in num], outputCol="_num_vec", handleInvalid="keep"))
        sc = {"standard": StandardScaler(inputCol="_num_vec", outputCol="_num_scaled", withMean=True, withStd=True),
              "minmax": MinMaxScaler(inputCol="_num_vec", outputCol="_num_scaled"),
              "robust": RobustScaler(inputCol="_num_vec", outputCol="_num_scaled")}[scaler]
        stages.append(sc)
    if cat:
        stages.append(RareBucket(inputCols=list(cat), minShare=min_share, bucket=rare))
    stages.append(VectorAssembler(inputCols=(["_num_scaled"] if num else []) + [f"{c}__oh" for c in cat], outputCol="features"))
    return Pipeline(stages=stages)


# F12
def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(class, n, weight = n_total / (k · n_c)) and the neg/pos ratio."""
    cnt = df.groupBy(F.col(label).alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    tot = cnt.agg(F.sum("n").alias("_t"), F.count(F.lit(1)).alias("_k"),
                  (F.sum(F.when(F.col("cls") == 0, F.col("n"))) / F.sum(F.when(F.col("cls") == 1, F.col("n")))).alias("neg_pos_ratio"))
    j = cnt.crossJoin(F.broadcast(tot))
    return j.select("cls", "n", F.round(F.col("_t") / (F.col("_k") * F.col("n")), 6).alias("weight"),
                    F.round("neg_pos_ratio", 6).alias("neg_pos_ratio"))


def with_weight_col(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(F.col("cls").alias(label), F.col("weight").alias(out))
    return df.join(F.broadcast(w), label)  # one row per class


# F13
HOT_SHARE = 1000


def mid_ranks(df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """Average ranks (ties share the mean rank) per column, long form
    (id, feature, rank), via value counts + distributed running sums.
    A value held by more than 1/HOT_SHARE of a feature's rows gets its rank
    from a broadcast (at most HOT_SHARE values a feature), so it never becomes
    a hot join key."""
    long = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [id_col], list(cols), "feature", "value").filter(F.col("value").isNotNull())
    cnt = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    cum = running_sums(cnt, "value", ["n"], keys=["feature"])
    total = cum.groupBy("feature").agg(F.sum("n").alias("_all"))
    r = cum.join(F.broadcast(total), "feature").select(  # one row per feature
        "feature", "value", (F.col("n_cum") - F.col("n") + (F.col("n") + 1) / 2.0).alias("rank"),
        (F.col("n") * HOT_SHARE > F.col("_all")).alias("_hot"))
    hot, rest = F.broadcast(r.filter("_hot")), r.filter("NOT _hot")
    common = long.join(hot, ["feature", "value"])
    others = long.join(hot, ["feature", "value"], "left_anti").join(rest, ["feature", "value"])
    return common.unionByName(others).select(id_col, "feature", "rank")


def spearman(df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """Spearman ρ for every pair a < b, long form (a, b, rho)."""
    ranks = mid_ranks(df, cols, id_col)
    wide = ranks.groupBy(id_col).pivot("feature", list(cols)).agg(F.first("rank"))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = wide.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"{a}__{b}"), 6).alias("rho")) for a, b in pairs
    ])).alias("s")).select("s.*")


# F14
def centrality(corr_long: DataFrame) -> DataFrame:
    """Sum of |ρ| over partners per feature, highest first."""
    both = corr_long.select(F.col("a").alias("feature"), "rho").unionByName(
        corr_long.select(F.col("b").alias("feature"), "rho"))
    return both.groupBy("feature").agg(F.round(F.sum(F.abs("rho")), 6).alias("centrality"))


def pick_representatives(cent: DataFrame, groups: DataFrame) -> DataFrame:
    """Per group, the most central feature (ties by name)."""
    j = cent.join(groups, "feature")
    return j.groupBy("group").agg(F.min_by("feature", F.struct(-F.col("centrality"), F.col("feature"))).alias("representative"))


# F15
def pca(df: DataFrame, cols: Sequence[str], k: int = 2):
    """Standardise (population std), then MLlib PCA; returns (projected df,
    explained variance list)."""
    from pyspark.ml.feature import PCA, VectorAssembler
    z = standardize(df, cols)
    v = VectorAssembler(inputCols=list(cols), outputCol="_z").transform(z)
    model = PCA(k=k, inputCol="_z", outputCol="pca").fit(v)
    return model.transform(v).drop("_z"), list(model.explainedVariance.toArray())
