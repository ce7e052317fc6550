"""Interpretability (X1-X11) and rules (W14 in windows.py).

Explanations are generated as rows and scored in bulk: a permutation, a
grid point or a coalition is a tagged copy of the (sampled) input, all copies
go through ONE ``model.transform``, and the metric is a grouped aggregate.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.prefix import running_sums
from cartwheel.operators.models import assemble


# X1
def importances(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """Model importances normalised to sum 1, highest first."""
    imp = model.featureImportances.toArray() if hasattr(model, "featureImportances") else abs(model.coefficients.toArray())
    tot = float(sum(imp)) or 1.0
    return sorted(((n, float(v) / tot) for n, v in zip(names, imp)), key=lambda r: (-r[1], r[0]))


def grouped_auc(scored: DataFrame, keys: Sequence[str], score: str = "score", y: str = "y") -> DataFrame:
    """Exact ROC AUC per group (Mann–Whitney on distinct scores)."""
    keys = list(keys)
    c = scored.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    c = running_sums(c, "score", ["neg"], keys=keys)
    t = c.groupBy(*keys).agg(F.sum(F.col("pos") * (F.col("neg_cum") - 0.5 * F.col("neg"))).alias("u"),
                             F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return t.select(*keys, (F.col("u") / (F.col("P") * F.col("N"))).alias("auc"))


def _proba(model, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    s = model.transform(assemble(df, cols))
    return s.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


# X2
def permutation_importance(model, df: DataFrame, cols: Sequence[str], label: str, id_col: str,
                           repeats: int = 30, seed: int = 7) -> DataFrame:
    """Mean and std of the AUC drop when one feature's values are permuted.
    A permutation is a join of the row order by id with the row order by
    md5(id|feature|repeat) — one copy per (feature, repeat), scored together."""
    spark = df.sparkSession
    base = grouped_auc(_proba(model, df, cols).withColumn("_g", F.lit(0)).withColumnRenamed(label, "y"), ["_g"]).first()["auc"]
    reps = spark.range(repeats).select(F.col("id").cast("int").alias("rep"))
    feats = spark.createDataFrame([(c,) for c in cols], "feature string")
    tags = feats.crossJoin(reps)  # features × repeats: parameter-bounded
    # positions are distributed running counts, so a permutation runs over all
    # rows and no window holds a whole copy of the data in one task
    rows = running_sums(df.select(id_col, label, *cols, F.lit(1).alias("_one")), id_col, ["_one"]).withColumnRenamed("_one_cum", "_pos")
    copies = rows.crossJoin(F.broadcast(tags))
    key = F.concat_ws("|", F.col(id_col).cast("string"), F.col("feature"), F.col("rep").cast("string"), F.lit(str(seed)))
    stack = F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("double"))])
    donor = copies.select("feature", "rep", "_one", F.md5(key).alias("_h"), stack[F.col("feature")].alias("_val"))
    dv = running_sums(donor, "_h", ["_one"], keys=["feature", "rep"]).select("feature", "rep", F.col("_one_cum").alias("_pos"), "_val")
    j = copies.join(dv, ["feature", "rep", "_pos"])
    perm = j.select(id_col, label, "feature", "rep",
                    *[F.when(F.col("feature") == c, F.col("_val")).otherwise(F.col(c).cast("double")).alias(c) for c in cols])
    s = _proba(model, perm, cols).withColumnRenamed(label, "y")
    auc = grouped_auc(s, ["feature", "rep"])
    return auc.groupBy("feature").agg(F.round(F.lit(base) - F.avg("auc"), 6).alias("importance_mean"),
                                      F.round(F.stddev_pop("auc"), 6).alias("importance_std"))


# X3
def pdp(model, df: DataFrame, cols: Sequence[str], col: str, grid: int = 30) -> DataFrame:
    """Partial dependence: mean P(1) over all rows with ``col`` set to each of
    ``grid`` evenly spaced values between its 5th and 95th percentiles."""
    from cartwheel.functions.quantiles import quantile_row
    q = quantile_row(df, [col], [0.05, 0.95]).select(F.col(f"_q_{col}")[0].alias("lo"), F.col(f"_q_{col}")[1].alias("hi"))
    pts = q.select(F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g"), "lo", "hi").select(
        "g", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("g") / (grid - 1)).alias("value"))
    j = df.crossJoin(F.broadcast(pts)).withColumn(col, F.col("value"))  # grid points are a parameter
    return _proba(model, j, cols).groupBy("g", "value").agg(F.avg("score").alias("mean_proba"))


# X4 — linear closed form (model-free form below is sampled)
def linear_contributions(df: DataFrame, weights: dict[str, float], id_col: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Exact Shapley values of a linear margin b + Σ w_j x_j: φ_j = w_j (x_j − E[x_j]);
    long form (id, feature, contribution); base value = margin at the means."""
    src = fit_on if fit_on is not None else df
    means = src.agg(*[F.avg(c).alias(f"_m_{c}") for c in weights])
    j = df.crossJoin(F.broadcast(means))
    wide = j.select(id_col, *[(F.lit(w) * (F.col(c) - F.col(f"_m_{c}"))).alias(c) for c, w in weights.items()])
    return wide.unpivot([id_col], list(weights), "feature", "contribution")


def sampled_shapley(model, df: DataFrame, cols: Sequence[str], id_col: str, background: DataFrame,
                    n_perm: int = 16, seed: int = 7) -> DataFrame:
    """Permutation-sampling Shapley values of P(1): for each row and sampled
    feature order, the marginal gain of adding each feature on top of a
    background row.  All coalitions are generated rows scored in one pass."""
    spark = df.sparkSession
    d = len(cols)
    bg = background.select(*[F.avg(c).alias(c) for c in cols])  # mean background row
    perms = spark.range(n_perm).select(F.col("id").cast("int").alias("perm"))
    steps = spark.range(d + 1).select(F.col("id").cast("int").alias("step"))
    base = df.select(id_col, *cols).crossJoin(F.broadcast(perms)).crossJoin(F.broadcast(steps))
    # position of feature c in permutation p: rank of md5(c|p|seed)
    keys = {c: F.md5(F.concat_ws("|", F.lit(c), F.col("perm").cast("string"), F.lit(str(seed)))) for c in cols}
    pos = {c: sum((F.when(keys[o] < keys[c], 1).otherwise(0) for o in cols if o != c), F.lit(0)) for c in cols}
    b = bg.first()  # d numbers
    rows = base.select(id_col, "perm", "step",
                       *[F.when(pos[c] < F.col("step"), F.col(c)).otherwise(F.lit(float(b[c]))).alias(c) for c in cols],
                       F.array(*[F.struct(F.lit(c).alias("f"), pos[c].alias("p")) for c in cols]).alias("_pos"))
    s = _proba(model, rows, cols)
    w = Window.partitionBy(id_col, "perm").orderBy("step")
    g = s.withColumn("gain", F.col("score") - F.lag("score").over(w)).filter(F.col("step") > 0)
    g = g.withColumn("feature", F.filter("_pos", lambda x: x["p"] == F.col("step") - 1)[0]["f"])
    return g.groupBy(id_col, "feature").agg(F.avg("gain").alias("contribution"))


# X5
def global_contrib(contrib: DataFrame, k: int = 10) -> DataFrame:
    g = contrib.groupBy("feature").agg(F.round(F.avg(F.abs("contribution")), 6).alias("mean_abs"))
    return g.orderBy(F.desc("mean_abs"), "feature").limit(k)


# X6
def local_contrib(contrib: DataFrame, chosen: DataFrame, id_col: str, k: int = 10) -> DataFrame:
    """Top-k |contribution| features of the chosen rows (a small id list)."""
    j = contrib.join(F.broadcast(chosen), id_col)
    w = Window.partitionBy(id_col).orderBy(F.desc(F.abs("contribution")), "feature")
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def choose_rows(scored: DataFrame, id_col: str, threshold: float, score: str = "score") -> DataFrame:
    """Highest score, nearest the threshold, lowest score (ties by id)."""
    hi = scored.orderBy(F.desc(score), id_col).limit(1).withColumn("which", F.lit("highest"))
    near = scored.orderBy(F.abs(F.col(score) - threshold), id_col).limit(1).withColumn("which", F.lit("nearest_threshold"))
    lo = scored.orderBy(F.asc(score), id_col).limit(1).withColumn("which", F.lit("lowest"))
    return hi.unionByName(near).unionByName(lo).select(id_col, "which")


# X7
def interactions(model, df: DataFrame, cols: Sequence[str], id_col: str, top: int = 15) -> DataFrame:
    """Pairwise interaction strength: mean |f(x_ij) − f(x_i) − f(x_j) + f(x_∅)|
    where x_S keeps the features in S and puts the rest at their means."""
    spark = df.sparkSession
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    subsets = [()] + [(a,) for a in cols] + [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    tag = spark.createDataFrame([("|".join(s),) for s in subsets], "subset string")
    base = df.select(id_col, *cols).crossJoin(F.broadcast(tag))
    keep = {c: F.array_contains(F.split("subset", r"\|"), c) for c in cols}
    rows = base.select(id_col, "subset", *[F.when(keep[c], F.col(c)).otherwise(F.lit(float(means[c]))).alias(c) for c in cols])
    s = _proba(model, rows, cols).groupBy(id_col).pivot("subset", ["|".join(x) for x in subsets]).agg(F.first("score"))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    stat = s.agg(*[F.avg(F.abs(F.col(f"{a}|{b}") - F.col(a) - F.col(b) + F.col(""))).alias(f"{a}|{b}") for a, b in pairs])
    long = stat.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "strength")
    return long.orderBy(F.desc("strength"), "pair").limit(top)


# X8
def rfe(train: DataFrame, valid: DataFrame, ranked: Sequence[str], label: str, make, ks: Sequence[int]) -> DataFrame:
    """Refit on the top-k ranked features for each k; precision on VALID at 0.5."""
    rows = []
    for k in ks:
        feats = list(ranked[:k])
        m = make().fit(assemble(train, feats))
        s = m.transform(assemble(valid, feats)).select(F.col(label).alias("y"), F.col("prediction").cast("int").alias("y_hat"))
        r = s.agg(F.count_if((F.col("y") == 1) & (F.col("y_hat") == 1)).alias("tp"),
                  F.count_if(F.col("y_hat") == 1).alias("pp")).first()
        rows.append((k, (r["tp"] / r["pp"]) if r["pp"] else 0.0))
    return train.sparkSession.createDataFrame(rows, "k int, precision double").orderBy(F.desc("precision"), "k")


def rfe_refit(train: DataFrame, valid: DataFrame, cols: Sequence[str], label: str, make) -> DataFrame:
    """Recursive elimination: fit on the features left, drop the least important
    (ties: the later one), until one is left.  One row a number of features:
    k, features (by falling importance), accuracy, precision, recall, f1 on
    VALID at 0.5, chosen (the highest precision; ties: fewer features)."""
    left, rows = list(cols), []
    while left:
        m = make().fit(assemble(train, left))
        ranked = [n for n, _ in importances(m, left)]
        s = m.transform(assemble(valid, left)).select(F.col(label).alias("y"), F.col("prediction").alias("p"))
        r = s.agg(F.count("*").alias("n"), *[F.count_if((F.col("y") == a) & (F.col("p") == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)]).first()
        tp, fp, fn = r["c11"], r["c01"], r["c10"]
        rows.append((len(left), ranked, (tp + r["c00"]) / r["n"] if r["n"] else 0.0, tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0,
                     2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0))
        left = [c for c in left if c != ranked[-1]]
    best = max(rows, key=lambda r: (r[3], -r[0]))[0] if rows else None
    return train.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows],
                                              "k int, features array<string>, accuracy double, precision double, recall double, f1 double, chosen boolean")


# X9
def fire_rules(df: DataFrame, rules: DataFrame, row_id: str, cols: Sequence[str]) -> DataFrame:
    """Rule conditions (rule, column, op, lo, hi) applied to every row →
    (row, rule) for the rules whose conditions all hold.  The rule table is
    small and broadcast into the unpivoted row stream."""
    long = df.select(row_id, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot([row_id], list(cols), "column", "value")
    j = long.join(F.broadcast(rules), "column")
    v, lo, hi, op = F.col("value"), F.col("lo"), F.col("hi"), F.col("op")
    cond = (F.when(op == "<", v < lo).when(op == "<=", v <= lo).when(op == ">", v > lo).when(op == ">=", v >= lo)
            .when(op == "=", v == lo).when(op == "between", (v > lo) & (v <= hi)).otherwise(F.lit(False)))
    n_cond = rules.groupBy("rule").agg(F.count(F.lit(1)).alias("n_conditions"))
    held = j.groupBy(row_id, "rule").agg(F.count_if(F.coalesce(cond, F.lit(False))).alias("_ok"))
    return held.join(F.broadcast(n_cond), "rule").filter(F.col("_ok") == F.col("n_conditions")).select(row_id, "rule", "n_conditions")


# X10
def evaluate_rules(df: DataFrame, fired: DataFrame, row_id: str, label: str) -> DataFrame:
    """Per rule: covered, coverage, precision; plus the union of all rules."""
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    j = fired.join(df.select(row_id, label), row_id)
    per = j.groupBy("rule").agg(F.count(F.lit(1)).alias("covered"), F.avg(F.col(label).cast("double")).alias("precision"))
    union_rows = j.select(row_id, label).distinct()
    uni = union_rows.agg(F.count(F.lit(1)).alias("covered"), F.avg(F.col(label).cast("double")).alias("precision")) \
        .select(F.lit(-1).alias("rule"), "*")
    both = per.unionByName(uni).crossJoin(F.broadcast(n))
    return both.select("rule", "covered", F.round(F.col("covered") / F.col("_n"), 6).alias("coverage"),
                       F.round("precision", 6).alias("precision"))


# X11
def find_rule(df: DataFrame, row: dict, cols: Sequence[str], label: str, target_precision: float = 0.95,
              max_len: int = 4) -> list[tuple[str, float, float]]:
    """Greedy anchor: features discretised to quartiles; start from the empty
    rule and add the predicate 'feature in the row's quartile' that gives the
    highest precision (ties: coverage), until the precision target is met.
    Each step is ONE aggregate over all candidate predicates."""
    from cartwheel.functions.quantiles import column_quantiles
    q = {c: e for c, (_, e) in column_quantiles(df, cols, [0.25, 0.5, 0.75]).items()}
    def bin_of(c, v):
        e = q[c]
        return sum(1 for x in e if v > x)
    def bin_col(c):
        edges = F.array(*[F.lit(float(x)) for x in q[c]])
        return F.size(F.filter(edges, lambda e: F.col(c) > e))
    bins = {c: bin_col(c) for c in cols}
    target = {c: bin_of(c, row[c]) for c in cols}
    chosen: list[str] = []
    trail = []
    cur = df
    for _ in range(max_len):
        rest = [c for c in cols if c not in chosen]
        if not rest:
            break
        aggs = []
        for c in rest:
            m = bins[c] == target[c]
            aggs += [F.count_if(m).alias(f"n_{c}"), F.sum(F.when(m, F.col(label))).alias(f"p_{c}")]
        r = cur.agg(*aggs).first()
        best = max(rest, key=lambda c: ((r[f"p_{c}"] or 0) / r[f"n_{c}"] if r[f"n_{c}"] else -1, r[f"n_{c}"], c))
        prec = (r[f"p_{best}"] or 0) / r[f"n_{best}"] if r[f"n_{best}"] else 0.0
        chosen.append(best)
        cur = cur.filter(bins[best] == target[best])
        trail.append((f"{best} in quartile {target[best] + 1}", prec, r[f"n_{best}"]))
        if prec >= target_precision:
            break
    return trail


def precision_bound(hits: int, n: int, delta: float) -> float:
    """Lower bound of a share of which ``hits`` of ``n`` rows were seen: the true
    share lies above it but for a chance of ``delta`` (relative entropy bound,
    rounded down to four places)."""
    if not n or not hits:
        return 0.0
    p, need = hits / n, -math.log(delta)

    def far(g):  # g / 10^4 is too small a share to give p
        q = g / 1e4
        return q <= 0 or n * (p * math.log(p / q) + ((1 - p) * math.log((1 - p) / (1 - q)) if p < 1 else 0.0)) >= need

    lo, hi = 0, int(math.floor(p * 1e4))
    while lo < hi:  # shares below p are the farther the smaller
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if far(mid) else (lo, mid - 1)
    return lo / 1e4


def quartile_edges(df: DataFrame, cols: Sequence[str]) -> dict[str, list[float]]:
    from cartwheel.functions.quantiles import column_quantiles
    return {c: e for c, (_, e) in column_quantiles(df, list(cols), [0.25, 0.5, 0.75]).items()}


def anchor_rule(df: DataFrame, row: dict, cols: Sequence[str], label: str, target: float = 0.95, delta: float = 0.05,
                max_len: int = 4, beam: int = 6, edges: dict[str, list[float]] | None = None) -> dict:
    """A short rule that fits ``row`` and whose rows have the row's label with a
    precision of at least ``target``, by beam search over predicates "feature in
    the row's quartile".

    Each length is one aggregate over all extensions of the beam, on all rows.
    A rule is accepted when the lower bound of its precision reaches the target;
    ``delta`` is shared by all rules that could be looked at, so the bound holds
    for whatever rule the search ends with.  Of the accepted rules of the
    least length the one that covers most rows is returned (ties: by column
    order).  If none is accepted, ``reached`` is False and the rule with the
    highest bound is returned (ties: more rows, then shorter)."""
    cols = list(cols)
    edges = edges or quartile_edges(df, cols)
    quartile = {c: sum(row[c] > x for x in edges[c]) for c in cols}
    fits = {c: F.coalesce(sum((F.col(c) > float(x)).cast("int") for x in edges[c]) == quartile[c], F.lit(False)) for c in cols}
    share = delta / sum(math.comb(len(cols), k) for k in range(1, min(max_len, len(cols)) + 1))
    marked = df.select(*[fits[c].alias(f"f{i}") for i, c in enumerate(cols)], (F.col(label) == row[label]).alias("same"))
    total, found, front = None, [], [()]
    for _ in range(min(max_len, len(cols))):
        tried = sorted({tuple(sorted({*rule, i})) for rule in front for i in range(len(cols)) if i not in rule})
        both = {r: functools.reduce(lambda a, b: a & b, [F.col(f"f{i}") for i in r]) for r in tried}
        got = marked.agg(F.count("*").alias("all"), *[F.count_if(m).alias(f"n{k}") for k, m in enumerate(both.values())],
                         *[F.count_if(m & F.col("same")).alias(f"h{k}") for k, m in enumerate(both.values())]).first()
        total = got["all"]
        level = [dict(rule=r, n=got[f"n{k}"], hits=got[f"h{k}"], bound=precision_bound(got[f"h{k}"], got[f"n{k}"], share)) for k, r in enumerate(tried)]
        found += level
        if any(r["bound"] >= target for r in level):
            break
        front = [r["rule"] for r in sorted(level, key=lambda r: (-r["bound"], -r["n"], r["rule"]))[:beam]]
    good = [r for r in found if r["bound"] >= target]
    best = (min(good, key=lambda r: (-r["n"], r["rule"])) if good
            else min(found, key=lambda r: (-r["bound"], -r["n"], len(r["rule"]), r["rule"])))
    return {"rule": " AND ".join(f"{cols[i]} in quartile {quartile[cols[i]] + 1}" for i in best["rule"]), "covered": best["n"],
            "coverage": best["n"] / total if total else 0.0, "precision": best["hits"] / best["n"] if best["n"] else 0.0,
            "lower_bound": best["bound"], "reached": bool(good)}
