"""Window features.

Every window names a total order.  The per-pair features W1-W6 share one
window specification, so Spark plans ONE shuffle on (customer, product) and
one sort for all of them.  Population priors (W7, W8) are computed on the
pre-aggregated (key, week) table and joined back, so a popular product
never becomes one giant window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.aggs import days_between

PAIR = ("customer_id", "product_id")


def pair_window(keys: Sequence[str] = PAIR, order: str = "week_idx"):
    return Window.partitionBy(*keys).orderBy(order)


# W1
def prev_bought_lagged(w=None):
    w = w or pair_window()
    return F.coalesce(F.lag("bought", 1).over(w), F.lit(0))


# W2
def prev_bought_inclusive(w=None):
    w = (w or pair_window()).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("bought").over(w), F.lit(0)).cast("bigint")


# W3
def count_lagged(n: int, w=None):
    """Purchases in the n previous rows, current excluded; null on the first row."""
    return F.sum("bought").over((w or pair_window()).rowsBetween(-n, -1)).cast("bigint")


# W4
def count_inclusive(n: int, w=None):
    return F.sum("bought").over((w or pair_window()).rowsBetween(-(n - 1), 0)).cast("bigint")


def count_calendar(n: int, keys: Sequence[str] = PAIR):
    """Calendar variant of W4: purchases in the last n periods by index range."""
    w = Window.partitionBy(*keys).orderBy("week_idx").rangeBetween(-(n - 1), 0)
    return F.sum("bought").over(w).cast("bigint")


# W5
def recency_lagged(w=None, default: int = 999):
    last = F.max(F.when(F.col("bought") == 1, F.col("week_idx"))).over(
        (w or pair_window()).rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce((F.col("week_idx") - last), F.lit(default)).cast("bigint")


# W6
def recency_inclusive(w=None):
    last = F.max(F.when(F.col("bought") == 1, F.col("week_idx"))).over(
        (w or pair_window()).rowsBetween(Window.unboundedPreceding, 0))
    return (F.col("week_idx") - last).cast("bigint")


def add_pair_features(df: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """W1-W6 in one pass over a (pair, week_idx, bought) relation."""
    w = pair_window(keys)
    return df.select(
        "*",
        prev_bought_lagged(w).alias("cp_prev_bought_lagged"),
        prev_bought_inclusive(w).alias("cp_prev_bought"),
        count_lagged(4, w).alias("cp_count_4w_lagged"),
        count_lagged(12, w).alias("cp_count_12w_lagged"),
        count_inclusive(4, w).alias("cp_count_4w"),
        count_inclusive(12, w).alias("cp_count_12w"),
        recency_lagged(w).alias("cp_recency_lagged"),
        recency_inclusive(w).alias("cp_recency"),
    )


def buys_before(active: str, n_weeks: str) -> Column:
    """Number of active weeks before each week 0, 1, …, ``n_weeks`` + 1, from the
    sorted active weeks: every count is repeated until the next active week."""
    a, end = F.col(active), F.col(n_weeks) + 1
    held = F.transform(a, lambda w, i: F.array_repeat(i + 1, (F.coalesce(F.get(a, i + 1), end) - w).cast("int")))
    return F.when(F.size(a) > 0, F.concat(F.array_repeat(F.lit(0), F.get(a, F.lit(0)).cast("int") + 1), F.flatten(held))).otherwise(
        F.array_repeat(F.lit(0), (end + 1).cast("int")))


ROW_SHIFTS = (-12, -11, -4, -3, -1, 0, 1, 2)  # rows around a row that W1-W6 and the label look at


def buys_around(buys: Column, copies: str, copy: str, n_weeks: str) -> list[Column]:
    """For every shift d of ``ROW_SHIFTS`` a list: in each week, the buys of the pair
    before the row that is d rows after its own.  One copy's lists are cuts of ``buys``."""
    b, m, i, n = buys, F.col(copies), F.col(copy), F.col(n_weeks).cast("int")
    padded = F.concat(F.array_repeat(F.lit(0), -ROW_SHIFTS[0]), b)

    def before(d):
        def at(t):
            r = F.greatest(t * m + i + d, F.lit(0))
            w = F.floor(r / m).cast("int")
            return (m * F.get(b, w) + (r - w * m) * (F.coalesce(F.get(b, w + 1), F.get(b, w)) - F.get(b, w))).cast("int")
        return at

    return [F.when(m == 1, F.slice(padded, d - ROW_SHIFTS[0] + 1, n)).otherwise(
        F.transform(F.sequence(F.lit(0), n - 1), before(d))) for d in ROW_SHIFTS]


def pair_features_at(active: str, week: str, copies: str, copy: str, n_weeks: str,
                     buys: str | None = None, around: Sequence[str] = ()) -> dict[str, Column]:
    """W1-W6 and the next row's ``bought`` (label) of a dense row, as
    ``add_pair_features`` gives them, from the pair's sorted active weeks alone:
    no window.  A pair has ``copies`` rows in every week, numbered by ``copy``.
    ``buys`` and ``around`` hold ``buys_before`` and ``buys_around``, made once a
    pair: each row then only looks up a few numbers, in generated code."""
    a, t = F.col(active), F.col(week).cast("int")
    b = F.col(buys) if buys else buys_before(active, n_weeks)
    lists = [F.col(c) for c in around] or buys_around(b, copies, copy, n_weeks)
    at = {d: F.get(c, t) for d, c in zip(ROW_SHIFTS, lists)}
    so_far = F.get(b, t)
    own, last = at[1] - at[0], F.get(a, so_far - 1)
    first = (t == 0) & (F.col(copy) == 0)
    last_lagged = F.when((F.col(copy) > 0) & (own == 1), t).otherwise(last)
    return {
        "cp_prev_bought_lagged": at[0] - at[-1],
        "cp_prev_bought": at[0].cast("bigint"),
        "cp_count_4w_lagged": F.when(~first, (at[0] - at[-4]).cast("bigint")),
        "cp_count_12w_lagged": F.when(~first, (at[0] - at[-12]).cast("bigint")),
        "cp_count_4w": (at[1] - at[-3]).cast("bigint"),
        "cp_count_12w": (at[1] - at[-11]).cast("bigint"),
        "cp_recency_lagged": F.coalesce(t - last_lagged, F.lit(999)).cast("bigint"),
        "cp_recency": F.when(own == 1, F.lit(0)).otherwise(t - last).cast("bigint"),
        "label": F.when((t < F.col(n_weeks) - 1) | (F.col(copy) < F.col(copies) - 1), at[2] - at[1]),
    }


# W7 / W8
def prior_rate(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Smoothed rate (buys+1)/(obs+2) over the key's rows in EARLIER periods.

    Pre-aggregated to (keys, week_idx) with map-side combine, cumulative window
    on that small table, then equi-joined back."""
    keys = list(keys)
    per = df.groupBy(*keys, "week_idx").agg(
        F.sum("bought").alias("_b"), F.count(F.lit(1)).alias("_o"))
    w = Window.partitionBy(*keys).orderBy("week_idx").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        *keys, "week_idx",
        ((F.coalesce(F.sum("_b").over(w), F.lit(0)) + 1.0) /
         (F.coalesce(F.sum("_o").over(w), F.lit(0)) + 2.0)).alias(out))
    return df.join(per, keys + ["week_idx"], "left")


def product_prior_rate(df: DataFrame) -> DataFrame:
    return prior_rate(df, ["product_id"], "prod_prior_rate")


def affinity_prior_rate(df: DataFrame, category: str = "category") -> DataFrame:
    return prior_rate(df, ["customer_id", category], "cust_cat_prior_rate")


# W9
def period_index(df: DataFrame, col: str = "week", out: str = "week_idx") -> DataFrame:
    """Dense index of the distinct periods.  The calendar is small (one row per
    period); it is indexed with a window and broadcast back."""
    cal = df.select(col).distinct()
    cal = cal.withColumn(out, (F.row_number().over(Window.orderBy(col)) - 1).cast("int"))
    return df.join(F.broadcast(cal), col)


def row_index(keys: Sequence[str], order: Sequence[str]):
    return (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("int")


# W10
def inter_event_days(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(ts, *tiebreak)
    return df.withColumn("gap_days", days_between(F.col(ts), F.lag(ts).over(w)))


# W11
def latest_per_pair(df: DataFrame, ref_week=None, keys: Sequence[str] = PAIR, order: str = "week") -> DataFrame:
    """Latest row per pair not after ``ref_week`` (default: the max week).

    ``max(struct(week, ...))`` per pair: an aggregate with partial combine."""
    src = df
    if ref_week is None:
        mx = df.agg(F.max(order).alias("_ref"))
        src = df.crossJoin(F.broadcast(mx)).filter(F.col(order) <= F.col("_ref")).drop("_ref")
    else:
        src = df.filter(F.col(order) <= F.lit(ref_week))
    rest = [c for c in df.columns if c not in keys and c != order]
    g = src.groupBy(*keys).agg(F.max(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("_l"))
    return g.select(*keys, *[F.col(f"_l.{c}").alias(c) for c in [order] + rest]).select(*df.columns)


# W12
def rank_topk(scored: DataFrame, k: int, by: str = "customer_id", score: str = "score",
              tiebreak: Sequence[str] = ("product_id",)) -> DataFrame:
    """Top-k per group by score desc, ties broken ascending by ``tiebreak``.
    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each task ships at most k rows per group."""
    w = Window.partitionBy(by).orderBy(F.desc(score), *tiebreak)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# W13
def customer_top_products(tx: DataFrame, k: int = 20) -> DataFrame:
    """Top-k products per customer by purchase count, as an ordered list."""
    cnt = tx.groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    top = rank_topk(cnt, k, score="n")
    g = top.groupBy("customer_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col("product_id").cast("string").alias("p")))).alias("_l"))
    return g.select("customer_id", F.transform("_l", lambda s: s["p"]).alias("top_products"))


# W14
def resolve_rules(fired: DataFrame, row_key: str = "row_id") -> DataFrame:
    """Among the rules fired on a row keep the one with most conditions, then
    highest precision, then smallest rule id."""
    return fired.groupBy(row_key).agg(
        F.max_by("rule", F.struct("n_conditions", "precision", (-F.col("rule")).alias("_r"))).alias("rule"))


# W15
def motion_mask(cells: DataFrame, threshold: int) -> DataFrame:
    """|v(frame+1) − v(frame)| per cell thresholded to 0/255.  Expressed as an
    equi-join of each frame with its successor on (frame+1, y, x) —
    partitioned by frame, so it scales with the number of frames instead of
    piling every frame of a cell into one window partition."""
    a = cells.select("frame", "y", "x", F.col("v").alias("v0"))
    b = cells.select((F.col("frame") - 1).alias("frame"), "y", "x", F.col("v").alias("v1"))
    j = a.join(b, ["frame", "y", "x"])
    d = F.abs(F.col("v1") - F.col("v0"))
    return j.select("frame", "y", "x", d.cast("int").alias("diff"),
                    F.when(d > threshold, F.lit(255)).otherwise(F.lit(0)).alias("mask"))
