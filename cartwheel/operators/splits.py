"""Splits and sampling (H1-H7).

Randomness is ``md5(key|seed)``: stable under repartitioning and equal in
every engine.  Exact-size selections use a two-level histogram on the md5
prefix (counts per bucket → cumulative → one boundary bucket ranked), so no
class or group is ever sorted in a single task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.sources.tables import md5_order


def holdout_counts(n_weeks: int, props=(0.70, 0.15), gap: int = 1) -> tuple[int, int, int]:
    """(train, valid, test) week counts of the weeks left after two gaps: the
    proportions rounded down, the rest to test.  An empty part takes a week
    from the longest; fewer than three weeks can't hold the parts."""
    left = n_weeks - 2 * gap
    if left < 3:
        raise ValueError(f"{n_weeks} weeks are too few for three parts and two gaps of {gap}")
    train, valid = (int(left * p) for p in props)
    parts = [train, valid, left - train - valid]
    while 0 in parts:
        parts[parts.index(max(parts))] -= 1
        parts[parts.index(0)] += 1
    return tuple(parts)


def _split_by_index(weeks: DataFrame, bounds: list[tuple[int, int, str]], week: str) -> DataFrame:
    idx = (F.row_number().over(Window.orderBy(week)) - 1)
    w = weeks.select(week).distinct().withColumn("_i", idx)
    e = F.lit("gap")
    for lo, hi, name in reversed(bounds):
        e = F.when((F.col("_i") >= lo) & (F.col("_i") < hi), F.lit(name)).otherwise(e)
    return w.select(week, e.alias("split"))


# H1
def temporal_holdout(df: DataFrame, props=(0.70, 0.15), gap: int = 1, week: str = "week",
                     keep_gap: bool = False) -> DataFrame:
    """Week → split map: [train][gap][valid][gap][test]; gap weeks dropped.
    The calendar (one row per week) is the only thing counted and indexed."""
    weeks = df.select(week).distinct()
    n = weeks.count()
    tr, va, te = holdout_counts(n, props, gap)
    b = [(0, tr, "train"), (tr + gap, tr + gap + va, "valid"), (tr + 2 * gap + va, tr + 2 * gap + va + te, "test")]
    m = _split_by_index(weeks, b, week)
    return m if keep_gap else m.filter(F.col("split") != "gap")


# H2
def fixed_holdout(df: DataFrame, week: str = "week", train: int = 35, valid: int = 7, gap: int = 1) -> DataFrame:
    """35 train / gap / 7 valid / gap / rest test; fewer than 51 weeks is an error.
    Gap weeks are labelled 'gap' and dropped (Q5)."""
    weeks = df.select(week).distinct()
    n = weeks.count()
    if n < 51:
        raise ValueError(f"fixed holdout needs at least 51 weeks, got {n}")
    b = [(0, train, "train"), (train + gap, train + gap + valid, "valid"), (train + 2 * gap + valid, n, "test")]
    return _split_by_index(weeks, b, week).filter(F.col("split") != "gap")


# H3
def check_split(split_map: DataFrame, week: str = "week") -> DataFrame:
    """(check, passed): one split per week; train < valid < test in time."""
    per = split_map.groupBy(week).agg(F.count_distinct("split").alias("k"))
    one = per.agg(F.coalesce(F.max("k"), F.lit(1)) <= 1).toDF("passed").withColumn("check", F.lit("one_split_per_week"))
    r = split_map.groupBy("split").agg(F.min(week).alias("lo"), F.max(week).alias("hi"))
    piv = r.groupBy().pivot("split", ["train", "valid", "test"]).agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    ordered = piv.select(
        (F.coalesce(F.col("train_hi") < F.col("valid_lo"), F.lit(True)) &
         F.coalesce(F.col("valid_hi") < F.col("test_lo"), F.lit(True))).alias("passed")
    ).withColumn("check", F.lit("ordered_in_time"))
    return one.unionByName(ordered).select("check", "passed")


def exact_take(df: DataFrame, keys: Sequence[str], h: str, k_col: str, out: str = "_take",
               prefix_hex: int = 5) -> DataFrame:
    """Flag the ``k_col`` smallest rows by the hex string ``h`` within each key
    group, exactly, without sorting a whole group in one task: histogram on
    the first ``prefix_hex`` hex digits (≤ 16^prefix_hex buckets per group),
    cumulative counts on that small table, then only the boundary bucket is
    ranked.  ``h`` must be unique within the group (md5 of a unique key)."""
    keys = list(keys)
    b = df.withColumn("_b", F.substring(F.col(h), 1, prefix_hex))
    cnt = b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cum = cnt.select(*keys, "_b", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    j = b.join(cum, keys + ["_b"])
    inner = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(h))
    j = j.withColumn(out, (F.col("_before") + inner) <= F.col(k_col))
    return j.drop("_b", "_before")


# H4
def stratified_split(df: DataFrame, label: str, frac: float, seed: int, id_col: str) -> DataFrame:
    """Per class, the round(frac·n_c) rows first in md5(id|seed) order go to
    'test', the rest to 'train'."""
    h = df.withColumn("_h", md5_order(F.col(id_col), seed))
    sizes = df.groupBy(label).agg(F.round(F.count(F.lit(1)) * frac).cast("bigint").alias("_k"))
    j = h.join(F.broadcast(sizes), label)  # one row per class
    t = exact_take(j, [label], "_h", "_k")
    return t.withColumn("split", F.when(F.col("_take"), "test").otherwise("train")).drop("_h", "_k", "_take")


# H5
def sample_negatives(weekly: DataFrame, pool: DataFrame, k: int, seed: int) -> DataFrame:
    """K negatives per (customer, week): slot s draws pool[md5(c|w|s|seed) % |pool|]
    (with replacement), then observed positives are removed (J6).  The pool
    is a top-p list (bounded by p), indexed and broadcast."""
    order = [F.desc("n"), "product_id"] if "n" in pool.columns else ["product_id"]
    p = pool.withColumn("_pi", (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint")).select("_pi", "product_id")
    size = p.agg(F.count(F.lit(1)).alias("_ps"))
    cw = weekly.select("customer_id", "week", *([c for c in ["split"] if c in weekly.columns])).distinct()
    slots = cw.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).crossJoin(F.broadcast(size))
    key = F.concat_ws("|", F.col("customer_id").cast("string"), F.col("week").cast("string"), F.col("slot").cast("string"))
    h = F.md5(F.concat(key, F.lit(f"|{seed}")))
    slots = slots.withColumn("_pi", (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % F.col("_ps")))
    neg = slots.join(F.broadcast(p.select("_pi", "product_id")), "_pi").drop("_pi", "_ps")
    pos = weekly.select("customer_id", "week", "product_id")
    neg = neg.join(pos, ["customer_id", "week", "product_id"], "left_anti")
    return neg.withColumn("bought", F.lit(0))


# H6
def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Fixed-size sample: the n rows first in md5(key|seed) order (TakeOrdered)."""
    return df.withColumn("_h", md5_order(F.col(key), seed)).orderBy("_h").limit(n).drop("_h")


# H7
def simulate_week(tx: DataFrame, n: int, seed: int) -> DataFrame:
    """Append a simulated next week: n sampled known pairs dated last + 7 days,
    items 1 and payment 1."""
    pairs = tx.select("customer_id", "product_id").distinct()
    pairs = pairs.withColumn("_k", F.concat_ws("|", F.col("customer_id").cast("string"), F.col("product_id").cast("string")))
    s = sample_n(pairs, n, seed, "_k").drop("_k")
    last = tx.agg(F.max("purchase_date").alias("_last"))
    new = s.crossJoin(F.broadcast(last)).select(
        "customer_id", "product_id", F.lit(None).cast("bigint").alias("order_id"),
        (F.col("_last") + F.expr("INTERVAL 7 DAYS")).alias("purchase_date"),
        F.lit(1.0).alias("items"), F.lit(1.0).alias("payment"))
    return tx.unionByName(new.select(*tx.columns))
