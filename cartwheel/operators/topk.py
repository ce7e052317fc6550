"""Sort / limit / top-k and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.joins import cross_top


# T1
def global_top(tx: DataFrame, k: int, key: str = "product_id", weight: str | None = None) -> DataFrame:
    """Top-k keys by row count (or summed weight), ties by key ascending.
    ``orderBy().limit(k)`` plans as a distributed TakeOrdered: each task keeps
    its own k best, so only k rows per task reach the final merge."""
    agg = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")
    g = tx.groupBy(key).agg(agg.alias("n"))
    return g.orderBy(F.desc("n"), F.asc(key)).limit(k)


# T2
def train_pool(weekly: DataFrame, p: int = 80, split_col: str = "split") -> DataFrame:
    """Popular pool from TRAIN weeks only: top p products by purchases."""
    return global_top(weekly.filter(F.col(split_col) == "train"), p, weight="bought")


# T3
def extremes_with_support(intervals: DataFrame, n: int = 10, value: str = "mean_days",
                          support: str = "support", key: str = "product_id") -> DataFrame:
    """Fastest and slowest n keys among those with support ≥ the first quartile."""
    from cartwheel.functions.quantiles import quantile_row
    q1 = quantile_row(intervals, [support], [0.25]).select(F.col(f"_q_{support}")[0].alias("_q1"))  # exact, one row
    ok = intervals.crossJoin(F.broadcast(q1)).filter(F.col(support) >= F.col("_q1")).drop("_q1")
    fast = ok.orderBy(F.asc(value), F.asc(key)).limit(n).withColumn("kind", F.lit("fastest"))
    slow = ok.orderBy(F.desc(value), F.asc(key)).limit(n).withColumn("kind", F.lit("slowest"))
    return fast.unionByName(slow)


# T4
def top_pairs(corr_long: DataFrame, n: int = 10) -> DataFrame:
    """n strongest positive and n strongest negative pairs, each unordered
    pair once as (a, b) with a < b."""
    c = corr_long.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "rho").distinct()
    pos = c.filter(F.col("rho") > 0).orderBy(F.desc("rho"), "a", "b").limit(n).withColumn("sign", F.lit("positive"))
    neg = c.filter(F.col("rho") < 0).orderBy(F.asc("rho"), "a", "b").limit(n).withColumn("sign", F.lit("negative"))
    return pos.unionByName(neg)


# T5
def recommend(ids: DataFrame, own_top: DataFrame, global_list: DataFrame, k: int) -> DataFrame:
    """Own top list when the customer has one, else the global top list.
    ``global_list`` is one row holding the (k-bounded) global array."""
    j = ids.join(own_top, "customer_id", "left").crossJoin(F.broadcast(global_list))
    chosen = F.coalesce(F.col("top_products"), F.col("global_products"))
    return j.select("customer_id", F.slice(chosen, 1, k).alias("products"),
                    F.col("top_products").isNotNull().alias("personal"))


# U1
def candidate_pairs(tx: DataFrame, customers: DataFrame, top: DataFrame) -> DataFrame:
    """History pairs ∪ (all customers × top-K products), distinct.

    The cross product of distinct customers and products has no row twice, so
    only history pairs outside it are made distinct: no hash table holds the
    K times larger product."""
    ids = customers.select("customer_id").distinct()
    pool = top.select("product_id").distinct()
    known = ids.select(F.col("customer_id").alias("_c"), F.lit(True).alias("_known"))
    listed = pool.select(F.col("product_id").alias("_p"), F.lit(True).alias("_listed"))  # bounded by k
    hist = tx.select("customer_id", "product_id")
    hist = (hist.join(F.broadcast(listed), F.col("product_id").eqNullSafe(F.col("_p")), "left")
            .join(known, F.col("customer_id").eqNullSafe(F.col("_c")), "left")
            .where(F.col("_listed").isNull() | F.col("_known").isNull()))
    return hist.select("customer_id", "product_id").distinct().unionByName(cross_top(ids, pool))


# U2
def union_labels(pos: DataFrame, neg: DataFrame) -> DataFrame:
    return pos.unionByName(neg, allowMissingColumns=True)


# U3
def pair_sets(pred: DataFrame, truth: DataFrame, keys: Sequence[str] = ("customer_id", "product_id")) -> DataFrame:
    """tp / fp / fn counts from one full outer join of the distinct pair sets."""
    keys = list(keys)
    p = pred.select(*keys).distinct().withColumn("_p", F.lit(1))
    t = truth.select(*keys).distinct().withColumn("_t", F.lit(1))
    u = p.join(t, keys, "full_outer")
    return u.agg(
        F.count_if(F.col("_p").isNotNull() & F.col("_t").isNotNull()).alias("tp"),
        F.count_if(F.col("_p").isNotNull() & F.col("_t").isNull()).alias("fp"),
        F.count_if(F.col("_p").isNull() & F.col("_t").isNotNull()).alias("fn"),
    )


# U4
def pair_universe(pred: DataFrame, truth: DataFrame, keys: Sequence[str] = ("customer_id", "product_id")) -> DataFrame:
    keys = list(keys)
    p = pred.select(*keys).distinct().withColumn("y_pred", F.lit(1))
    t = truth.select(*keys).distinct().withColumn("y_true", F.lit(1))
    return p.join(t, keys, "full_outer").na.fill({"y_pred": 0, "y_true": 0})
