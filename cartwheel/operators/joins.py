"""Joins (J1-J8).

Dimension joins are left to AQE's runtime size check (broadcast below
``spark.sql.autoBroadcastJoinThreshold``, sort-merge above), because a
customer dimension at scale is not small.  Sides whose size is bounded by a
parameter (a top-k list, a week calendar) are broadcast explicitly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# J1
def enrich(fact: DataFrame, cust: DataFrame | None, prod: DataFrame | None,
           cust_key: str = "customer_id", prod_key: str = "product_id") -> DataFrame:
    """Left-join facts with their dimensions by each dimension's own key (Q6)."""
    out = fact
    if cust is not None:
        out = out.join(cust, cust_key, "left")
    if prod is not None:
        out = out.join(prod, prod_key, "left")
    return out


# J2
def cross_top(customers: DataFrame, top: DataFrame) -> DataFrame:
    """Every customer × the top-K products.  ``top`` comes from a ``limit(k)``,
    so its size is bounded by k and it is broadcast."""
    return customers.select("customer_id").crossJoin(F.broadcast(top.select("product_id")))


# J3
def expand_weeks(cand: DataFrame, weeks: DataFrame) -> DataFrame:
    """Candidate pairs × observed weeks; the calendar is one row per week of
    the history window (bounded by its length), broadcast."""
    return cand.crossJoin(F.broadcast(weeks))


# J4
def densify(universe: DataFrame, activity: DataFrame, keys: Sequence[str], fill: dict) -> DataFrame:
    """Left join activity onto the universe; missing measures filled."""
    j = universe.join(activity, list(keys), "left")
    return j.na.fill(fill)


# J5
def attach_split(df: DataFrame, split_map: DataFrame, key: str = "week") -> DataFrame:
    """Inner join of the week → split map (one row per week, broadcast)."""
    return df.join(F.broadcast(split_map), key, "inner")


# J6
def drop_observed(neg: DataFrame, pos: DataFrame, keys: Sequence[str]) -> DataFrame:
    return neg.join(pos.select(*keys), list(keys), "left_anti")


# J7
def attach_features(lines: DataFrame, feats: DataFrame, key: str = "customer_id") -> DataFrame:
    return lines.join(feats, key, "left")


# J8
def epsilon_join(df: DataFrame, eps: float, id_col: str = "id", cols: Sequence[str] = ("x", "y"),
                 include_self: bool = True) -> DataFrame:
    """All pairs (i, j) with Euclidean distance ≤ eps.

    Points are hashed to grid cells of side eps; each point is replicated to
    its 3^d neighbouring cell ids and equi-joined with the points of that
    cell — so only pairs in adjacent cells are compared, never the full
    cross product.  Exact: any pair within eps lies in adjacent cells."""
    cols = list(cols)
    cell = [F.floor(F.col(c) / eps).cast("bigint").alias(f"_c{i}") for i, c in enumerate(cols)]
    pts = df.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)], *cell)
    offs = F.array(*[F.lit(o) for o in (-1, 0, 1)])
    probe = pts
    for i in range(len(cols)):
        probe = probe.withColumn(f"_o{i}", F.explode(offs))
    probe = probe.select(
        F.col("_id").alias("i"), *[F.col(f"_v{k}").alias(f"a{k}") for k in range(len(cols))],
        *[(F.col(f"_c{k}") + F.col(f"_o{k}")).alias(f"_c{k}") for k in range(len(cols))])
    build = pts.select(F.col("_id").alias("j"), *[F.col(f"_v{k}").alias(f"b{k}") for k in range(len(cols))],
                       *[F.col(f"_c{k}") for k in range(len(cols))])
    j = probe.join(build, [f"_c{k}" for k in range(len(cols))])
    d2 = None
    for k in range(len(cols)):
        t = F.pow(F.col(f"a{k}") - F.col(f"b{k}"), 2)
        d2 = t if d2 is None else d2 + t
    j = j.withColumn("dist", F.sqrt(d2)).filter(F.col("dist") <= F.lit(eps))
    if not include_self:
        j = j.filter(F.col("i") != F.col("j"))
    return j.select("i", "j", "dist")
