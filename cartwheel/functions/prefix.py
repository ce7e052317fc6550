"""Distributed running sums over a global order (used by AUC / AP / PR curve
and the KS statistic).

A plain ``sum() OVER (ORDER BY x)`` without PARTITION BY moves every row to
one task.  Instead the rows are range-partitioned by the keys and the order
column, so the number of ranges is Spark's own number of shuffle partitions
and a key with most of the rows is split like any other.  The ranged rows are
written once to the shared checkpoint folder with the range they fell into
(its limits are sampled, so they must not be drawn twice).  Each (keys, range)
is summed, these totals get exclusive offsets (a window over one row per range
and key), and the running sum inside a range is a window partitioned by range.
Equal order values always land in the same range, so results are exact; only
the load balance depends on the sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import materialize


def running_sums(df: DataFrame, order: str, cols: Sequence[str], keys: Sequence[str] = (),
                 descending: bool = False, suffix: str = "_cum") -> DataFrame:
    """Add ``<col><suffix>`` = sum of ``col`` over rows with order value ≤ the
    current one (≥ when ``descending``), within ``keys``.  ``order`` must be
    unique within ``keys`` (aggregate ties first)."""
    keys = list(keys)
    way = F.desc(order) if descending else F.asc(order)
    b = materialize(df.repartitionByRange(*keys, way).withColumn("_bk", F.spark_partition_id()))
    tot = b.groupBy(*keys, "_bk").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wt = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*keys, "_bk", *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}") for c in cols])
    j = b.join(F.broadcast(offs) if not keys else offs, keys + ["_bk"])  # without keys: one row per range
    w = Window.partitionBy(*keys, "_bk").orderBy(way).rowsBetween(Window.unboundedPreceding, 0)
    out = j.select("*", *[(F.sum(c).over(w) + F.col(f"_o_{c}")).alias(f"{c}{suffix}") for c in cols])
    return out.drop("_bk", *[f"_o_{c}" for c in cols])
