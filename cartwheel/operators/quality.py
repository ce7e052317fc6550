"""De-duplication, integrity and profiling.

Profiles are computed as ONE aggregate pass over the input (partial
aggregation map-side) and then unpivoted; no per-column jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cartwheel.functions.quantiles import column_quantiles


def _numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


# C1
def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key under an explicit total order (Q8).

    Implemented as ``min(struct(order..., rest...))`` per key: a hash/sort
    aggregate with map-side partial aggregation, so a hot key collapses before
    the shuffle instead of being sorted in one task as a window would."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_first")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in list(order) + rest]).select(*df.columns)


# C2
def distinct_pairs(df: DataFrame, cols: Sequence[str] = ("customer_id", "product_id")) -> DataFrame:
    return df.select(*cols).distinct()


# C3
def keep_known(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose every reference exists in its master (left-semi joins).
    ``dims`` maps the key column to a DataFrame holding that column."""
    out = df
    for key, dim in dims.items():
        out = out.join(dim.select(key), key, "left_semi")
    return out


# C4
def unknown_refs(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The rows C3 removes, one row per failed reference with the reason."""
    parts = []
    for key, dim in dims.items():
        parts.append(df.join(dim.select(key), key, "left_anti").withColumn("reason", F.lit(f"unknown {key}")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# C5
def assert_m1(dim: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Keys that appear more than once (must be empty for an m:1 join)."""
    keys = [key] if isinstance(key, str) else list(key)
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


# C6
def quality_report(tx: DataFrame, weekly: DataFrame, lo: str, hi: str) -> DataFrame:
    """Validation suite → (test, passed).  One aggregate per input."""
    t = tx.agg(
        F.coalesce(F.bool_and(F.col("payment") >= 0), F.lit(True)).alias("no_negative_payment"),
        F.coalesce(F.bool_and(F.col("items").isNull() | (F.col("items") >= 0)), F.lit(True)).alias("no_negative_items"),
        F.coalesce(F.bool_and(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull()), F.lit(True)).alias("keys_not_null"),
        F.coalesce(F.bool_and(F.col("purchase_date").between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp"))), F.lit(True)).alias("dates_in_range"),
    )
    w = (weekly.groupBy("customer_id", "product_id", "week").agg(F.count(F.lit(1)).alias("n"))
         .agg(F.coalesce(F.max("n"), F.lit(0)).alias("m"))
         .select((F.col("m") <= 1).alias("weekly_key_unique")))
    both = t.crossJoin(w)
    names = ["no_negative_payment", "no_negative_items", "keys_not_null", "dates_in_range", "weekly_key_unique"]
    return both.unpivot([], names, "test", "passed")


# C7
def null_profile(df: DataFrame, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """(dataset, column, nulls, pct) for every column, one pass."""
    cols = list(cols) if cols else df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = row.unpivot(["_n"], cols, "column", "nulls")
    return long.select(
        F.lit(name).alias("dataset"), "column", F.col("nulls").cast("bigint").alias("nulls"),
        F.when(F.col("_n") > 0, F.round(100.0 * F.col("nulls") / F.col("_n"), 6)).otherwise(F.lit(0.0)).alias("pct"),
    )


# C8
def column_overview(df: DataFrame) -> DataFrame:
    """(column, dtype, missing, pct, distinct) for every column, one pass."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"m__{c}"))
        aggs.append(F.count_distinct(F.col(c)).alias(f"d__{c}"))
    row = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stacked = row.select(
        "_n",
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                     F.col(f"m__{c}").cast("bigint").alias("missing"), F.col(f"d__{c}").cast("bigint").alias("n_distinct"))
            for c in cols
        ])).alias("s"),
    )
    return stacked.select(
        "s.column", "s.dtype", "s.missing",
        F.when(F.col("_n") > 0, F.round(100.0 * F.col("s.missing") / F.col("_n"), 6)).otherwise(F.lit(0.0)).alias("pct"),
        "s.n_distinct",
    )


# C9
def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None, wide_tails: bool = False) -> DataFrame:
    """n, mean, std, min, q1, median, q3, max, skew (sample-adjusted), zeros_pct
    per numeric column; optional q01/q05/q95/q99.  Exact percentiles (Q11)."""
    cols = list(cols) if cols else _numeric_cols(df)
    probs = [0.25, 0.5, 0.75] + ([0.01, 0.05, 0.95, 0.99] if wide_tails else [])
    # exact quantiles by multi-round selection (a few numbers per column reach the driver)
    qvals = {c: q for c, (_, q) in column_quantiles(df, cols, probs).items()}
    qmap = F.create_map(*[x for c in cols for x in (F.lit(c), F.array(*[F.lit(v).cast("double") for v in qvals[c]]))])
    structs = []
    for c in cols:
        x = F.col(c).cast("double")
        n = F.count(x)
        structs.append(F.struct(
            F.lit(c).alias("column"),
            n.alias("n"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            qmap[F.lit(c)].alias("q"),
            F.max(x).alias("max"),
            (F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
            (100.0 * F.count_if(x == 0) / n).alias("zeros_pct"),
        ))
    row = df.agg(F.array(*structs).alias("a"))
    s = row.select(F.explode("a").alias("s"))
    out = [F.col("s.column"), F.col("s.n").cast("bigint").alias("n")]
    out.append(F.round(F.round(F.col("s.mean"), 9), 6).alias("mean"))
    for name in ["std", "min"]:
        out.append(F.round(F.col(f"s.{name}"), 6).alias(name))
    out += [F.round(F.col("s.q")[0], 6).alias("q1"), F.round(F.col("s.q")[1], 6).alias("median"),
            F.round(F.col("s.q")[2], 6).alias("q3")]
    out.append(F.round(F.col("s.max"), 6).alias("max"))
    out.append(F.round(F.col("s.skew"), 6).alias("skew"))
    out.append(F.round(F.col("s.zeros_pct"), 6).alias("zeros_pct"))
    if wide_tails:
        for i, nm in enumerate(["q01", "q05", "q95", "q99"]):
            out.append(F.round(F.col("s.q")[3 + i], 6).alias(nm))
    return s.select(*out)


# C10
def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with at most one distinct value, null counted as a value."""
    cols = df.columns
    # two values at most matter, and the smallest and the largest show them
    row = df.agg(*[
        (F.when(F.min(c).isNull(), 0).when(F.min(c) == F.max(c), 1).otherwise(2)
         + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in cols
    ])
    long = row.unpivot([], cols, "column", "n_values")
    return long.filter(F.coalesce(F.col("n_values"), F.lit(0)) <= 1).select("column")


# C11
def classify_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Type columns by cardinality / range: likert (integers within 0..5, ≤ 6
    values), low_card (≤ 10), continuous (> 20), otherwise medium."""
    cols = list(cols) if cols else _numeric_cols(df)
    structs = [F.struct(
        F.lit(c).alias("column"),
        F.count_distinct(F.col(c)).alias("nd"),
        F.min(F.col(c).cast("double")).alias("lo"),
        F.max(F.col(c).cast("double")).alias("hi"),
        F.coalesce(F.bool_and(F.col(c).cast("double") == F.floor(F.col(c).cast("double"))), F.lit(True)).alias("integral"),
    ) for c in cols]
    s = df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("s")).select("s.*")
    kind = (F.when(F.col("integral") & (F.col("lo") >= 0) & (F.col("hi") <= 5) & (F.col("nd") <= 6), "likert")
            .when(F.col("nd") <= 10, "low_card")
            .when(F.col("nd") > 20, "continuous")
            .otherwise("medium"))
    return s.select("column", F.col("nd").cast("bigint").alias("n_distinct"), kind.alias("kind"))


# C12
def skewed_columns(summary: DataFrame, threshold: float = 1.0) -> DataFrame:
    return summary.filter(F.col("skew") > threshold).select("column", "skew")


# C13
def class_balance(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per class (per split), with the class share inside its group."""
    from pyspark.sql import Window as W
    g = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(W.partitionBy(*by)) if by else F.sum("n").over(W.partitionBy())
    return g.withColumn("share", F.round(F.col("n") / tot, 6))
