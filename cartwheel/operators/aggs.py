"""Aggregations.

Every aggregate is a ``groupBy().agg()`` so Spark combines map-side before
the shuffle; a hot key therefore costs one partial row per task, not a hot
reducer.  Global statistics (percentiles, means) are one-row aggregates that
are joined back by broadcast (size 1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.scalars import round_half_away, week_start


def days_between(later, earlier):
    """Q9: elapsed whole 24-hour periods."""
    secs = F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))
    return F.floor(secs / 86400).cast("bigint")


# A1
def weekly_activity(tx: DataFrame, anchor: str = "MON") -> DataFrame:
    """(customer, product, week) → num_tx, bought = 1."""
    return (tx.withColumn("week", week_start(F.col("purchase_date"), anchor))
            .groupBy("customer_id", "product_id", "week")
            .agg(F.count(F.lit(1)).alias("num_tx"))
            .withColumn("bought", F.lit(1)))


# A2
def weekly_quantities(tx: DataFrame, anchor: str = "MON") -> DataFrame:
    """(customer, product, week) → qty, num_lines, bought = qty>0 or lines>0."""
    g = (tx.withColumn("week", week_start(F.col("purchase_date"), anchor))
         .groupBy("customer_id", "product_id", "week")
         .agg(F.coalesce(F.sum("items"), F.lit(0.0)).alias("qty"), F.count(F.lit(1)).alias("num_lines")))
    return g.withColumn("bought", ((F.col("qty") > 0) | (F.col("num_lines") > 0)).cast("int"))


# A3
def coverage(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.count_distinct("customer_id").alias("n_customers"),
        F.count_distinct("product_id").alias("n_products"),
        F.count_distinct(week_start(F.col("purchase_date"))).alias("n_weeks"),
        F.to_date(F.min("purchase_date")).alias("first_date"),
        F.to_date(F.max("purchase_date")).alias("last_date"),
    )


# A4
def orders_per_customer(tx: DataFrame) -> DataFrame:
    return tx.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("n_orders"), F.count(F.lit(1)).alias("n_rows"))


# A5
def describe_counts(df: DataFrame, col: str) -> DataFrame:
    from cartwheel.functions.quantiles import quantile_row
    x = F.col(col).cast("double")
    q = quantile_row(df, [col], [0.5, 0.1, 0.9]).select(F.col(f"_q_{col}").alias("_q"))  # exact, one row
    s = df.agg(F.round(F.avg(x), 6).alias("mean"), F.max(x).alias("max")).crossJoin(q)
    return s.select("mean", F.round(F.col("_q")[0], 6).alias("median"), F.round(F.col("_q")[1], 6).alias("p10"),
                    F.round(F.col("_q")[2], 6).alias("p90"), "max")


# A6
def basket_breadth(weekly: DataFrame) -> DataFrame:
    """Distinct products per customer-week → mean per customer → global mean and median."""
    per_cw = weekly.groupBy("customer_id", "week").agg(F.count_distinct("product_id").alias("k"))
    per_c = per_cw.groupBy("customer_id").agg(F.avg("k").alias("avg_k"))
    from cartwheel.functions.quantiles import quantile_row
    med = quantile_row(per_c, ["avg_k"], [0.5]).select(F.round(F.col("_q_avg_k")[0], 6).alias("median_breadth"))
    return per_c.agg(F.round(F.avg("avg_k"), 6).alias("mean_breadth")).crossJoin(med)


# A7
def volume_series(tx: DataFrame, grain: str = "week") -> DataFrame:
    """Rows, payment and customers per day or week."""
    if grain == "day":
        p = F.to_date("purchase_date")
    elif grain == "week":
        p = week_start(F.col("purchase_date"))
    else:
        raise ValueError(grain)
    return tx.groupBy(p.alias("period")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum("payment"), 6).alias("payment"),
        F.count_distinct("customer_id").alias("n_customers"),
    )


# A8
def visits(lines: DataFrame) -> DataFrame:
    """(customer, invoice) → last date, spend; null customers dropped (Q10)."""
    return (lines.filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id", "invoice")
            .agg(F.max("invoice_date").alias("visit_date"),
                 F.coalesce(F.sum(F.col("quantity") * F.col("price")), F.lit(0.0)).alias("spend")))


# A9
def lrmfp(lines: DataFrame) -> DataFrame:
    """Length, Recency, Frequency, Monetary, Periodicity per customer.

    The dataset end date is one global max joined back by broadcast (1 row);
    inter-visit gaps come from ``lag`` over each customer's visits."""
    v = visits(lines)
    end = v.agg(F.max("visit_date").alias("_end"))
    w = Window.partitionBy("customer_id").orderBy("visit_date", "invoice")
    gaps = v.withColumn("gap", days_between(F.col("visit_date"), F.lag("visit_date").over(w)))
    per = gaps.groupBy("customer_id").agg(
        F.min("visit_date").alias("_first"),
        F.max("visit_date").alias("_last"),
        F.count(F.lit(1)).alias("frequency"),
        F.avg("spend").alias("_mon"),
        F.stddev_pop("gap").alias("_per"),
    )
    out = per.crossJoin(F.broadcast(end))
    return out.select(
        "customer_id",
        days_between(F.col("_last"), F.col("_first")).alias("length"),
        days_between(F.col("_end"), F.col("_last")).alias("recency"),
        F.col("frequency").cast("bigint").alias("frequency"),
        round_half_away(F.round(F.col("_mon"), 6), 2).alias("monetary"),
        round_half_away(F.round(F.coalesce(F.col("_per"), F.lit(0.0)), 6), 2).alias("periodicity"),
    )


# A10
def repurchase_interval(tx: DataFrame) -> DataFrame:
    """Mean days between consecutive purchase dates of each product, per pair
    gaps pooled by product; support = number of gaps."""
    d = tx.select("customer_id", "product_id", F.to_date("purchase_date").alias("d")).distinct()
    w = Window.partitionBy("customer_id", "product_id").orderBy("d")
    g = d.withColumn("gap", F.datediff(F.col("d"), F.lag("d").over(w))).filter(F.col("gap").isNotNull())
    return g.groupBy("product_id").agg(
        F.round(F.avg("gap"), 6).alias("mean_days"), F.count(F.lit(1)).alias("support"))


# A11
def split_summary(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("week").alias("n_weeks"),
        F.count_distinct("customer_id").alias("n_customers"),
        F.count_distinct("product_id").alias("n_products"),
        F.min("week").alias("start"),
        F.max("week").alias("end"),
    )


# A12
def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Counts row × col with the column values given (no discovery job), missing 0."""
    return df.groupBy(row).pivot(col, list(values)).count().na.fill(0)


# A13
def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable", val: str = "value") -> DataFrame:
    casted = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(list(ids), list(cols), var, val)


# A14
def fd_bins(n, q1, q3, lo, hi, min_bins: int = 10, max_bins: int = 60):
    """Freedman–Diaconis bin count clipped to [min_bins, max_bins]; √n when IQR is 0."""
    iqr = q3 - q1
    width = 2.0 * iqr / F.pow(n.cast("double"), 1.0 / 3.0)
    fd = F.ceil((hi - lo) / width)
    k = F.when((iqr > 0) & (hi > lo), fd).otherwise(F.floor(F.sqrt(n.cast("double"))))
    return F.least(F.greatest(k, F.lit(min_bins)), F.lit(max_bins)).cast("int")


def histogram(df: DataFrame, col: str, bins: int | None = None, clip: tuple[float, float] | None = None) -> DataFrame:
    """Fixed-width histogram (bin, lo, hi, count).  Bin count by
    Freedman–Diaconis when ``bins`` is None; with ``clip=(ql, qh)`` values are
    first limited to those quantiles.  Stats are one aggregate row, broadcast."""
    x = F.col(col).cast("double")
    base = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    probs = [0.25, 0.75] + (list(clip) if clip else [])
    from cartwheel.functions.quantiles import quantile_row
    qs = quantile_row(base, ["x"], probs).select(F.col("_q_x").alias("q"))   # exact, one row
    st = base.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx")).crossJoin(qs)
    if clip:
        st = st.withColumn("lo", F.col("q")[2]).withColumn("hi", F.col("q")[3])
    else:
        st = st.withColumn("lo", F.col("mn")).withColumn("hi", F.col("mx"))
    k = F.lit(bins) if bins else fd_bins(F.col("n"), F.col("q")[0], F.col("q")[1], F.col("lo"), F.col("hi"))
    st = st.withColumn("k", k)
    j = base.crossJoin(F.broadcast(st.select("lo", "hi", "k")))
    xv = F.least(F.greatest(F.col("x"), F.col("lo")), F.col("hi"))
    width = (F.col("hi") - F.col("lo")) / F.col("k")
    idx = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((xv - F.col("lo")) / width), F.col("k") - 1)).cast("int")
    g = j.groupBy(idx.alias("bin"), "lo", "hi", "k").agg(F.count(F.lit(1)).alias("count"))
    wd = F.when(F.col("hi") == F.col("lo"), F.lit(0.0)).otherwise((F.col("hi") - F.col("lo")) / F.col("k"))
    return g.select(
        "bin",
        F.round(F.col("lo") + F.col("bin") * wd, 6).alias("bin_lo"),
        F.round(F.col("lo") + (F.col("bin") + 1) * wd, 6).alias("bin_hi"),
        "count",
    )


# A15
def list_lengths(preds: DataFrame) -> DataFrame:
    per = preds.groupBy("customer_id").agg(F.count(F.lit(1)).alias("k"))
    return per.agg(F.sum("k").alias("n_rows"), F.count(F.lit(1)).alias("n_customers"),
                   F.round(F.avg("k"), 6).alias("mean_len"), F.max("k").alias("max_len"))


# A16
def cluster_profile(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    long = melt(df, [label], cols)
    return long.groupBy(label, "variable").agg(
        F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_samp("value"), 6).alias("std"),
        F.count("value").alias("count"))


# A17
def effect_size(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """(cluster mean − global mean) / global population std, long form."""
    long = melt(df, [label], cols)
    glob = long.groupBy("variable").agg(F.avg("value").alias("gm"), F.stddev_pop("value").alias("gs"))
    per = long.groupBy(label, "variable").agg(F.avg("value").alias("cm"))
    # one row per variable: bounded by the number of columns → broadcast
    j = per.join(F.broadcast(glob), "variable")
    es = F.when(F.col("gs") > 0, (F.col("cm") - F.col("gm")) / F.col("gs"))
    return j.select(label, "variable", F.round(es, 6).alias("effect"))


# A18
def standout_means(es: DataFrame, label: str, top: int = 4, thr: float = 0.35) -> DataFrame:
    """Text profile: up to ``top`` variables above +thr and below −thr."""
    g = es.groupBy(label).agg(
        F.collect_list(F.when(F.col("effect") >= thr, F.struct((-F.col("effect")).alias("k"), F.col("variable").alias("v")))).alias("hi"),
        F.collect_list(F.when(F.col("effect") <= -thr, F.struct(F.col("effect").alias("k"), F.col("variable").alias("v")))).alias("lo"),
    )
    hi = F.array_join(F.transform(F.slice(F.array_sort("hi"), 1, top), lambda s: s["v"]), ", ")
    lo = F.array_join(F.transform(F.slice(F.array_sort("lo"), 1, top), lambda s: s["v"]), ", ")
    parts = F.concat_ws("; ",
                        F.when(F.size("hi") > 0, F.concat(F.lit("high: "), hi)),
                        F.when(F.size("lo") > 0, F.concat(F.lit("low: "), lo)))
    return g.select(label, F.when(parts == "", F.lit("balanced")).otherwise(parts).alias("description"))


# A19
def contribution_by_prefix(contrib_long: DataFrame, prefix: str, k: int = 10) -> DataFrame:
    """Mean |contribution| per category of one encoded variable (feature names
    ``<prefix>_<category>``), top k."""
    f = contrib_long.filter(F.col("feature").startswith(prefix + "_"))
    g = f.groupBy(F.substring(F.col("feature"), len(prefix) + 2, 10_000).alias("category")).agg(
        F.round(F.avg(F.abs("contribution")), 6).alias("mean_abs"))
    # distributed top-k (TakeOrdered), then rank the k survivors
    top = g.orderBy(F.desc("mean_abs"), "category").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_abs"), "category")))
