"""D6 feature-matrix job and the flagship next-week offer ranking.

Clean → weekly activity (checkpointed once) → candidate pairs → one row
per pair carrying its activity map and prior curves → one expansion over the
calendar, where W1-W6 follow from the pair's active weeks; the grid is neither
shuffled nor sorted.  The calendar and top-K side are parameter-bounded and broadcast; dimensions are joined with AQE's runtime
size check.  The flagship scores from pair aggregates without the grid.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.scalars import drop_null_keys, positive_only
from cartwheel.operators.aggs import weekly_activity
from cartwheel.operators.joins import expand_weeks
from cartwheel.operators.quality import dedupe_first
from cartwheel.operators.topk import candidate_pairs, global_top
from cartwheel.operators.windows import ROW_SHIFTS, buys_around, buys_before, pair_features_at, period_index, rank_topk
from cartwheel.session import bounded_broadcast, materialize

CURVE_BYTES = 64 << 20  # of product curves in a broadcast
AROUND = [f"_around{i}" for i in range(len(ROW_SHIFTS))]
PAIR_KEYS = ["customer_id", "product_id", "purchase_date"]


def clean_transactions(tx: DataFrame) -> DataFrame:
    """P7 + P8 + C1: drop null keys/dates, keep positive payments, first row
    per (customer, product, date) by (order_id, items, payment)."""
    t = drop_null_keys(tx, ["customer_id", "product_id", "purchase_date"])
    t = positive_only(t, "payment")
    return dedupe_first(t, PAIR_KEYS, ["order_id", "items", "payment"])


def dense_universe(clean: DataFrame, customers: DataFrame, top_k: int = 20, anchor: str = "MON") -> DataFrame:
    """(customer, product, week, week_idx, num_tx, bought) over candidates × weeks.

    Densified at PAIR level: each pair's activity is folded into a map
    week_idx → num_tx (≤ one entry per calendar week), left-joined to the
    candidate pairs on (customer, product), then expanded by the broadcast
    calendar.  The expanded rows inherit the (customer, product) partitioning,
    so the pair windows that follow need no further shuffle."""
    act = materialize(weekly_activity(clean, anchor))
    top = global_top(act, top_k, weight="num_tx")
    cand = candidate_pairs(act, customers, top)
    weeks = period_index(act.select("week").distinct())
    per_pair = (act.join(F.broadcast(weeks), "week")
                .groupBy("customer_id", "product_id")
                .agg(F.map_from_entries(F.collect_list(F.struct("week_idx", "num_tx"))).alias("_acts")))
    uni = expand_weeks(cand.join(per_pair, ["customer_id", "product_id"], "left"), weeks)
    n = F.coalesce(F.try_element_at(F.col("_acts"), F.col("week_idx")), F.lit(0).cast("bigint"))
    return uni.select("customer_id", "product_id", "week", "week_idx", n.alias("num_tx"),
                      (n > 0).cast("int").alias("bought"))


def _prior_steps(counts: DataFrame, keys: list[str], n_pairs: DataFrame) -> DataFrame:
    """Per key its candidate pairs ``_p`` and its running sum of buys ``_m``, one
    entry per active week (from the small activity table only)."""
    w = Window.partitionBy(*keys).orderBy("week_idx")
    steps = counts.select(*keys, "week_idx", F.sum("n").over(w).alias("cum"), F.lead("week_idx").over(w).alias("next"))
    m = steps.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("week_idx", "cum", "next"))).alias("_m"))
    return n_pairs.join(m, keys, "left")


def _held(steps: str) -> Column:
    """Buys before every calendar week as an array of length ``_W``: a sum holds
    until the next active week."""
    held = F.transform(steps, lambda e: F.array_repeat(e["cum"], (F.coalesce(e["next"], F.col("_W") - 1) - e["week_idx"]).cast("int")))
    zero = F.lit(0).cast("bigint")
    return F.when(F.col(steps).isNull(), F.array_repeat(zero, F.col("_W"))).otherwise(
        F.concat(F.array_repeat(zero, (F.col(steps)[0]["week_idx"] + 1).cast("int")), F.flatten(held)))


def _smoothed(buys: Column, pairs: Column, week: Column) -> Column:
    """The smoothed prior (buys before t) + 1 over (pairs · t) + 2.  On the dense grid
    a key with p candidate pairs has p rows per week, so obs before t = p · t."""
    return (buys + 1.0) / (pairs * week + 2.0)


@dataclass
class PairGrid:
    """The dense grid as one row per candidate pair; ``rows`` makes the grid."""
    pairs: DataFrame
    calendar: DataFrame  # one row: the weeks as ``_cal``, their number as ``_W``
    dims: list[str]

    def folded(self) -> DataFrame:
        """A row per pair and copy with what its weeks are made of: sorted active weeks and their
        transactions, buys before each week, product prior, buys and pairs of customer × category."""
        acts = F.array_sort(F.map_entries("_acts"))
        return (self.pairs.crossJoin(F.broadcast(self.calendar))
                .withColumn("_ccb", F.when(F.col("_known"), _held("_m")))
                .withColumn("_active", F.coalesce(F.transform(acts, lambda e: e["key"]), F.array().cast("array<int>")))
                .withColumn("_counts", F.transform(acts, lambda e: e["value"]))
                .withColumn("_buys", buys_before("_active", "_W"))
                .select("*", *[c.alias(x) for c, x in zip(buys_around(F.col("_buys"), "_copies", "_copy", "_W"), AROUND)]))

    def label_counts(self, first: int, end: int) -> DataFrame:
        """(label, weight): the grid's labels in the weeks from ``first`` until ``end``, two rows a pair.  A row's
        label is the buy of its week, on the last copy that of the next."""
        n, ahead = F.lit(max(end - first, 0)), F.when(F.col("_copy") == F.col("_copies") - 1, 1).otherwise(0)
        weeks = F.coalesce(F.map_keys("_acts"), F.array().cast("array<int>"))
        hits = F.size(F.filter(weeks, lambda w: (w - ahead >= first) & (w - ahead < end)))
        both = [F.struct(F.lit(y).alias("label"), k.cast("long").alias("weight")) for y, k in ((1.0, F.col("_hits")), (0.0, n - F.col("_hits")))]
        return self.pairs.select(hits.alias("_hits")).select(F.inline(F.array(*both)))

    def rows(self, label: bool = False, weeks: Callable[[Column], Column] | None = None) -> DataFrame:
        """The grid, or its weeks of which ``weeks`` (given their index) holds: others aren't made.
        Lists are made once a pair; a row looks its values up in generated code."""
        pairs = self.folded()
        if weeks:
            pairs = pairs.withColumn("_cal", F.filter("_cal", lambda c: weeks(c["week_idx"])))
        grid = pairs.select("*", F.explode("_cal").alias("_wk")).withColumn("week_idx", F.col("_wk.week_idx"))
        t = F.col("week_idx")
        at = F.get("_buys", t)
        n = F.when(F.get("_buys", t + 1) > at, F.get("_counts", at)).otherwise(F.lit(0).cast("bigint"))
        feats = pair_features_at("_active", "week_idx", "_copies", "_copy", "_W", "_buys", AROUND)
        if not label:
            del feats["label"]
        return grid.select(
            "customer_id", "product_id", F.col("_wk.week").alias("week"), t.cast("int").alias("week_idx"),
            n.alias("num_tx"), (F.get("_buys", t + 1) - at).alias("bought"), "category",
            F.get("_pc", t).alias("prod_prior_rate"),
            _smoothed(F.get("_ccb", t), F.col("_p"), t).alias("cust_cat_prior_rate"), *self.dims,
            *[c.alias(name) for name, c in feats.items()])


def build_feature_matrix(clean: DataFrame, customers: DataFrame, products: DataFrame,
                         top_k: int = 20, anchor: str = "MON", label: bool = False) -> DataFrame:
    """Dense universe + W1-W8 + dimension attributes.  ``products`` must
    carry ``category`` for the customer × category prior.  ``label`` adds the
    pair's ``bought`` of the next row (null on its last); jobs that use it pass
    over the grid several times, so the pair table is then written once."""
    return pair_grid(clean, customers, products, top_k, anchor, keep=label).rows(label)


def pair_grid(clean: DataFrame, customers: DataFrame, products: DataFrame,
              top_k: int = 20, anchor: str = "MON", keep: bool = False) -> PairGrid:
    """The feature matrix before its weeks are made; ``keep`` writes the pair table once.

    Plan: everything per week is first folded to ONE row per candidate pair
    (activity map, active weeks, steps of the customer×category prior, customer
    attributes) with joins on the pair table, which is ~n_weeks times smaller
    than the grid.  Lists of n_weeks numbers are made after these joins, so no
    shuffle carries them.  The pair table is hash-partitioned on (customer,
    product) and expanded over the calendar; W1-W6 follow from
    the pair's active weeks, so the grid is neither shuffled nor sorted."""
    act = materialize(weekly_activity(clean, anchor))
    weeks = period_index(act.select("week").distinct())                      # one row per week
    cal = weeks.agg(F.array_sort(F.collect_list(F.struct("week_idx", "week"))).alias("_cal"),
                    F.count(F.lit(1)).cast("int").alias("_W"))              # one row
    prods = products.select("product_id", "category")
    top = global_top(act, top_k, weight="num_tx")
    cand = candidate_pairs(act, customers.select("customer_id"), top).join(prods, "product_id", "left")
    a = act.join(F.broadcast(weeks), "week").join(prods, "product_id", "left")
    prod_curve = _prior_steps(a.groupBy("product_id", "week_idx").agg(F.count(F.lit(1)).alias("n")), ["product_id"],
                              cand.groupBy("product_id").agg(F.count(F.lit(1)).alias("_p")))
    curve = F.transform(_held("_m"), lambda n, t: _smoothed(n, F.col("_p"), t))
    prod_curve = prod_curve.crossJoin(F.broadcast(cal.select("_W"))).select("product_id", curve.alias("_pc"))
    # few products carry most pairs, so their curves aren't joined by key while they fit a broadcast of measured size
    prod_curve = bounded_broadcast(materialize(prod_curve), CURVE_BYTES // (8 * weeks.count() + 64))
    cc_steps = _prior_steps(a.groupBy("customer_id", "category", "week_idx").agg(F.count(F.lit(1)).alias("n")),
                            ["customer_id", "category"],
                            cand.groupBy("customer_id", "category").agg(F.count(F.lit(1)).alias("_p")))
    per_pair = a.groupBy("customer_id", "product_id").agg(
        F.map_from_entries(F.collect_list(F.struct("week_idx", "num_tx"))).alias("_acts"))
    # a customer given n times has n rows a week; _copy numbers them
    same = Window.partitionBy("customer_id")
    dims = [c for c in customers.columns if c != "customer_id"]
    owners = customers.select("*", F.count(F.lit(1)).over(same).alias("_copies"),
                              (F.row_number().over(same.orderBy("customer_id")) - 1).alias("_copy"))
    pairs = (cand.join(cc_steps.withColumn("_known", F.lit(True)), ["customer_id", "category"], "left")
             .join(owners, "customer_id", "left")
             .join(per_pair, ["customer_id", "product_id"], "left")
             # pair table: small shuffle; the partition count is pinned to the
             # session's shuffle width (AQE would coalesce it by the pair
             # table's size, but the expansion below is n_weeks times larger)
             .repartition(int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions")), "customer_id", "product_id")
             .na.fill({"_copies": 1, "_copy": 0}))
    if keep:
        pairs = materialize(pairs)
    return PairGrid(pairs.join(prod_curve, "product_id", "left"), cal, dims)


def offer_score(df: DataFrame) -> DataFrame:
    """Deterministic score standing in for a model: pair frequency over the
    last 12 weeks blended with the product and customer×category priors."""
    s = (0.6 * (F.col("cp_count_12w") + 1.0) / 14.0 + 0.2 * F.col("prod_prior_rate")
         + 0.2 * F.col("cust_cat_prior_rate"))
    return df.withColumn("score", F.round(s, 6))


def next_week_state(clean: DataFrame, customers: DataFrame, products: DataFrame,
                    top_k: int = 20, anchor: str = "MON") -> DataFrame:
    """The feature-matrix row of every candidate pair at the LAST calendar
    week, computed from aggregates instead of windows over the dense grid.

    On a dense grid every pair has a row for every week, so at the last week
    L: cp_count_12w = active weeks in [L−11, L]; the product prior has
    buys = activity rows of the product before L and obs = (its candidate
    pairs) × L; likewise per customer × category.  The work is over pairs and
    activity rows, not pairs × weeks."""
    act = materialize(weekly_activity(clean, anchor))
    # everything below derives from the one activity aggregate, so the scan,
    # join and de-duplication of the facts run once
    cal = act.select("week").distinct().agg(F.array_sort(F.collect_list("week")).alias("_ws"))  # one row
    last = cal.select((F.size("_ws") - 1).alias("L"), F.element_at("_ws", -1).alias("_last"),
                      F.element_at("_ws", F.greatest(F.size("_ws") - 11, F.lit(1))).alias("_w12"))
    # per active pair: activity weeks among the last 12 and before the last week
    stats = act.crossJoin(F.broadcast(last)).groupBy("customer_id", "product_id").agg(
        F.count_if(F.col("week") >= F.col("_w12")).alias("cp_count_12w"),
        F.count_if(F.col("week") < F.col("_last")).alias("_before"))
    top = global_top(act, top_k, weight="num_tx")
    pairs = (candidate_pairs(act, customers, top)
             .join(products.select("product_id", "category"), "product_id", "left")
             .join(stats, ["customer_id", "product_id"], "left")
             .na.fill({"cp_count_12w": 0, "_before": 0}))
    # the prior numerators and denominators are sums over the pair table
    prod_tot = pairs.groupBy("product_id").agg(F.sum("_before").alias("pb"), F.count(F.lit(1)).alias("pn"))
    cc_tot = pairs.groupBy("customer_id", "category").agg(F.sum("_before").alias("cb"), F.count(F.lit(1)).alias("cn"))
    j = (pairs.join(prod_tot, "product_id").join(cc_tot, ["customer_id", "category"])
         .crossJoin(F.broadcast(last)))
    return j.select(
        "customer_id", "product_id", F.col("_last").alias("week"), "category",
        F.col("cp_count_12w").cast("bigint").alias("cp_count_12w"),
        ((F.col("pb") + 1.0) / (F.col("pn") * F.col("L") + 2.0)).alias("prod_prior_rate"),
        ((F.col("cb") + 1.0) / (F.col("cn") * F.col("L") + 2.0)).alias("cust_cat_prior_rate"),
    )


def offer_next_week(clean: DataFrame, customers: DataFrame, products: DataFrame,
                    top_k_candidates: int = 20, k: int = 10) -> DataFrame:
    """Flagship: rank the products to offer each customer next week."""
    state = next_week_state(clean, customers.select("customer_id"), products, top_k_candidates)
    ranked = rank_topk(offer_score(state), k)
    return ranked.select("customer_id", "product_id", "week", "score", F.col("rank").cast("int").alias("rank"))
