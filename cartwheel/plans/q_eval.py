"""Queries: splits and sampling (H*), split summaries (A11, A12, A15, T2, T3,
U2, J3, J5), metrics (K*) and drift (D1-D4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators import aggs, drift, joins, metrics, splits, topk, windows
from cartwheel.plans.catalog import query
from cartwheel.plans.features import clean_transactions
from cartwheel.sources import tables as V


def _weekly(t):
    return aggs.weekly_activity(clean_transactions(V.txb(t)))


WEEKLY = """weekly AS (SELECT customer_id, product_id, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
  count(*) AS num_tx, 1 AS bought FROM txbc GROUP BY 1, 2, 3)"""
# H1: of the weeks left after two gaps, 70 % and 15 % rounded down, the rest is test
HOLDOUT = """hw AS (SELECT week, CASE WHEN i < a THEN 'train' WHEN i > a AND i <= a + b THEN 'valid' WHEN i > a + b + 1 THEN 'test' ELSE 'gap' END AS split
  FROM (SELECT week, row_number() OVER (ORDER BY week) - 1 AS i, CAST(floor((count(*) OVER () - 2) * 0.7::DOUBLE) AS INTEGER) AS a,
               CAST(floor((count(*) OVER () - 2) * 0.15::DOUBLE) AS INTEGER) AS b FROM (SELECT DISTINCT week FROM weekly))),
holdout AS (SELECT * FROM hw WHERE split <> 'gap')"""
# H2: 35 weeks, a gap, 7 weeks, a gap, the rest
FIXED = """holdout AS (SELECT week, CASE WHEN i < 35 THEN 'train' WHEN i < 43 THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT week, row_number() OVER (ORDER BY week) - 1 AS i FROM (SELECT DISTINCT week FROM weekly)) WHERE i NOT IN (35, 43))"""


def _holdout(t):
    return splits.temporal_holdout(_weekly(t))


@query("h1_temporal_holdout", f"WITH {WEEKLY}, {HOLDOUT} SELECT * FROM holdout", ("txbc",))
def q_h1(t):
    return _holdout(t)


@query("h2_fixed_holdout", f"WITH {WEEKLY}, {FIXED} SELECT * FROM holdout", ("txbc",))
def q_h2(t):
    return splits.fixed_holdout(_weekly(t))


@query("h3_check_split", f"""WITH {WEEKLY}, {HOLDOUT}, s AS (SELECT split, min(week) AS lo, max(week) AS hi FROM holdout GROUP BY split)
SELECT 'one_split_per_week' AS "check", (SELECT max(k) = 1 FROM (SELECT count(DISTINCT split) AS k FROM holdout GROUP BY week)) AS passed
UNION ALL SELECT 'ordered_in_time', (SELECT hi FROM s WHERE split = 'train') < (SELECT lo FROM s WHERE split = 'valid')
  AND (SELECT hi FROM s WHERE split = 'valid') < (SELECT lo FROM s WHERE split = 'test')""", ("txbc",))
def q_h3(t):
    return splits.check_split(_holdout(t))


@query("j5_attach_split", f"WITH {WEEKLY}, {HOLDOUT} SELECT w.*, h.split FROM weekly w JOIN holdout h ON w.week = h.week",
       ("txbc",))
def q_j5(t):
    w = _weekly(t)
    return joins.attach_split(w, splits.temporal_holdout(w))


@query("a11_split_summary", f"""WITH {WEEKLY}, {HOLDOUT}
SELECT split, count(*) AS n_rows, count(DISTINCT w.week) AS n_weeks, count(DISTINCT customer_id) AS n_customers,
  count(DISTINCT product_id) AS n_products, min(w.week) AS start, max(w.week) AS "end"
FROM weekly w JOIN holdout h ON w.week = h.week GROUP BY split""", ("txbc",))
def q_a11(t):
    w = _weekly(t)
    return aggs.split_summary(joins.attach_split(w, splits.temporal_holdout(w)))


@query("a12_pivot_counts", f"""WITH {WEEKLY}, {HOLDOUT}
SELECT w.week, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'valid') AS valid,
  count(*) FILTER (WHERE split = 'test') AS test FROM weekly w JOIN hw h ON w.week = h.week GROUP BY w.week""", ("txbc",))
def q_a12(t):
    w = _weekly(t)
    j = joins.attach_split(w, splits.temporal_holdout(w, keep_gap=True))
    return aggs.pivot_counts(j, "week", "split", ["train", "valid", "test"])


POOL = f"""pool AS (SELECT product_id, sum(bought) AS n FROM weekly w JOIN holdout h ON w.week = h.week
  WHERE split = 'train' GROUP BY 1 ORDER BY n DESC, product_id LIMIT 10)"""


@query("t2_train_pool", f"WITH {WEEKLY}, {HOLDOUT}, {POOL} SELECT product_id, CAST(n AS BIGINT) AS n FROM pool", ("txbc",))
def q_t2(t):
    w = _weekly(t)
    return topk.train_pool(joins.attach_split(w, splits.temporal_holdout(w)), 10)


@query("h5_sample_negatives", f"""WITH {WEEKLY}, {HOLDOUT}, {POOL},
pidx AS (SELECT product_id, row_number() OVER (ORDER BY n DESC, product_id) - 1 AS _pi FROM pool),
cw AS (SELECT DISTINCT customer_id, w.week, split FROM weekly w JOIN holdout h ON w.week = h.week),
slots AS (SELECT cw.*, s.slot FROM cw, (SELECT unnest(range(0, 3)) AS slot) s),
draw AS (SELECT customer_id, week, split, slot,
  ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|' || CAST(week AS VARCHAR) || '|' || CAST(slot AS VARCHAR) || '|11'), 1, 8))::BIGINT
    % (SELECT count(*) FROM pool) AS _pi FROM slots)
SELECT d.customer_id, d.week, d.split, CAST(d.slot AS INTEGER) AS slot, p.product_id, 0 AS bought
FROM draw d JOIN pidx p ON d._pi = p._pi
WHERE NOT EXISTS (SELECT 1 FROM weekly x WHERE x.customer_id = d.customer_id AND x.week = d.week AND x.product_id = p.product_id)""",
       ("txbc",))
def q_h5(t):
    w = _weekly(t)
    lab = joins.attach_split(w, splits.temporal_holdout(w))
    pool = topk.train_pool(lab, 10)
    return splits.sample_negatives(lab, pool, 3, 11)


@query("u2_union_labels", f"""WITH {WEEKLY}, {HOLDOUT}, {POOL},
pidx AS (SELECT product_id, row_number() OVER (ORDER BY n DESC, product_id) - 1 AS _pi FROM pool),
cw AS (SELECT DISTINCT customer_id, w.week FROM weekly w JOIN holdout h ON w.week = h.week),
draw AS (SELECT customer_id, week, ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|' || CAST(week AS VARCHAR) || '|0|5'), 1, 8))::BIGINT
    % (SELECT count(*) FROM pool) AS _pi FROM cw),
neg AS (SELECT d.customer_id, d.week, p.product_id, 0 AS bought FROM draw d JOIN pidx p ON d._pi = p._pi
  WHERE NOT EXISTS (SELECT 1 FROM weekly x WHERE x.customer_id = d.customer_id AND x.week = d.week AND x.product_id = p.product_id))
SELECT w.customer_id, w.week, w.product_id, w.bought FROM weekly w JOIN holdout h ON w.week = h.week
UNION ALL SELECT * FROM neg""", ("txbc",))
def q_u2(t):
    w = _weekly(t)
    lab = joins.attach_split(w, splits.temporal_holdout(w)).drop("split")
    pool = topk.train_pool(joins.attach_split(w, splits.temporal_holdout(w)), 10)
    neg = splits.sample_negatives(lab, pool, 1, 5).drop("slot")
    return topk.union_labels(lab.select("customer_id", "week", "product_id", "bought"),
                             neg.select("customer_id", "week", "product_id", "bought"))


@query("h4_stratified_split", """SELECT doc_id, quality, CASE WHEN rn <= k THEN 'test' ELSE 'train' END AS split FROM (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || '|42')) AS rn,
         CAST(round(count(*) OVER (PARTITION BY quality) * (1.0 / 3)) AS BIGINT) AS k FROM labels)""")
def q_h4(t):
    return splits.stratified_split(t.labels.select("doc_id", "quality"), "quality", 1 / 3, 42, "doc_id")


@query("h6_sample_n", "SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|3') LIMIT 50")
def q_h6(t):
    return splits.sample_n(t.orders, 50, 3, "o_orderkey")


@query("h7_simulate_week", """WITH pairs AS (SELECT DISTINCT customer_id, product_id FROM txbc),
s AS (SELECT * FROM pairs ORDER BY md5(CAST(customer_id AS VARCHAR) || '|' || product_id || '|9') LIMIT 40)
SELECT customer_id, product_id, order_id, purchase_date, items, round(payment, 6) AS payment FROM txbc
UNION ALL SELECT customer_id, product_id, NULL, (SELECT max(purchase_date) FROM txbc) + INTERVAL 7 DAY, 1.0, 1.0 FROM s""",
       ("txbc",))
def q_h7(t):
    out = splits.simulate_week(clean_transactions(V.txb(t)), 40, 9)
    return out.withColumn("payment", F.round("payment", 6))


# ------------------------------------------------------------------ J3 / A15 / T3

@query("j3_expand_weeks", f"""WITH {WEEKLY}
SELECT c.customer_id, c.product_id, w.week FROM (SELECT DISTINCT customer_id, product_id FROM weekly) c
CROSS JOIN (SELECT DISTINCT week FROM weekly WHERE week > (SELECT max(week) FROM weekly) - INTERVAL 84 DAY) w""", ("txbc",))
def q_j3(t):
    """Every pair in each of the last twelve weeks."""
    w = _weekly(t)
    weeks = w.select("week").distinct()
    cal = weeks.crossJoin(F.broadcast(weeks.agg(F.max("week").alias("_l")))).where(F.col("week") > F.date_sub("_l", 84)).select("week")
    return joins.expand_weeks(w.select("customer_id", "product_id").distinct(), cal)


@query("a15_list_lengths", """WITH r AS (SELECT customer_id, product_id FROM (
  SELECT customer_id, product_id, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_id) AS rank
  FROM txbc GROUP BY 1, 2) WHERE rank <= 3), per AS (SELECT customer_id, count(*) AS k FROM r GROUP BY 1)
SELECT CAST(sum(k) AS BIGINT) AS n_rows, count(*) AS n_customers, round(avg(k), 6) AS mean_len, max(k) AS max_len FROM per""",
       ("txbc",))
def q_a15(t):
    g = clean_transactions(V.txb(t)).groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return aggs.list_lengths(windows.rank_topk(g, 3, score="n"))


@query("t3_extremes_with_support", """WITH d AS (SELECT DISTINCT customer_id, product_id, CAST(purchase_date AS DATE) AS d FROM tx),
g AS (SELECT product_id, d - lag(d) OVER (PARTITION BY customer_id, product_id ORDER BY d) AS gap FROM d),
iv AS (SELECT product_id, round(avg(gap), 6) AS mean_days, count(*) AS support FROM g WHERE gap IS NOT NULL GROUP BY 1),
ok AS (SELECT * FROM iv WHERE support >= (SELECT quantile_cont(support, 0.25) FROM iv))
(SELECT *, 'fastest' AS kind FROM ok ORDER BY mean_days, product_id LIMIT 10)
UNION ALL (SELECT *, 'slowest' FROM ok ORDER BY mean_days DESC, product_id LIMIT 10)""", ("tx",))
def q_t3(t):
    return topk.extremes_with_support(aggs.repurchase_interval(V.tx(t)))


# ------------------------------------------------------------------ metrics on SC

@query("k1_confusion", "SELECT y AS y_true, CAST(score >= 0.5 AS INTEGER) AS y_pred, count(*) AS n FROM sc GROUP BY 1, 2", ("sc",))
def q_k1(t):
    return metrics.confusion(V.sc(t).withColumn("y_hat", (F.col("score") >= 0.5).cast("int")))


K2_SQL = """WITH c AS (SELECT count(*) FILTER (WHERE y = 1 AND yh = 1) AS tp, count(*) FILTER (WHERE y = 0 AND yh = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND yh = 0) AS fn, count(*) FILTER (WHERE y = 0 AND yh = 0) AS tn
  FROM (SELECT y, CAST(score >= 0.5 AS INTEGER) AS yh FROM sc)),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM c)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(p, 6) AS precision, round(r, 6) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM m"""


@query("k2_binary_metrics", K2_SQL, ("sc",))
def q_k2(t):
    return metrics.binary_metrics(V.sc(t).withColumn("y_hat", (F.col("score") >= 0.5).cast("int")))


@query("k3_classification_report", """WITH d AS (SELECT y, CAST(score >= 0.5 AS INTEGER) AS yh FROM sc),
cls AS (SELECT y AS c FROM d UNION SELECT yh FROM d),
per AS (SELECT c, (SELECT count(*) FROM d WHERE y = c AND yh = c) AS tp, (SELECT count(*) FROM d WHERE yh = c) AS predicted,
               (SELECT count(*) FROM d WHERE y = c) AS support FROM cls),
m AS (SELECT CAST(c AS VARCHAR) AS label, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall, support FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), sum(support) FROM f""", ("sc",))
def q_k3(t):
    return metrics.classification_report(V.sc(t).withColumn("y_hat", (F.col("score") >= 0.5).cast("int")))


@query("k4_roc_auc", """WITH s AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM sc GROUP BY 1),
c AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM s)
SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN round(sum(pos * (coalesce(below, 0) + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) END AS roc_auc FROM c""",
       ("sc",))
def q_k4(t):
    return metrics.roc_auc(V.sc(t))


PR_SQL = """pr AS (SELECT score AS threshold, pos AS _pos,
  sum(pos) OVER (ORDER BY score DESC) / (sum(pos) OVER (ORDER BY score DESC) + sum(neg) OVER (ORDER BY score DESC)) AS precision,
  sum(pos) OVER (ORDER BY score DESC) / (SELECT count(*) FILTER (WHERE y = 1) FROM sc) AS recall
  FROM (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM sc GROUP BY 1))"""


@query("k5_average_precision", f"""WITH {PR_SQL}
SELECT round(sum(_pos / (SELECT count(*) FILTER (WHERE y = 1) FROM sc) * precision), 6) AS average_precision FROM pr""", ("sc",))
def q_k5(t):
    return metrics.average_precision(V.sc(t))


@query("k6_pr_curve", f"WITH {PR_SQL} SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr",
       ("sc",))
def q_k6(t):
    c = metrics.pr_curve(V.sc(t))
    return c.select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("k7_best_threshold", f"""WITH {PR_SQL}, f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM pr)
SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f
ORDER BY round(f1, 12) DESC, threshold LIMIT 1""", ("sc",))
def q_k7(t):
    return metrics.best_threshold(V.sc(t))


@query("k8_brier", "SELECT round(avg(pow(score - y, 2)), 6) AS brier FROM sc", ("sc",))
def q_k8(t):
    return metrics.brier(V.sc(t))


@query("k9_calibration_curve", """WITH e AS (SELECT quantile_cont(score, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS q FROM sc),
b AS (SELECT score, y, len(list_filter(q[2:10], lambda v: v < score)) AS bin FROM sc, e)
SELECT CAST(bin AS INTEGER) AS bin, round(avg(score), 6) AS mean_predicted, round(avg(y), 6) AS fraction_positive, count(*) AS n
FROM b GROUP BY bin""", ("sc",))
def q_k9(t):
    return metrics.calibration_curve(V.sc(t), 10)


# PRED / TRUTH over EV: batch w = 1..4; pred = top-2 types per user by events before week w; truth = types in week w
BATCH_SQL = """wk AS (SELECT unnest(range(1, 5)) AS batch),
pred AS (SELECT batch, customer_id, product_id FROM (
  SELECT batch, customer_id, product_id, row_number() OVER (PARTITION BY batch, customer_id ORDER BY count(*) DESC, product_id) AS rk
  FROM ev, wk WHERE period < DATE '2024-01-01' + INTERVAL (7 * batch) DAY GROUP BY 1, 2, 3) WHERE rk <= 2),
truth AS (SELECT DISTINCT batch, customer_id, product_id FROM ev, wk
  WHERE period >= DATE '2024-01-01' + INTERVAL (7 * batch) DAY AND period < DATE '2024-01-01' + INTERVAL (7 * batch + 7) DAY)"""


def _batches(t):
    e = V.ev(t)
    wk = t.spark.range(1, 5).select(F.col("id").cast("int").alias("batch"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.col("batch") * 7)
    hist = e.crossJoin(F.broadcast(wk)).filter(F.col("period") < start)  # 4 batches: parameter-bounded
    cnt = hist.groupBy("batch", "customer_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("batch", "customer_id").orderBy(F.desc("n"), "product_id")
    pred = cnt.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= 2).select("batch", "customer_id", "product_id")
    tr = e.crossJoin(F.broadcast(wk)).filter((F.col("period") >= start) & (F.col("period") < F.date_add(start, 7)))
    return pred, tr.select("batch", "customer_id", "product_id").distinct()


@query("k10_set_metrics", f"""WITH {BATCH_SQL},
p AS (SELECT customer_id, product_id FROM pred WHERE batch = 2), q AS (SELECT customer_id, product_id FROM truth WHERE batch = 2),
c AS (SELECT (SELECT count(*) FROM (SELECT * FROM p INTERSECT SELECT * FROM q)) AS tp,
             (SELECT count(*) FROM (SELECT * FROM p EXCEPT SELECT * FROM q)) AS fp,
             (SELECT count(*) FROM (SELECT * FROM q EXCEPT SELECT * FROM p)) AS fn)
SELECT tp, fp, fn, round(tp / (tp + fp + 1e-9), 6) AS precision, round(tp / (tp + fn + 1e-9), 6) AS recall,
  round(2 * (tp / (tp + fp + 1e-9)) * (tp / (tp + fn + 1e-9)) / ((tp / (tp + fp + 1e-9)) + (tp / (tp + fn + 1e-9)) + 1e-9), 6) AS f1 FROM c""",
       ("ev",))
def q_k10(t):
    pred, truth = _batches(t)
    return metrics.set_metrics(pred.filter(F.col("batch") == 2), truth.filter(F.col("batch") == 2))


@query("k11_batch_trend", f"""WITH {BATCH_SQL},
u AS (SELECT coalesce(p.batch, q.batch) AS batch, p.batch IS NOT NULL AS hp, q.batch IS NOT NULL AS hq FROM pred p FULL OUTER JOIN truth q
  ON p.batch = q.batch AND p.customer_id = q.customer_id AND p.product_id = q.product_id),
g AS (SELECT batch, count(*) FILTER (WHERE hp) AS n_pred, count(*) FILTER (WHERE hq) AS n_true, count(*) FILTER (WHERE hp AND hq) AS tp
  FROM u GROUP BY batch),
m AS (SELECT *, tp / (n_pred - tp + tp + 1e-9) AS p, tp / (n_true - tp + tp + 1e-9) AS r FROM g WHERE n_pred > 0)
SELECT batch, n_pred, n_true, tp, CASE WHEN n_true > 0 THEN round(p, 6) END AS precision, CASE WHEN n_true > 0 THEN round(r, 6) END AS recall,
  CASE WHEN n_true > 0 THEN round(2 * p * r / (p + r + 1e-9), 6) END AS f1 FROM m""", ("ev",))
def q_k11(t):
    pred, truth = _batches(t)
    return metrics.batch_trend(pred, truth)


@query("k12_jaccard_stability", """WITH runs AS (SELECT unnest(range(1, 5)) AS run),
s AS (SELECT run, doc_id AS item, round(0.5 * (('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|' || CAST(run AS VARCHAR)), 1, 8))::BIGINT % 1000) / 1000.0
        + 0.5 * least(distinct_share, 1.0), 3) AS score FROM clf, runs),
top AS (SELECT s.run, item FROM s JOIN (SELECT run, quantile_cont(score, 0.99) AS cut FROM s GROUP BY run) c ON s.run = c.run WHERE score >= cut),
sz AS (SELECT run, count(*) AS n FROM top GROUP BY run),
inter AS (SELECT a.run AS run_a, b.run AS run_b, count(*) AS inter FROM top a JOIN top b ON a.item = b.item AND a.run < b.run GROUP BY 1, 2)
SELECT x.run AS run_a, y.run AS run_b, coalesce(inter, 0) AS inter, round(coalesce(inter, 0) / (x.n + y.n - coalesce(inter, 0)), 6) AS jaccard
FROM sz x JOIN sz y ON x.run < y.run LEFT JOIN inter i ON i.run_a = x.run AND i.run_b = y.run""", ("clf",))
def q_k12(t):
    c = V.clf(t)
    runs = t.spark.range(1, 5).select(F.col("id").alias("run"))
    h = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("|"), F.col("run").cast("string")))
    b = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % 1000 / 1000.0
    s = c.crossJoin(F.broadcast(runs)).select("run", F.col("doc_id").alias("item"),
                                               F.round(0.5 * b + 0.5 * F.least(F.col("distinct_share"), F.lit(1.0)), 3).alias("score"))
    from cartwheel.functions.quantiles import exact_quantiles
    # one exact cut per resample (4 runs: a parameter-bounded loop)
    cuts = [(r, exact_quantiles(s.filter(F.col("run") == r), "score", [0.99])[1][0]) for r in range(1, 5)]
    cut = t.spark.createDataFrame(cuts, "run long, cut double")
    top = s.join(F.broadcast(cut), "run").filter(F.col("score") >= F.col("cut"))
    return metrics.jaccard_stability(top)


# ------------------------------------------------------------------ drift on EV (first vs last 15 days)

def _drift_frames(t):
    mid = V.ev_middle(t)
    e = V.ev(t).withColumn("value_shifted", F.col("value") + F.when(F.col("period") >= mid, 1.0).otherwise(0.0))
    return e.filter(F.col("period") < mid), e.filter(F.col("period") >= mid)


DRIFT_SQL = """e AS (SELECT *, value + CASE WHEN period >= (SELECT CAST(min(period) + INTERVAL 15 DAY AS DATE) FROM ev) THEN 1.0 ELSE 0.0 END AS value_shifted,
  CASE WHEN period < (SELECT CAST(min(period) + INTERVAL 15 DAY AS DATE) FROM ev) THEN 'ref' ELSE 'new' END AS sample FROM ev)"""


@query("d1_rate_drift", f"""WITH {DRIFT_SQL}, r AS (SELECT avg(CAST(product_id = 'purchase' AS INTEGER)) AS a FROM e WHERE sample = 'ref'),
n AS (SELECT avg(CAST(product_id = 'purchase' AS INTEGER)) AS b FROM e WHERE sample = 'new')
SELECT round(a, 6) AS ref_rate, round(b, 6) AS new_rate, round(abs(b - a) / greatest(a, 1e-6), 6) AS rel_change,
  CASE WHEN abs(b - a) / greatest(a, 1e-6) >= 0.1 THEN 'retrain' ELSE 'skip' END AS decision FROM r, n""", ("ev",))
def q_d1(t):
    r, n = _drift_frames(t)
    lab = (F.col("product_id") == "purchase").cast("int").alias("y")
    return drift.rate_drift(r.select(lab), n.select(lab), "y", 0.1)


KS_SQL = f"""{DRIFT_SQL},
l AS (SELECT sample, 'value' AS feature, value AS v FROM e UNION ALL SELECT sample, 'value_shifted', value_shifted FROM e),
c AS (SELECT feature, v, count(*) FILTER (WHERE sample = 'ref') AS a, count(*) FILTER (WHERE sample = 'new') AS b FROM l GROUP BY 1, 2),
cum AS (SELECT feature, v, sum(a) OVER (PARTITION BY feature ORDER BY v) / sum(a) OVER (PARTITION BY feature) AS fa,
               sum(b) OVER (PARTITION BY feature ORDER BY v) / sum(b) OVER (PARTITION BY feature) AS fb FROM c),
ks AS (SELECT feature, max(abs(fa - fb)) AS D FROM cum GROUP BY 1)"""


@query("d2_ks_drift", f"WITH {KS_SQL} SELECT feature, round(D, 6) AS statistic FROM ks", ("ev",))
def q_d2(t):
    r, n = _drift_frames(t)
    return drift.ks_drift(r, n, ["value", "value_shifted"]).select("feature", "statistic")


@query("d3_chi2_drift", f"""WITH {DRIFT_SQL},
c AS (SELECT product_id AS v, sample, count(*) AS n FROM e GROUP BY 1, 2),
rt AS (SELECT v, sum(n) AS rt FROM c GROUP BY 1), ct AS (SELECT sample, sum(n) AS ct FROM c GROUP BY 1), tot AS (SELECT sum(n) AS total FROM c),
g AS (SELECT rt.v, ct.sample, rt, ct, total, coalesce(c.n, 0) AS n FROM rt CROSS JOIN ct CROSS JOIN tot
      LEFT JOIN c ON c.v = rt.v AND c.sample = ct.sample)
SELECT 'product_id' AS feature, round(sum(pow(n - rt * ct / total, 2) / (rt * ct / total)), 6) AS statistic,
  CAST((count(DISTINCT v) - 1) * (count(DISTINCT sample) - 1) AS BIGINT) AS dof FROM g""", ("ev",))
def q_d3(t):
    r, n = _drift_frames(t)
    return drift.chi2_drift(r, n, ["product_id"])


CHI2_SQL = """chi_long AS (SELECT sample, 'product_id' AS feature, product_id AS v FROM e UNION ALL SELECT sample, 'weekday', dayofweek(ts)::VARCHAR FROM e),
c AS (SELECT feature, v, sample, count(*) AS n FROM chi_long GROUP BY 1, 2, 3),
rt AS (SELECT feature, v, sum(n) AS rt FROM c GROUP BY 1, 2), ct AS (SELECT feature, sample, sum(n) AS ct FROM c GROUP BY 1, 2), tot AS (SELECT feature, sum(n) AS total FROM c GROUP BY 1),
g AS (SELECT rt.feature, rt.v, ct.sample, rt, ct, total, coalesce(c.n, 0) AS n FROM rt JOIN ct USING (feature) JOIN tot USING (feature)
      LEFT JOIN c ON c.feature = rt.feature AND c.v = rt.v AND c.sample = ct.sample),
chi AS (SELECT feature, round(sum(pow(n - rt * ct / total, 2) / (rt * ct / total)), 6) AS statistic, (count(DISTINCT v) - 1) * (count(DISTINCT sample) - 1) AS dof FROM g GROUP BY 1),
chip AS (SELECT *, greatest(0, 1 - list_sum(list_transform(range(0, 2000), lambda k: exp((dof / 2.0 + k) * ln(statistic / 2) - statistic / 2 - lgamma(dof / 2.0 + k + 1))))) AS p FROM chi)"""


@query("d3_chi2_flags", f"""WITH {DRIFT_SQL}, {CHI2_SQL}
SELECT feature, statistic, CAST(dof AS BIGINT) AS dof, round(p, 6) AS p_value, CAST(p < 0.05 AS INTEGER) AS drift FROM chip""", ("ev",))
def q_d3f(t):
    r, n = (x.withColumn("weekday", (F.dayofweek("ts") - 1).cast("string")) for x in _drift_frames(t))
    return drift.chi2_flags(drift.chi2_drift(r, n, ["product_id", "weekday"])).withColumn("p_value", F.round("p_value", 6))


@query("d4_drift_score_all", f"""WITH {KS_SQL}, {CHI2_SQL.replace("c AS (SELECT feature, v, sample", "cc AS (SELECT feature, v, sample").replace("FROM c GROUP", "FROM cc GROUP").replace("LEFT JOIN c ON c.feature = rt.feature AND c.v = rt.v AND c.sample", "LEFT JOIN cc c ON c.feature = rt.feature AND c.v = rt.v AND c.sample")},
p AS (SELECT feature, D, (SELECT count(*) FROM e WHERE sample = 'ref') AS na, (SELECT count(*) FROM e WHERE sample = 'new') AS nb FROM ks),
f AS (SELECT CAST(D > 1.358 * sqrt((na + nb) / (na * nb)) AS INTEGER) AS drift FROM p UNION ALL SELECT CAST(p < 0.05 AS INTEGER) FROM chip)
SELECT round(avg(drift), 6) AS drift_score, count(*) AS n_features, avg(drift) >= 0.3 AS drifted FROM f""", ("ev",))
def q_d4a(t):
    """Numeric features by KS, categorical ones by chi-square."""
    r, n = (x.withColumn("weekday", (F.dayofweek("ts") - 1).cast("string")) for x in _drift_frames(t))
    flags = drift.ks_drift(r, n, ["value", "value_shifted"]).select("feature", "drift").unionByName(
        drift.chi2_flags(drift.chi2_drift(r, n, ["product_id", "weekday"])).select("feature", "drift"))
    return drift.drift_score(flags)


@query("d4_drift_score", f"""WITH {KS_SQL}, p AS (SELECT feature, D, (SELECT count(*) FROM e WHERE sample = 'ref') AS na,
  (SELECT count(*) FROM e WHERE sample = 'new') AS nb FROM ks),
f AS (SELECT CAST(D > 1.358 * sqrt((na + nb) / (na * nb)) AS INTEGER) AS drift FROM p)
SELECT round(avg(drift), 6) AS drift_score, count(*) AS n_features, avg(drift) >= 0.3 AS drifted FROM f""", ("ev",))
def q_d4(t):
    r, n = _drift_frames(t)
    ks = drift.ks_drift(r, n, ["value", "value_shifted"])
    return drift.drift_score(ks)
