"""Queries: the minimum slice (TXD → C1 → A1 → U1 → J3 → J4 → W1..W8 → W12),
joins, windows, top-k and set operators over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import aggs, joins, topk, windows
from cartwheel.plans.catalog import query
from cartwheel.plans.features import (build_feature_matrix, clean_transactions, dense_universe,
                                      offer_next_week)
from cartwheel.sources import tables as V

# ------------------------------------------------------------------ SQL pieces

ACT = """act AS (
  SELECT customer_id, product_id, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
         count(*) AS num_tx, 1 AS bought
  FROM txc GROUP BY 1, 2, 3)"""
TOP20 = """top AS (SELECT product_id FROM txc GROUP BY product_id ORDER BY count(*) DESC, product_id LIMIT 20)"""
CAND = """cand AS (SELECT DISTINCT customer_id, product_id FROM (
  SELECT customer_id, product_id FROM txc
  UNION ALL SELECT c.customer_id, t.product_id FROM cust c CROSS JOIN top t))"""
WEEKS = """weeks AS (SELECT week, CAST(row_number() OVER (ORDER BY week) - 1 AS INTEGER) AS week_idx
  FROM (SELECT DISTINCT week FROM act))"""
DENSE = """dense AS (
  SELECT c.customer_id, c.product_id, w.week, w.week_idx,
         coalesce(a.num_tx, 0) AS num_tx, coalesce(a.bought, 0) AS bought
  FROM cand c CROSS JOIN weeks w
  LEFT JOIN act a ON a.customer_id = c.customer_id AND a.product_id = c.product_id AND a.week = w.week)"""
WP = "PARTITION BY customer_id, product_id ORDER BY week_idx"
FEAT = f"""feat AS (
  SELECT *,
    coalesce(lag(bought, 1) OVER ({WP}), 0) AS cp_prev_bought_lagged,
    CAST(coalesce(sum(bought) OVER ({WP} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cp_prev_bought,
    CAST(sum(bought) OVER ({WP} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS BIGINT) AS cp_count_4w_lagged,
    CAST(sum(bought) OVER ({WP} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS BIGINT) AS cp_count_12w_lagged,
    CAST(sum(bought) OVER ({WP} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS BIGINT) AS cp_count_4w,
    CAST(sum(bought) OVER ({WP} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS BIGINT) AS cp_count_12w,
    CAST(coalesce(week_idx - max(CASE WHEN bought = 1 THEN week_idx END) OVER ({WP} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 999) AS BIGINT) AS cp_recency_lagged,
    CAST(week_idx - max(CASE WHEN bought = 1 THEN week_idx END) OVER ({WP} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cp_recency
  FROM (SELECT d.*, b.category FROM dense d LEFT JOIN brand_dim b ON b.product_id = d.product_id))"""


def _prior(name, keys, src="feat"):
    k = ", ".join(keys)
    return f"""{name} AS (
  SELECT {k}, week_idx,
    (CAST(coalesce(sum(_b) OVER (PARTITION BY {k} ORDER BY week_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) + 1)
    / (CAST(coalesce(sum(_o) OVER (PARTITION BY {k} ORDER BY week_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) + 2) AS {name}
  FROM (SELECT {k}, week_idx, sum(bought) AS _b, count(*) AS _o FROM {src} GROUP BY {k}, week_idx))"""


PRIORS = ",\n".join([_prior("prod_prior_rate", ["product_id"]), _prior("cust_cat_prior_rate", ["customer_id", "category"])])
FM = f"""fm AS (
  SELECT f.*, p.prod_prior_rate, q.cust_cat_prior_rate
  FROM feat f
  LEFT JOIN prod_prior_rate p ON p.product_id = f.product_id AND p.week_idx = f.week_idx
  LEFT JOIN cust_cat_prior_rate q ON q.customer_id = f.customer_id AND q.category = f.category AND q.week_idx = f.week_idx)"""
CHAIN = ",\n".join([ACT, TOP20, CAND, WEEKS, DENSE, FEAT, PRIORS, FM])
BASE_VIEWS = ("txc", "cust", "brand_dim")
WHOLE_VIEWS = ("txbc", "cust", "brand_dim")


def _clean(t):
    return clean_transactions(V.txd(t))


def _all(t):
    """All orders, for the queries that are not of the dense grid."""
    return clean_transactions(V.txb(t))


def _whole(sql: str) -> str:
    return sql.replace("txc", "txbc")


def _fm(t):
    return build_feature_matrix(_clean(t), V.cust(t), V.brand_dim(t))


# ------------------------------------------------------------------ flagship

FLAGSHIP_SQL = f"""WITH {CHAIN},
scored AS (
  SELECT customer_id, product_id, week,
         round(0.6::DOUBLE * (cp_count_12w + 1.0::DOUBLE) / 14.0::DOUBLE + 0.2::DOUBLE * prod_prior_rate
               + 0.2::DOUBLE * cust_cat_prior_rate, 6) AS score
  FROM fm WHERE week_idx = (SELECT max(week_idx) FROM fm))
SELECT customer_id, product_id, week, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, product_id) AS rank FROM scored)
WHERE rank <= 10"""


@query("d6_offer_next_week", FLAGSHIP_SQL, BASE_VIEWS)
def q_offer(t):
    return offer_next_week(_clean(t), V.cust(t), V.brand_dim(t), top_k_candidates=20, k=10)


# ------------------------------------------------------------------ A1 / U1 / J3-J4 / W*

@query("c1_clean_transactions", "SELECT * FROM txbc", ("txbc",))
def q_all(t):
    return _all(t)


@query("a1_weekly_activity", f"WITH {_whole(ACT)} SELECT * FROM act", ("txbc",))
def q_a1(t):
    return aggs.weekly_activity(_all(t))


@query("t1_global_top", """SELECT product_id, count(*) AS n FROM txbc GROUP BY product_id
ORDER BY n DESC, product_id LIMIT 20""", ("txbc",))
def q_t1(t):
    return topk.global_top(_all(t), 20)


@query("u1_candidate_pairs", f"WITH {_whole(TOP20)}, {_whole(CAND)} SELECT * FROM cand", WHOLE_VIEWS)
def q_u1(t):
    c = _all(t)
    return topk.candidate_pairs(c, V.cust(t), topk.global_top(c, 20))


@query("j4_dense_universe", f"WITH {ACT}, {TOP20}, {CAND}, {WEEKS}, {DENSE} SELECT * FROM dense", BASE_VIEWS)
def q_dense(t):
    return dense_universe(_clean(t), V.cust(t).select("customer_id"), 20)


@query("w1_w8_feature_matrix", f"""WITH {CHAIN}
SELECT f.*, c.region_id, c.zone_id, c.customer_type, c.x FROM fm f LEFT JOIN cust c ON c.customer_id = f.customer_id""",
       BASE_VIEWS)
def q_fm(t):
    return _fm(t)


@query("w9_period_index", """SELECT week, CAST(row_number() OVER (ORDER BY week) - 1 AS INTEGER) AS week_idx
FROM (SELECT DISTINCT CAST(date_trunc('week', purchase_date) AS DATE) AS week FROM txbc)""", ("txbc",))
def q_w9(t):
    return windows.period_index(aggs.weekly_activity(_all(t)).select("week").distinct())


@query("w10_inter_event_days", """SELECT customer_id, invoice, invoice_date,
  CAST(floor((epoch(invoice_date) - epoch(lag(invoice_date) OVER (PARTITION BY customer_id ORDER BY invoice_date, invoice))) / 86400) AS BIGINT) AS gap_days
FROM (SELECT DISTINCT customer_id, invoice, invoice_date FROM ret)""", ("ret",))
def q_w10(t):
    v = V.ret(t).select("customer_id", "invoice", "invoice_date").distinct()
    return windows.inter_event_days(v, ["customer_id"], "invoice_date", ["invoice"])


@query("w11_latest_per_pair", """SELECT customer_id, product_id, week, num_tx, bought FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id, product_id ORDER BY week DESC) AS rn
  FROM (SELECT customer_id, product_id, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
               count(*) AS num_tx, 1 AS bought FROM txbc GROUP BY 1, 2, 3)
  WHERE week <= (SELECT max(o_orderdate)::DATE FROM orders) - INTERVAL 30 DAY) WHERE rn = 1""", ("txbc",))
def q_w11(t):
    """The latest week of each pair as of a month before the last order."""
    import datetime
    day = datetime.date.fromisoformat(V.last_order(t)[:10]) - datetime.timedelta(days=30)
    return windows.latest_per_pair(aggs.weekly_activity(_all(t)), day)


@query("w12_rank_topk", """SELECT customer_id, product_id, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT customer_id, product_id, count(*) AS n,
         row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_id) AS rank
  FROM txbc GROUP BY 1, 2) WHERE rank <= 3""", ("txbc",))
def q_w12(t):
    g = _all(t).groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return windows.rank_topk(g, 3, score="n").withColumn("rank", F.col("rank").cast("int"))


@query("w13_customer_top_products", """SELECT customer_id, string_agg(product_id, ',' ORDER BY rank) AS top_products FROM (
  SELECT customer_id, product_id,
         row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_id) AS rank
  FROM txbc GROUP BY 1, 2) WHERE rank <= 20 GROUP BY customer_id""", ("txbc",))
def q_w13(t):
    r = windows.customer_top_products(_all(t), 20)
    return r.select("customer_id", F.array_join("top_products", ",").alias("top_products"))


# ------------------------------------------------------------------ joins

@query("j1_enrich", """SELECT t.customer_id, t.product_id, t.order_id, t.purchase_date, t.items, t.payment,
  c.region_id, c.zone_id, c.customer_type, c.x, p.brand, p.category, p.size
FROM tx t LEFT JOIN cust c ON c.customer_id = t.customer_id LEFT JOIN prod p ON p.product_id = t.product_id""",
       ("tx", "cust", "prod"))
def q_j1(t):
    return joins.enrich(V.tx(t), V.cust(t), V.prod(t))


@query("j2_cross_top", f"WITH {_whole(TOP20)} SELECT c.customer_id, t.product_id FROM cust c CROSS JOIN top t", WHOLE_VIEWS)
def q_j2(t):
    return joins.cross_top(V.cust(t), topk.global_top(_all(t), 20))


@query("j6_drop_observed", """SELECT c.customer_id, t.product_id FROM cust c CROSS JOIN
  (SELECT product_id FROM txbc GROUP BY product_id ORDER BY count(*) DESC, product_id LIMIT 5) t
WHERE NOT EXISTS (SELECT 1 FROM txbc x WHERE x.customer_id = c.customer_id AND x.product_id = t.product_id)""",
       ("txbc", "cust"))
def q_j6(t):
    c = _all(t)
    neg = joins.cross_top(V.cust(t), topk.global_top(c, 5))
    return joins.drop_observed(neg, c, ["customer_id", "product_id"])


@query("j7_attach_features", """WITH per AS (SELECT customer_id, count(DISTINCT invoice) AS n_invoices FROM ret GROUP BY 1)
SELECT r.customer_id, r.invoice, r.quantity, p.n_invoices FROM ret r LEFT JOIN per p ON p.customer_id = r.customer_id""",
       ("ret",))
def q_j7(t):
    r = V.ret(t)
    per = r.groupBy("customer_id").agg(F.count_distinct("invoice").alias("n_invoices"))
    return joins.attach_features(r.select("customer_id", "invoice", "quantity"), per)


@query("j8_epsilon_join", f"""WITH p AS ({V.EMB_PLANE_SQL})
SELECT a.id AS i, b.id AS j, round(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)), 6) AS dist
FROM p a JOIN p b ON sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.05""")
def q_j8(t):
    return joins.epsilon_join(V.emb_plane(t), 0.05).withColumn("dist", F.round("dist", 6))


# ------------------------------------------------------------------ set operations

@query("u3_pair_sets", """WITH p AS (SELECT DISTINCT customer_id, product_id FROM ev WHERE period < (SELECT CAST(min(period) + INTERVAL 15 DAY AS DATE) FROM ev)),
     q AS (SELECT DISTINCT customer_id, product_id FROM ev WHERE period >= (SELECT CAST(min(period) + INTERVAL 15 DAY AS DATE) FROM ev))
SELECT (SELECT count(*) FROM (SELECT * FROM p INTERSECT SELECT * FROM q)) AS tp,
       (SELECT count(*) FROM (SELECT * FROM p EXCEPT SELECT * FROM q)) AS fp,
       (SELECT count(*) FROM (SELECT * FROM q EXCEPT SELECT * FROM p)) AS fn""", ("ev",))
def q_u3(t):
    e, mid = V.ev(t), V.ev_middle(t)
    return topk.pair_sets(e.filter(F.col("period") < mid), e.filter(F.col("period") >= mid))


@query("u4_pair_universe", """WITH p AS (SELECT DISTINCT customer_id, product_id FROM ev WHERE period < (SELECT CAST(min(period) + INTERVAL 15 DAY AS DATE) FROM ev)),
     q AS (SELECT DISTINCT customer_id, product_id FROM ev WHERE period >= (SELECT CAST(min(period) + INTERVAL 15 DAY AS DATE) FROM ev))
SELECT coalesce(p.customer_id, q.customer_id) AS customer_id, coalesce(p.product_id, q.product_id) AS product_id,
       CASE WHEN p.customer_id IS NULL THEN 0 ELSE 1 END AS y_pred, CASE WHEN q.customer_id IS NULL THEN 0 ELSE 1 END AS y_true
FROM p FULL OUTER JOIN q ON p.customer_id = q.customer_id AND p.product_id = q.product_id""", ("ev",))
def q_u4(t):
    e, mid = V.ev(t), V.ev_middle(t)
    return topk.pair_universe(e.filter(F.col("period") < mid), e.filter(F.col("period") >= mid))


@query("t5_recommend", """WITH own AS (
  SELECT customer_id, string_agg(product_id, ',' ORDER BY rank) AS l FROM (
    SELECT customer_id, product_id, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_id) AS rank
    FROM txbc GROUP BY 1, 2) WHERE rank <= 3 GROUP BY 1),
g AS (SELECT string_agg(product_id, ',' ORDER BY n DESC, product_id) AS l FROM
  (SELECT product_id, count(*) AS n FROM txbc GROUP BY 1 ORDER BY n DESC, product_id LIMIT 3))
SELECT c.customer_id, coalesce(o.l, g.l) AS products, o.l IS NOT NULL AS personal
FROM cust c LEFT JOIN own o ON o.customer_id = c.customer_id CROSS JOIN g""", ("txbc", "cust"))
def q_t5(t):
    c = _all(t)
    own = windows.customer_top_products(c, 3)
    g = topk.global_top(c, 3)
    glist = g.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("product_id").alias("p")))),
                              lambda s: s["p"]).alias("global_products"))
    r = topk.recommend(V.cust(t).select("customer_id"), own, glist, 3)
    return r.select("customer_id", F.array_join("products", ",").alias("products"), "personal")
