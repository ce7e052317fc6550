"""Queries: sources (S*), scalar functions (P*), integrity/profiling (C*) and
aggregations (A*) over the fixture views."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartwheel.functions import scalars as P
from cartwheel.operators import aggs, quality
from cartwheel.plans.catalog import query
from cartwheel.plans.features import clean_transactions
from cartwheel.session import shared_path
from cartwheel.sources import io
from cartwheel.sources import tables as V


def _clean(t):
    return clean_transactions(V.txb(t))


# ------------------------------------------------------------------ sources

@query("s1_load_tables", """SELECT 'lineitem' AS "table", count(*) AS rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'part', count(*) FROM part""")
def q_s1(t):
    tabs = V.load_tables(t.spark, t.dir, ["lineitem", "orders", "customer", "part"])
    return io.require_inputs(tabs).select("table", "rows")


@query("s2_read_csv", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_s2(t):
    path = shared_path(t.spark, f"s2_nation_csv_{uuid.uuid4().hex}")
    io.write_table(t.nation, path, fmt="csv")
    return io.read_csv(t.spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("s3_read_available", """SELECT r_regionkey, r_name, NULL::INTEGER AS n_nationkey, NULL::VARCHAR AS n_name FROM region
UNION ALL SELECT n_regionkey, NULL, n_nationkey, n_name FROM nation""")
def q_s3(t):
    a, b = shared_path(t.spark, f"s3_region_{uuid.uuid4().hex}"), shared_path(t.spark, f"s3_nation_{uuid.uuid4().hex}")
    io.write_table(t.region, a)
    io.write_table(t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), b)
    return io.read_available(t.spark, [a, shared_path(t.spark, f"s3_missing_{uuid.uuid4().hex}"), b]).select(
        "r_regionkey", "r_name", "n_nationkey", "n_name")


@query("s4_gated_sources", """SELECT customer_id, product_id FROM ev WHERE period < DATE '2024-01-16'
UNION ALL SELECT customer_id, product_id FROM ev WHERE period >= DATE '2024-01-16'""", ("ev",))
def q_s4(t):
    e = V.ev(t)
    first, second = e.filter(F.col("period") < "2024-01-16"), e.filter(F.col("period") >= "2024-01-16")
    return io.gated_sources(first, second, "2024-02-01", "2024-01-16").select("customer_id", "product_id")


@query("s5_read_pairs", """SELECT DISTINCT CAST(customer_id AS VARCHAR) AS customer_id, product_id FROM ev""", ("ev",))
def q_s5(t):
    path = shared_path(t.spark, f"s5_pairs_{uuid.uuid4().hex}")
    V.ev(t).select("customer_id", "product_id").write.mode("overwrite").option("header", False).csv(path)
    return io.read_pairs(t.spark, path)


@query("s6_read_truth", """SELECT DISTINCT CAST(customer_id AS VARCHAR) AS customer_id, product_id FROM ev
WHERE period >= DATE '2024-01-23'""", ("ev",))
def q_s6(t):
    stem = shared_path(t.spark, f"s6_truth_{uuid.uuid4().hex}")
    (V.ev(t).filter(F.col("period") >= "2024-01-23").select("customer_id", "product_id")
     .write.mode("overwrite").option("header", True).csv(stem + ".csv"))
    return io.read_truth(t.spark, stem + ".parquet")


@query("s7_read_records", """SELECT c_custkey, c_nationkey, c_acctbal FROM customer""")
def q_s7(t):
    path = shared_path(t.spark, f"s7_records_{uuid.uuid4().hex}")
    t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment").write.mode("overwrite").json(path)
    return io.read_records(t.spark, path, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string",
                           target="c_mktsegment")


@query("s8_assemble_documents", """SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text
FROM conversations WHERE text IS NOT NULL AND length(trim(text)) > 0 GROUP BY conv_id""")
def q_s8(t):
    return io.assemble_documents(t.conversations, "conv_id", "turn", "text")


@query("s9_write_table", """SELECT customer_id, product_id, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
  count(*) AS num_tx, 1 AS bought FROM txbc GROUP BY 1, 2, 3""", ("txbc",))
def q_s9(t):
    path = shared_path(t.spark, f"s9_weekly_{uuid.uuid4().hex}")
    io.write_table(aggs.weekly_activity(_clean(t)), path, partition_by=["week"])
    return t.spark.read.parquet(path).select("customer_id", "product_id", F.col("week").cast("date"), "num_tx", "bought")


@query("s10_require_inputs", """SELECT 'events' AS "table", count(*) AS rows, count(*) > 0 AS ok FROM events
UNION ALL SELECT 'labels', count(*), count(*) > 0 FROM labels
UNION ALL SELECT 'empty_orders', count(*), count(*) > 0 FROM orders WHERE o_totalprice < 0""")
def q_s10(t):
    return io.require_inputs({"events": t.events, "labels": t.labels,
                              "empty_orders": t.orders.filter(F.col("o_totalprice") < 0)})


@query("s11_latest_run", """SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def q_s11(t):
    return io.latest_run(t.orders, "o_orderdate")


def _runs(t):
    """Run log derived from the data: one run per document source, params from
    md5 of the source name, metric = quality rate of that source."""
    c = V.clf(t)
    g = c.groupBy("source").agg(F.avg("quality").alias("rate"), F.count(F.lit(1)).alias("n"))
    cols = io.run_record(
        F.col("source"),
        {"max_depth": V.md5_bucket(F.col("source"), 1, 10) + 2, "learning_rate": (V.md5_bucket(F.col("source"), 2, 100) + 1) / 1000.0},
        {"valid_f1": F.round(F.col("rate"), 6), "n": F.col("n")})
    return g.select(*cols)


RUNS_SQL = """runs AS (
  SELECT source AS run_name,
         MAP {'max_depth': CAST((('0x' || substr(md5(source || '|1'), 1, 8))::BIGINT % 10) + 2 AS VARCHAR),
              'learning_rate': CAST(((('0x' || substr(md5(source || '|2'), 1, 8))::BIGINT % 100) + 1) / 1000.0 AS VARCHAR)} AS params,
         round(avg(quality), 6) AS valid_f1, count(*) AS n
  FROM clf GROUP BY source)"""


@query("s12_log_run", f"""WITH {RUNS_SQL} SELECT run_name, valid_f1, CAST(n AS DOUBLE) AS n FROM runs""", ("clf",))
def q_s12(t):
    path = shared_path(t.spark, f"s12_runs_{uuid.uuid4().hex}")
    runs = _runs(t)
    first = runs.agg(F.min("run_name").alias("_first"))
    for later in (False, True):  # two appends to one table
        part = runs.crossJoin(F.broadcast(first)).where((F.col("run_name") > F.col("_first")) == later).drop("_first")
        io.log_run(part, path)
    r = t.spark.read.parquet(path)
    return r.select("run_name", F.col("metrics")["valid_f1"].alias("valid_f1"), F.col("metrics")["n"].alias("n"))


@query("s13_best_run", f"""WITH {RUNS_SQL} SELECT run_name, valid_f1 FROM runs ORDER BY valid_f1 DESC, run_name LIMIT 1""",
       ("clf",))
def q_s13(t):
    return io.best_run(_runs(t), "valid_f1").select("run_name", F.col("metrics")["valid_f1"].alias("valid_f1"))


# ------------------------------------------------------------------ scalar functions

@query("p1_normalize_names", """SELECT customer_id AS "customer id", invoice, invoice_date AS invoicedate, quantity, price FROM ret""",
       ("ret",))
def q_p1(t):
    r = V.ret(t).toDF(" Customer ID", "Invoice ", "InvoiceDate", " Quantity", "PRICE")
    return P.normalize_names(r)


@query("p2_to_number", """SELECT p_partkey, TRY_CAST(trim(CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size AS VARCHAR) || 'x'
  ELSE ' ' || CAST(p_size AS VARCHAR) END) AS DOUBLE) AS size_num FROM part""")
def q_p2(t):
    raw = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.col("p_size").cast("string"), F.lit("x"))) \
        .otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string")))
    return t.part.select("p_partkey", P.to_number(raw).alias("size_num"))


@query("p3_to_ts", """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 9 = 0 THEN 'bad' ELSE CAST(o_orderdate AS VARCHAR) END AS TIMESTAMP) AS ts
FROM orders""")
def q_p3(t):
    raw = F.when(F.col("o_orderkey") % 9 == 0, F.lit("bad")).otherwise(F.col("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", P.to_ts(raw).cast("timestamp_ntz").alias("ts"))


@query("p4_clean_ids_labels", """SELECT trim(CAST(c_custkey AS VARCHAR)) AS customer_id, upper(trim(' ' || lower(c_mktsegment) || ' ')) AS customer_type
FROM customer""")
def q_p4(t):
    return t.customer.select(P.clean_id("c_custkey").alias("customer_id"),
                             P.clean_label(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))).alias("customer_type"))


@query("p5_parse_liters", """SELECT product_id, size,
  CAST(NULLIF(regexp_extract(replace(size, ',', '.'), '(\\d*\\.?\\d+)', 1), '') AS DOUBLE) AS size_liters FROM prod""", ("prod",))
def q_p5(t):
    return V.prod(t).select("product_id", "size", P.parse_liters("size").alias("size_liters"))


@query("p6_parse_liters_strict", """SELECT product_id, size,
  TRY_CAST(trim(replace(replace(lower(size), 'l', ''), ',', '.')) AS DOUBLE) AS size_liters FROM prod""", ("prod",))
def q_p6(t):
    return V.prod(t).select("product_id", "size", P.parse_liters_strict("size").alias("size_liters"))


@query("p7_drop_null_keys", "SELECT * FROM numn WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL", ("numn",))
def q_p7(t):
    return P.drop_null_keys(V.numn(t), ["l_quantity", "l_extendedprice"])


@query("p8_positive_only", "SELECT * FROM ret WHERE quantity > 0", ("ret",))
def q_p8(t):
    return P.positive_only(V.ret(t), "quantity")


@query("p9_null_if_negative", "SELECT invoice, CASE WHEN quantity < 0 THEN NULL ELSE quantity END AS quantity FROM ret", ("ret",))
def q_p9(t):
    return V.ret(t).select("invoice", P.null_if_negative("quantity").alias("quantity"))


@query("p10_week_start", """SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_mon,
  CAST(date_trunc('week', o_orderdate - INTERVAL 1 DAY) + INTERVAL 1 DAY AS DATE) AS week_tue FROM orders""")
def q_p10(t):
    return t.orders.select("o_orderkey", P.week_start("o_orderdate", "MON").alias("week_mon"),
                           P.week_start("o_orderdate", "TUE").alias("week_tue"))


@query("p11_history_slice", """SELECT * FROM tx WHERE purchase_date >= DATE '2001-05-07' - INTERVAL 56 DAY
  AND purchase_date < DATE '2001-05-07' + INTERVAL 7 DAY""", ("tx",))
def q_p11(t):
    return P.history_slice(V.tx(t), "purchase_date", "2001-05-07", 8)


@query("p12_line_total", "SELECT invoice, quantity, price, round(quantity * price, 6) AS line_total FROM ret", ("ret",))
def q_p12(t):
    return V.ret(t).select("invoice", "quantity", "price", F.round(P.line_total("quantity", "price"), 6).alias("line_total"))


@query("p13_label_not_null", "SELECT l_orderkey, l_linenumber, CAST(l_quantity IS NOT NULL AS INTEGER) AS has_qty FROM numn", ("numn",))
def q_p13(t):
    return V.numn(t).select("l_orderkey", "l_linenumber", P.label_not_null("l_quantity").alias("has_qty"))


SEGMENT_GROUPS = {"AUTOMOBILE": "durable", "MACHINERY": "durable", "FURNITURE": "home", "HOUSEHOLD": "home"}


@query("p14_map_groups", """SELECT c_mktsegment, c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'durable' ELSE 'home' END AS "group"
FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY', 'FURNITURE', 'HOUSEHOLD')""")
def q_p14(t):
    return P.map_groups(t.customer.select("c_mktsegment", "c_custkey"), "c_mktsegment", SEGMENT_GROUPS)


@query("p15_apply_threshold", "SELECT doc_id, score, CAST(score >= 0.5 AS INTEGER) AS y_hat FROM sc", ("sc",))
def q_p15(t):
    return V.sc(t).select("doc_id", "score", P.apply_threshold("score", 0.5).alias("y_hat"))


@query("p16_decode_label", "SELECT doc_id, CASE quality WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS quality_label FROM labels")
def q_p16(t):
    return t.labels.select("doc_id", P.decode_label("quality", {0: "low", 1: "high"}).alias("quality_label"))


@query("p17_log1p_clip", """SELECT round(ln(1 + l_extendedprice), 6) AS log_price, greatest(l_discount, 0.02::DOUBLE) AS discount FROM lineitem""")
def q_p17(t):
    return t.lineitem.select(F.round(P.log1p("l_extendedprice"), 6).alias("log_price"),
                             P.clip_low("l_discount", 0.02).alias("discount"))


@query("p18_qcut", """WITH e AS (SELECT quantile_cont(l_extendedprice, [0, 1/3, 2/3, 1]) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice,
  CASE WHEN l_extendedprice <= q[2] THEN 'low' WHEN l_extendedprice <= q[3] THEN 'mid' ELSE 'high' END AS bin
FROM lineitem, e""")
def q_p18(t):
    return P.qcut(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", 3,
                  ["low", "mid", "high"])


@query("p19_align_schema", """SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal,
  c_mktsegment, CAST(c_acctbal > 0 AS INTEGER) AS positive, NULL::VARCHAR AS region_id FROM customer""")
def q_p19(t):
    raw = t.customer.select(F.col("c_custkey").cast("string").alias("c_custkey"),
                            F.col("c_acctbal").cast("string").alias("c_acctbal"), "c_mktsegment",
                            (F.col("c_acctbal") > 0).alias("positive"), F.lit("x").alias("unknown"))
    return P.align_schema(raw, ["c_custkey", "c_acctbal", "c_mktsegment", "positive", "region_id"])


@query("p20_sigmoid", "SELECT doc_id, round(1.0 / (1.0 + exp(-(4 * score - 2))), 6) AS p FROM sc", ("sc",))
def q_p20(t):
    return V.sc(t).select("doc_id", F.round(P.sigmoid(F.col("score") * 4 - 2), 6).alias("p"))


def token_sql(col: str) -> str:
    return (f"list_filter(regexp_split_to_array(regexp_replace(lower({col}), '[^a-záéíóúüñ0-9\\s]', ' ', 'g'), '\\s+'), "
            "lambda x: length(x) > 0)")


TOKEN_SQL = token_sql("text")


@query("p21_tokenize", f"""SELECT doc_id, len(tok) AS n_tokens, array_to_string(tok, ' ') AS tokens
FROM (SELECT doc_id, {TOKEN_SQL} AS tok FROM documents)""")
def q_p21(t):
    tok = P.tokenize("text")
    return t.documents.select("doc_id", F.size(tok).alias("n_tokens"), F.array_join(tok, " ").alias("tokens"))


# fixed values: keyword lists of the text router (ours), checked in order
ROUTES = [("english", [" the ", " and "]), ("spanish", [" que ", " los "]),
          ("french", [" les ", " une "]), ("german", [" die ", " und "])]


def _route_sql(col):
    parts = []
    for name, words in ROUTES:
        cond = " OR ".join(f"contains(lower({col}), '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + " ELSE 'general' END"


@query("p22_route_text", f"SELECT conv_id, turn, {_route_sql('text')} AS route FROM conversations")
def q_p22(t):
    return t.conversations.select("conv_id", "turn", P.route_text("text", ROUTES, "general").alias("route"))


@query("p23_split_xy", "SELECT doc_id, n_chars, n_words, round(mean_word_len, 6) AS mean_word_len, round(distinct_share, 6) AS distinct_share FROM clf", ("clf",))
def q_p23(t):
    x, _, _ = P.split_xy(V.clf(t), ["n_chars", "n_words", "mean_word_len", "distinct_share"], "quality", ["doc_id"])
    return x.select("doc_id", "n_chars", "n_words", F.round("mean_word_len", 6).alias("mean_word_len"),
                    F.round("distinct_share", 6).alias("distinct_share"))


# ------------------------------------------------------------------ integrity and profiling

MASTERS_SQL = """mc AS (SELECT customer_id FROM cust WHERE x > 0), mp AS (SELECT product_id FROM prod WHERE product_id IN
  (SELECT p_partkey FROM part WHERE p_size > 10))"""


def _masters(t):
    return {"customer_id": V.cust(t).filter(F.col("x") > 0),
            "product_id": t.part.filter(F.col("p_size") > 10).select(F.col("p_partkey").alias("product_id"))}


@query("c2_distinct_pairs", "SELECT DISTINCT customer_id, product_id FROM tx", ("tx",))
def q_c2(t):
    return quality.distinct_pairs(V.tx(t))


@query("c3_keep_known", f"""WITH {MASTERS_SQL} SELECT * FROM tx WHERE customer_id IN (SELECT customer_id FROM mc)
  AND product_id IN (SELECT product_id FROM mp)""", ("tx", "cust", "prod"))
def q_c3(t):
    return quality.keep_known(V.tx(t), _masters(t))


@query("c4_unknown_refs", f"""WITH {MASTERS_SQL}
SELECT *, 'unknown customer_id' AS reason FROM tx WHERE customer_id NOT IN (SELECT customer_id FROM mc)
UNION ALL SELECT *, 'unknown product_id' FROM tx WHERE product_id NOT IN (SELECT product_id FROM mp)""", ("tx", "cust", "prod"))
def q_c4(t):
    return quality.unknown_refs(V.tx(t), _masters(t))


@query("c5_assert_m1", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q_c5(t):
    return quality.assert_m1(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("c6_quality_report", """WITH w AS (SELECT customer_id, product_id, CAST(date_trunc('week', purchase_date) AS DATE) AS week FROM txbc)
SELECT 'no_negative_payment' AS test, coalesce(bool_and(payment >= 0), true) AS passed FROM txbc
UNION ALL SELECT 'no_negative_items', coalesce(bool_and(items IS NULL OR items >= 0), true) FROM txbc
UNION ALL SELECT 'keys_not_null', coalesce(bool_and(customer_id IS NOT NULL AND product_id IS NOT NULL), true) FROM txbc
UNION ALL SELECT 'dates_in_range', coalesce(bool_and(purchase_date BETWEEN (SELECT min(o_orderdate) FROM orders) AND (SELECT max(o_orderdate) FROM orders)), true) FROM txbc
UNION ALL SELECT 'weekly_key_unique', coalesce(max(n), 0) <= 1 FROM (SELECT count(*) AS n FROM w GROUP BY customer_id, product_id, week)""", ("txbc",))
def q_c6(t):
    c = _clean(t)
    first = t.orders.agg(F.min("o_orderdate").cast("string").alias("d")).first().d
    return quality.quality_report(c, c.withColumn("week", P.week_start("purchase_date")), first, V.last_order(t))


NUMN_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("c7_null_profile", " UNION ALL ".join(
    f"SELECT 'numn' AS dataset, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS pct FROM numn" for c in NUMN_COLS), ("numn",))
def q_c7(t):
    return quality.null_profile(V.numn(t).select(*NUMN_COLS), "numn")


@query("c8_column_overview", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", 'double' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS missing, "
    f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS pct, count(DISTINCT {c}) AS n_distinct FROM numn"
    for c in NUMN_COLS), ("numn",))
def q_c8(t):
    return quality.column_overview(V.numn(t).select(*NUMN_COLS))


def _summary_sql(src, cols, tails=False):
    parts = []
    for c in cols:
        q = "[0.25, 0.5, 0.75" + (", 0.01, 0.05, 0.95, 0.99]" if tails else "]")
        extra = "".join(f", round(q[{4 + i}], 6) AS {n}" for i, n in enumerate(["q01", "q05", "q95", "q99"])) if tails else ""
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS n, round(round(avg({c}), 9), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min({c}), 6) AS min, round(q[1], 6) AS q1, round(q[2], 6) AS median, round(q[3], 6) AS q3, round(max({c}), 6) AS max,
  round(skewness({c}), 6) AS skew, round(100.0 * count(*) FILTER (WHERE {c} = 0) / count({c}), 6) AS zeros_pct{extra}
FROM (SELECT *, (SELECT quantile_cont({c}, {q}) FROM {src}) AS q FROM {src}) GROUP BY q""")
    return " UNION ALL ".join(parts)


@query("c9_numeric_summary", _summary_sql("numn", NUMN_COLS, tails=True), ("numn",))
def q_c9(t):
    return quality.numeric_summary(V.numn(t), NUMN_COLS, wide_tails=True)


@query("c10_constant_columns", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column" FROM ev HAVING count(DISTINCT {c}) + coalesce(max(CAST({c} IS NULL AS INTEGER)), 0) <= 1"""
    for c in ["event_id", "customer_id", "product_id", "period", "value", "bought"]), ("ev",))
def q_c10(t):
    return quality.constant_columns(V.ev(t).drop("ts"))


@query("c11_classify_columns", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
  CASE WHEN coalesce(bool_and(CAST({c} AS DOUBLE) = floor(CAST({c} AS DOUBLE))), true) AND min({c}) >= 0 AND max({c}) <= 5
            AND count(DISTINCT {c}) <= 6 THEN 'likert'
       WHEN count(DISTINCT {c}) <= 10 THEN 'low_card' WHEN count(DISTINCT {c}) > 20 THEN 'continuous' ELSE 'medium' END AS kind
FROM lineitem""" for c in ["l_linenumber", "l_quantity", "l_discount", "l_tax"]))
def q_c11(t):
    return quality.classify_columns(t.lineitem, ["l_linenumber", "l_quantity", "l_discount", "l_tax"])


@query("c12_skewed_columns", f"SELECT \"column\", skew FROM ({_summary_sql('num', NUMN_COLS)}) WHERE skew > 1", ("num",))
def q_c12(t):
    return quality.skewed_columns(quality.numeric_summary(V.num(t), NUMN_COLS))


CLF_SKEW = ["n_chars", "n_words", "mean_word_len", "distinct_share"]


@query("c12_skewed_document_columns", f"SELECT \"column\", skew FROM ({_summary_sql('clf', CLF_SKEW)}) WHERE skew > 0.25", ("clf",))
def q_c12d(t):
    """Document features with a long right tail."""
    return quality.skewed_columns(quality.numeric_summary(V.clf(t), CLF_SKEW), 0.25)


@query("c13_class_balance", """SELECT lang, quality, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY lang), 6) AS share
FROM clf GROUP BY lang, quality""", ("clf",))
def q_c13(t):
    return quality.class_balance(V.clf(t), "quality", ["lang"])


# ------------------------------------------------------------------ aggregations

@query("a2_weekly_quantities", """SELECT customer_id, product_id, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
  coalesce(sum(items), 0) AS qty, count(*) AS num_lines, CAST(coalesce(sum(items), 0) > 0 OR count(*) > 0 AS INTEGER) AS bought
FROM txbc GROUP BY 1, 2, 3""", ("txbc",))
def q_a2(t):
    return aggs.weekly_quantities(_clean(t))


@query("a3_coverage", """SELECT count(DISTINCT customer_id) AS n_customers, count(DISTINCT product_id) AS n_products,
  count(DISTINCT CAST(date_trunc('week', purchase_date) AS DATE)) AS n_weeks,
  CAST(min(purchase_date) AS DATE) AS first_date, CAST(max(purchase_date) AS DATE) AS last_date FROM txbc""", ("txbc",))
def q_a3(t):
    return aggs.coverage(_clean(t))


@query("a4_orders_per_customer", "SELECT customer_id, count(DISTINCT order_id) AS n_orders, count(*) AS n_rows FROM tx GROUP BY 1",
       ("tx",))
def q_a4(t):
    return aggs.orders_per_customer(V.tx(t))


@query("a5_describe_counts", """SELECT round(avg(n_orders), 6) AS mean, round(quantile_cont(n_orders, 0.5), 6) AS median,
  round(quantile_cont(n_orders, 0.1), 6) AS p10, round(quantile_cont(n_orders, 0.9), 6) AS p90, CAST(max(n_orders) AS DOUBLE) AS max
FROM (SELECT customer_id, count(DISTINCT order_id) AS n_orders FROM tx GROUP BY 1)""", ("tx",))
def q_a5(t):
    return aggs.describe_counts(aggs.orders_per_customer(V.tx(t)), "n_orders")


@query("a6_basket_breadth", """WITH cw AS (SELECT customer_id, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
  count(DISTINCT product_id) AS k FROM txbc GROUP BY 1, 2), c AS (SELECT customer_id, avg(k) AS avg_k FROM cw GROUP BY 1)
SELECT round(avg(avg_k), 6) AS mean_breadth, round(quantile_cont(avg_k, 0.5), 6) AS median_breadth FROM c""", ("txbc",))
def q_a6(t):
    return aggs.basket_breadth(aggs.weekly_activity(_clean(t)))


@query("a7_volume_series_day", """SELECT CAST(purchase_date AS DATE) AS period, count(*) AS n_rows, round(sum(payment), 6) AS payment,
  count(DISTINCT customer_id) AS n_customers FROM txb GROUP BY 1""", ("txb",))
def q_a7d(t):
    return aggs.volume_series(V.txb(t), "day")


@query("a7_volume_series_week", """SELECT CAST(date_trunc('week', purchase_date) AS DATE) AS period, count(*) AS n_rows,
  round(sum(payment), 6) AS payment, count(DISTINCT customer_id) AS n_customers FROM txb GROUP BY 1""", ("txb",))
def q_a7w(t):
    return aggs.volume_series(V.txb(t), "week")


VISITS_SQL = """v AS (SELECT customer_id, invoice, max(invoice_date) AS visit_date, coalesce(sum(quantity * price), 0) AS spend
  FROM ret WHERE customer_id IS NOT NULL GROUP BY 1, 2)"""


@query("a8_visits", f"WITH {VISITS_SQL} SELECT customer_id, invoice, visit_date, round(spend, 6) AS spend FROM v", ("ret",))
def q_a8(t):
    return aggs.visits(V.ret(t)).withColumn("spend", F.round("spend", 6))


@query("a9_lrmfp", f"""WITH {VISITS_SQL},
g AS (SELECT *, CAST(floor((epoch(visit_date) - epoch(lag(visit_date) OVER (PARTITION BY customer_id ORDER BY visit_date, invoice))) / 86400) AS BIGINT) AS gap FROM v),
e AS (SELECT max(visit_date) AS _end FROM v)
SELECT customer_id,
  CAST(floor((epoch(max(visit_date)) - epoch(min(visit_date))) / 86400) AS BIGINT) AS length,
  CAST(floor((epoch(any_value(_end)) - epoch(max(visit_date))) / 86400) AS BIGINT) AS recency,
  count(*) AS frequency, round(round(avg(spend), 6), 2) AS monetary, round(round(coalesce(stddev_pop(gap), 0), 6), 2) AS periodicity
FROM g, e GROUP BY customer_id""", ("ret",))
def q_a9(t):
    return aggs.lrmfp(V.ret(t))


@query("a10_repurchase_interval", """WITH d AS (SELECT DISTINCT customer_id, product_id, CAST(purchase_date AS DATE) AS d FROM txbc),
g AS (SELECT product_id, d - lag(d) OVER (PARTITION BY customer_id, product_id ORDER BY d) AS gap FROM d)
SELECT product_id, round(avg(gap), 6) AS mean_days, count(*) AS support FROM g WHERE gap IS NOT NULL GROUP BY 1""", ("txbc",))
def q_a10(t):
    return aggs.repurchase_interval(_clean(t))


@query("a13_melt", """SELECT * FROM (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
UNPIVOT (value FOR variable IN (l_quantity, l_extendedprice, l_discount, l_tax))""")
def q_a13(t):
    return aggs.melt(V.num(t), [], NUMN_COLS)


HIST_SQL = """WITH b AS (SELECT l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL),
st AS (SELECT count(*) AS n, {lo} AS lo, {hi} AS hi, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM b),
k AS (SELECT lo, hi, {k} AS k FROM st),
j AS (SELECT CASE WHEN hi = lo THEN 0 ELSE CAST(least(floor((least(greatest(x, lo), hi) - lo) / ((hi - lo) / k)), k - 1) AS INTEGER) END AS bin,
             lo, hi, k FROM b, k)
SELECT bin, round(lo + bin * CASE WHEN hi = lo THEN 0 ELSE (hi - lo) / k END, 6) AS bin_lo,
       round(lo + (bin + 1) * CASE WHEN hi = lo THEN 0 ELSE (hi - lo) / k END, 6) AS bin_hi, count(*) AS count
FROM j GROUP BY bin, lo, hi, k"""
FD_K = """CAST(least(greatest(CASE WHEN q3 - q1 > 0 AND hi > lo THEN ceil((hi - lo) / (2.0 * (q3 - q1) / pow(CAST(n AS DOUBLE), 1.0 / 3.0)))
  ELSE floor(sqrt(CAST(n AS DOUBLE))) END, 10), 60) AS INTEGER)"""


@query("a14_histogram_fd", HIST_SQL.format(lo="min(x)", hi="max(x)", k=FD_K))
def q_a14(t):
    return aggs.histogram(t.lineitem, "l_extendedprice")


@query("a14_histogram_clip", HIST_SQL.format(lo="quantile_cont(x, 0.01)", hi="quantile_cont(x, 0.99)", k="20"))
def q_a14c(t):
    return aggs.histogram(t.lineitem, "l_extendedprice", bins=20, clip=(0.01, 0.99))


EMB_LONG = """l AS (SELECT label, 'e' || (pos - 1) AS variable, CAST(e AS DOUBLE) AS value FROM (
  SELECT label, unnest(embedding) AS e, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings))"""


def _by_label(wide):
    return wide[0], "label", wide[1]


@query("a16_cluster_profile", f"""WITH {EMB_LONG}
SELECT label, variable, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, count(value) AS count
FROM l GROUP BY 1, 2""")
def q_a16(t):
    return aggs.cluster_profile(*_by_label(V.emb_wide(t, "label")))


ES_SQL = f"""{EMB_LONG},
g AS (SELECT variable, avg(value) AS gm, stddev_pop(value) AS gs FROM l GROUP BY 1),
es AS (SELECT label, l.variable, round(CASE WHEN gs > 0 THEN (avg(value) - any_value(gm)) / any_value(gs) END, 6) AS effect
       FROM l JOIN g ON l.variable = g.variable GROUP BY label, l.variable, gs)"""


@query("a17_effect_size", f"WITH {ES_SQL} SELECT * FROM es")
def q_a17(t):
    return aggs.effect_size(*_by_label(V.emb_wide(t, "label")))


@query("a18_describe_cluster", f"""WITH {ES_SQL},
h AS (SELECT label, string_agg(variable, ', ' ORDER BY effect DESC, variable) FILTER (WHERE rk_h <= 4 AND effect >= 0.35) AS hi,
             string_agg(variable, ', ' ORDER BY effect ASC, variable) FILTER (WHERE rk_l <= 4 AND effect <= -0.35) AS lo
      FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY CASE WHEN effect >= 0.35 THEN 0 ELSE 1 END, effect DESC, variable) AS rk_h,
                      row_number() OVER (PARTITION BY label ORDER BY CASE WHEN effect <= -0.35 THEN 0 ELSE 1 END, effect ASC, variable) AS rk_l
            FROM es) GROUP BY label)
SELECT label, coalesce(NULLIF(concat_ws('; ', CASE WHEN hi IS NOT NULL THEN 'high: ' || hi END,
                                          CASE WHEN lo IS NOT NULL THEN 'low: ' || lo END), ''), 'balanced') AS description FROM h""")
def q_a18(t):
    return aggs.standout_means(aggs.effect_size(*_by_label(V.emb_wide(t, "label"))), "label")
