"""Queries: the streaming family R1-R5 over EV landed as weekly files; each
must equal the batch answer (the DuckDB twin is the batch computation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.plans.catalog import query
from cartwheel.sources import tables as V
from cartwheel.streaming import batches as S


def _landed(t, name, spoilt=None):
    d = S.fresh_run_dirs(t.spark, name)
    ev = V.ev(t)
    if spoilt is not None:  # rows that validation must reject
        ev = ev.withColumn("customer_id", F.when(~spoilt, F.col("customer_id")))
    ev = ev.select("event_id", "customer_id", "product_id", "ts", "value", "bought")
    S.land_weekly_files(ev, d["landing"])
    return d


EVW = "evw AS (SELECT *, CAST(date_trunc('week', ts) AS DATE) AS week FROM ev)"


@query("r1_ingest_batches", f"""WITH {EVW} SELECT week, count(*) AS rows, count(*) FILTER (WHERE event_id % 97 <> 0) AS valid,
  count(*) FILTER (WHERE event_id % 97 = 0) AS rejected FROM evw GROUP BY week""", ("ev",))
def q_r1(t):
    d = _landed(t, "r1", F.col("event_id") % 97 == 0)
    return S.ingest_batches(t.spark, d["landing"], d["sink"], d["ckpt"]).drop("batch")


@query("r2_stream_weekly_activity", f"""WITH {EVW} SELECT customer_id, product_id, week, count(*) AS num_tx, 1 AS bought
FROM evw GROUP BY 1, 2, 3""", ("ev",))
def q_r2(t):
    d = _landed(t, "r2")
    return S.stream_weekly_activity(t.spark, d["landing"], d["sink"], d["ckpt"])


@query("r3_stream_dedupe", f"WITH {EVW} SELECT event_id, customer_id, product_id, ts, value, bought, week FROM evw",
       ("ev",))
def q_r3(t):
    d = _landed(t, "r3")
    return S.stream_dedupe(t.spark, d["landing"], d["sink"], d["ckpt"])


@query("r4_stream_recency", """SELECT customer_id, product_id, max(CAST(ts AS DATE)) AS last_period, count(*) AS n_events
FROM ev GROUP BY 1, 2""", ("ev",))
def q_r4(t):
    d = _landed(t, "r4")
    return S.stream_recency(t.spark, d["landing"], d["sink"], d["ckpt"], idle="5 days")


@query("r5_stream_drift", f"""WITH {EVW}, w AS (SELECT week, avg(CAST(product_id = 'purchase' AS INTEGER)) AS r FROM evw GROUP BY week),
ref AS (SELECT r AS a FROM w ORDER BY week LIMIT 1)
SELECT week, round(a, 6) AS ref_rate, round(r, 6) AS new_rate, round(abs(r - a) / greatest(a, 1e-6), 6) AS rel_change,
  CASE WHEN abs(r - a) / greatest(a, 1e-6) >= 0.1 THEN 'retrain' ELSE 'skip' END AS decision FROM w, ref""", ("ev",))
def q_r5(t):
    d = _landed(t, "r5")
    ev = V.ev(t)
    first = ev.agg(F.min("ts").alias("_m")).select(F.date_trunc("week", "_m").cast("date").alias("_w"))
    ref = ev.crossJoin(F.broadcast(first)).filter(F.date_trunc("week", "ts").cast("date") == F.col("_w"))
    return S.stream_drift(t.spark, d["landing"], d["sink"], d["ckpt"], ref, F.col("product_id") == "purchase")
