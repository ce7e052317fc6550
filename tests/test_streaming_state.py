"""Per-pair state that ends."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.streaming import batches as S


def test_state_shrinks_and_stretches_add_up(spark):
    """Pairs that stop buying leave the state; one that returns is counted whole."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=1)
    rows = [(i, i, "p", day(i % 5)) for i in range(200)]                       # buy once in the first week
    rows += [(1000 + w, 9000, "q", day(7 * w)) for w in range(12)]             # buys every week
    rows += [(2000 + w, 3, "p", day(70 + w)) for w in range(3)]                # comes back
    ev = spark.createDataFrame([(e, c, p, t, 1.0, 1) for e, c, p, t in rows],
                               "event_id long, customer_id long, product_id string, ts timestamp_ntz, value double, bought int")
    d = S.fresh_run_dirs(spark, "r4test")
    S.land_weekly_files(ev, d["landing"])
    got = {(r["customer_id"], r["product_id"]): (r["last_period"], r["n_events"])
           for r in S.stream_recency(spark, d["landing"], d["sink"], d["ckpt"], idle="10 days").collect()}
    want = {(r["customer_id"], r["product_id"]): (r["d"], r["n"]) for r in ev.groupBy("customer_id", "product_id").agg(
        F.max(F.to_date("ts")).alias("d"), F.count("*").alias("n")).collect()}
    assert got == want and got[(3, "p")][1] == 4
    closed = spark.read.parquet(d["sink"]).where("closed")
    assert closed.select("customer_id").distinct().count() >= 200
    held = [op["numRowsTotal"] for p in S.PROGRESS for op in [dict(x.jsonValue) if hasattr(x, "jsonValue") else x for x in p["stateOperators"]]
            if "transformWithState" in op["operatorName"]]
    assert max(held) >= 200 and held[-1] < 20


def test_a_known_pair_keeps_its_timer(spark):
    """No timer is taken down and set up again for every batch in which a pair buys."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=1)
    rows = [(100 * w + c, c, "p", day(7 * w + c % 5)) for w in range(4) for c in range(30)]
    ev = spark.createDataFrame([(e, c, p, t, 1.0, 1) for e, c, p, t in rows],
                               "event_id long, customer_id long, product_id string, ts timestamp_ntz, value double, bought int")
    d = S.fresh_run_dirs(spark, "r4timer")
    S.land_weekly_files(ev, d["landing"])
    got = {(r["customer_id"], r["last_period"], r["n_events"]) for r in S.stream_recency(spark, d["landing"], d["sink"], d["ckpt"]).collect()}
    assert got == {(c, day(21 + c % 5).date(), 4) for c in range(30)}
    reports = [dict(x.jsonValue) if hasattr(x, "jsonValue") else x for p in S.PROGRESS for x in p["stateOperators"]]
    reports = [dict(x["customMetrics"]) for x in reports if "transformWithState" in x["operatorName"]]
    assert reports
    assert sum(x["numRegisteredTimers"] for x in reports) == 30, reports[0]
    assert sum(x["numDeletedTimers"] for x in reports) == 0


def test_missing_keys_take_no_events_of_other_pairs(spark):
    rows = [(i, [None, 1, 2, 3][i % 4], ["p", None, "q"][i % 3], dt.datetime(2024, 1, 1) + dt.timedelta(days=i % 12)) for i in range(120)]
    ev = spark.createDataFrame([(e, c, p, t, 1.0, 1) for e, c, p, t in rows],
                               "event_id long, customer_id long, product_id string, ts timestamp_ntz, value double, bought int")
    d = S.fresh_run_dirs(spark, "r4null")
    S.land_weekly_files(ev, d["landing"])
    got = {(r["customer_id"], r["product_id"]): r["n_events"] for r in S.stream_recency(spark, d["landing"], d["sink"], d["ckpt"]).collect()}
    assert got == {(c, p): 10 for c in (None, 1, 2, 3) for p in ("p", None, "q")}
