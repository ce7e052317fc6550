"""The weekly fit without a row per pair and week, against MLlib on the rows."""

import datetime as dt
import uuid

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import functions as F

from cartwheel.operators import grid_logreg as G
from cartwheel.operators import models
from cartwheel.plans import weekly as W
from cartwheel.plans.features import pair_grid


def _grid(spark, twice=True):
    rng = np.random.default_rng(5)
    tx = [(int(c), "abcdef"[int(p)], dt.datetime(2024, 1, 1) + dt.timedelta(days=int(d))) for c, p, d in
          zip(rng.integers(0, 60, 700), rng.integers(0, 6, 700), rng.integers(0, 7 * 20, 700)) if c % 7 or d % 3]
    clean = spark.createDataFrame(tx, "customer_id long, product_id string, purchase_date timestamp_ntz")
    customers = [(i, float(rng.normal())) for i in range(65)] + [(3, 9.0)] * twice
    products = spark.createDataFrame([(p, "k" if p < "d" else "m") for p in "abcdef"], "product_id string, category string")
    return clean, spark.createDataFrame(customers, "customer_id long, x double"), products


def test_the_fit_is_mllibs(spark, monkeypatch):
    monkeypatch.setattr(G, "TILE", 7)
    grid = pair_grid(*_grid(spark), 4, keep=True)
    n = grid.calendar.first()["_W"]
    rows = models.assemble(W.labelled(grid.rows(True, lambda w: w < n - 1)), W.FEATURES)
    for lr in (LogisticRegression(maxIter=20, regParam=0.01), LogisticRegression(maxIter=7, regParam=0.5)):
        want = lr.fit(rows)
        got = G.fit_grid_logreg(lr, grid.folded(), W.FEATURES, n - 1, n, rows)
        assert np.allclose(got.coefficients.toArray(), want.coefficients.toArray(), rtol=1e-6, atol=1e-9)
        assert got.intercept == pytest.approx(want.intercept, rel=1e-6)


def test_state_of_every_copy(spark):
    grid = pair_grid(*_grid(spark), 4, keep=True)
    n = grid.calendar.first()["_W"]
    got = {}
    for r in grid.folded().select("customer_id", "product_id", "_active", "_copies", "_copy").collect():
        table = G.state_tables([r["_active"]], [r["_copies"]], [r["_copy"]], n - 1, n)[0]
        for t in range(n - 1):
            got.setdefault((r["customer_id"], r["product_id"], t), []).append(tuple(table[:, t]))
    want = {}
    for r in grid.rows(True, lambda w: w < n - 1).collect():
        want.setdefault((r["customer_id"], r["product_id"], r["week_idx"]), []).append(tuple(r[c] for c in [*G.STATE, "label"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_weekly_run_fits_without_the_rows(spark, monkeypatch):
    """The job fits from the pair table; MLlib's own fit, which keeps every row, isn't called."""
    clean, customers, products = _grid(spark)
    tx = clean.withColumn("order_id", F.lit(1)).withColumn("items", F.lit(1)).withColumn("payment", F.lit(1.0))
    monkeypatch.setattr(LogisticRegression, "fit", lambda *a: pytest.fail("MLlib was given the grid"))
    path = W.model_dir(spark, uuid.uuid4().hex)
    ranking, choice, contrib = W.weekly_run(tx, customers, products, path, k=3, top_k_candidates=4)
    assert choice.decision == "retrain" and ranking.where("rank = 1").select("customer_id").distinct().count() == 65
    assert contrib.count() == len(W.FEATURES)
    saved = LogisticRegressionModel.load(path)
    assert saved.coefficients == choice.model.coefficients and saved.intercept == choice.model.intercept


def test_null_features_fail_as_in_mllib(spark):
    clean, customers, products = _grid(spark)
    grid = pair_grid(clean, customers.where("customer_id <> 5"), products, 4, keep=True)
    n = grid.calendar.first()["_W"]
    with pytest.raises(ValueError):  # customer 5 bought but has no x
        G.fit_grid_logreg(LogisticRegression(), grid.folded(), W.FEATURES, n - 1, n, grid.rows(True))


def test_label_counts_are_those_of_the_rows(spark):
    from cartwheel.operators.drift import rate_drift
    grid = pair_grid(*_grid(spark), 4, keep=True)
    n = grid.calendar.first()["_W"]
    for a, b in ((0, n - 5), (n - 5, n - 1), (2, 2)):
        r = grid.rows(True, lambda w: (w >= a) & (w < b)).agg(F.count("label").alias("n"), F.sum("label").alias("s")).first()
        c = grid.label_counts(a, b).agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("s")).first()
        assert (r["n"], r["s"] or 0) == (c["n"], c["s"])
    rows = lambda a, b: grid.rows(True, lambda w: (w >= a) & (w < b))
    want = rate_drift(rows(0, n - 5), rows(n - 5, n - 1), "label").first()
    assert rate_drift(grid.label_counts(0, n - 5), grid.label_counts(n - 5, n - 1), "label", weight="weight").first() == want
    assert rate_drift(grid.label_counts(0, 0), grid.label_counts(0, 0), "label", weight="weight").first() == rate_drift(rows(0, 0), rows(0, 0), "label").first()


def test_score_week_is_the_fit_on_the_rows_of_its_history(spark, monkeypatch):
    """D8 ranks as MLlib's fit on the expanded history does, without handing MLlib that history."""
    clean, customers, products = _grid(spark)
    tx = clean.withColumn("order_id", F.lit(1)).withColumn("items", F.lit(1)).withColumn("payment", F.lit(1.0))
    hist = W.history_slice(tx, "purchase_date", "2024-04-08", 12)
    grid = pair_grid(W.clean_transactions(hist), customers, products, 20, keep=True)
    n = grid.calendar.first()["_W"]
    want = LogisticRegression(maxIter=20, regParam=0.01).fit(models.assemble(W.labelled(grid.rows(True, lambda w: w < n - 1)), W.FEATURES))
    scored = W.score_rows(grid.rows(weeks=lambda w: w == n - 1), W.Choice("retrain", "", want))
    want = {(r["customer_id"], r["product_id"]): r["score"] for r in scored.collect()}
    monkeypatch.setattr(LogisticRegression, "fit", lambda *a: pytest.fail("MLlib was given the grid"))
    got = W.score_week(tx, customers, products, "2024-04-08", 12, W.model_dir(spark, uuid.uuid4().hex), k=3).collect()
    assert n == 13 and len(got) == 3 * 65 and {r["decision"] for r in got} == {"retrain"}
    assert all(abs(r["proba_buy_next_week"] - want[r["customer_id"], r["product_id"]]) < 2e-6 for r in got if r["customer_id"] != 3)
