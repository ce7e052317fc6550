"""Weekly jobs (D5, D7, D8): features → drift gate → train or reuse →
explain → rank, as compositions of the operators.

The only driver-side values are decisions (one row) and model parameters;
every data step stays a distributed DataFrame plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import history_slice
from cartwheel.operators import drift, explain, models
from cartwheel.operators.grid_logreg import fit_grid_logreg
from cartwheel.operators.windows import rank_topk
from cartwheel.plans.features import clean_transactions, offer_score, pair_grid
from cartwheel.session import shared_path

FEATURES = ["cp_prev_bought", "cp_count_4w", "cp_count_12w", "cp_recency_lagged", "cp_prev_bought_lagged",
            "prod_prior_rate", "cust_cat_prior_rate", "x"]


def labelled(fm: DataFrame) -> DataFrame:
    """Label = bought in the NEXT week of the same pair, as the matrix with ``label`` gives it."""
    return fm.withColumn("label", F.col("label").cast("double")) \
             .na.fill({"cp_count_4w_lagged": 0, "cp_count_12w_lagged": 0, "cp_recency": 999})


@dataclass
class Choice:
    decision: str
    reason: str
    model: object | None


def choose_model(train: DataFrame, ref: DataFrame, new: DataFrame, model_path: str, threshold: float = 0.1,
                 max_iter: int = 20, features=None, fit=None, weight: str | None = None) -> Choice:
    """Retrain when the label rate drifted (D1) or no model is saved;
    otherwise reuse the saved one; a failed fit falls back to the baseline
    heuristic — an explicit, reported branch, never a silent zero score.
    ``fit`` (estimator, assembled rows → model) fits without a pass over the rows;
    with ``weight`` a row of ``ref`` and ``new`` stands for so many."""
    gate = drift.rate_drift(ref, new, "label", threshold, weight).first()
    saved = None
    try:
        saved = LogisticRegressionModel.load(model_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    if saved is not None and gate["decision"] == "skip":
        return Choice("reuse", f"rate change {gate['rel_change']} below {threshold}", saved)
    try:
        lr = LogisticRegression(labelCol="label", featuresCol="features", maxIter=max_iter, regParam=0.01)
        rows = models.assemble(train, list(features or FEATURES))
        m = fit(lr, rows) if fit else lr.fit(rows)
        m.write().overwrite().save(model_path)
        why = "no saved model" if saved is None else f"rate change {gate['rel_change']} ≥ {threshold}"
        return Choice("retrain", why, m)
    except Exception as e:  # noqa: BLE001 - explicit fallback
        return Choice("baseline", f"fit failed: {e!r}"[:300], None)


def score_rows(rows: DataFrame, choice: Choice) -> DataFrame:
    if choice.model is None:
        return offer_score(rows)
    s = choice.model.transform(models.assemble(rows, FEATURES))
    from pyspark.ml.functions import vector_to_array
    return s.withColumn("score", F.round(vector_to_array("probability")[1], 6)).drop("features", "rawPrediction",
                                                                                         "probability", "prediction")


def weekly_run(tx: DataFrame, customers: DataFrame, products: DataFrame, model_path: str, k: int = 10,
               top_k_candidates: int = 20) -> tuple[DataFrame, Choice, DataFrame]:
    """(ranking for next week, model decision, global contributions)."""
    clean = clean_transactions(tx)
    # the pair table is written once; of the grid, which is n_weeks times larger, the gate counts the
    # labels, the fit makes a few thousand pairs at a time, the ranking and the contributions the last week
    grid = pair_grid(clean, customers, products, top_k_candidates, keep=True)
    n_weeks = grid.calendar.first()["_W"]
    last = n_weeks - 1
    rows = lambda weeks: labelled(grid.rows(label=True, weeks=weeks))
    early, until = max(last - 4, 0), max(last, 0)
    choice = choose_model(rows(lambda w: w < last), grid.label_counts(0, early), grid.label_counts(early, until), model_path, weight="weight",
                          fit=lambda lr, train: fit_grid_logreg(lr, grid.folded(), FEATURES, last, n_weeks, train))
    latest = rows(lambda w: w == last).drop("label")
    ranking = rank_topk(score_rows(latest, choice), k).select(
        "customer_id", "product_id", "week", F.col("score").cast("float").alias("proba_buy_next_week"),
        F.col("rank").cast("int").alias("rank"))
    if choice.model is not None:
        coef = dict(zip(FEATURES, choice.model.coefficients.toArray().tolist()))
        contrib = explain.global_contrib(explain.linear_contributions(latest, coef, "customer_id"), k=len(FEATURES))
    else:
        contrib = latest.sparkSession.createDataFrame([], "feature string, mean_abs double")
    return ranking, choice, contrib


def score_week(tx: DataFrame, customers: DataFrame, products: DataFrame, week: str, n_weeks: int,
               model_path: str, k: int = 10) -> DataFrame:
    """Rank next week's offers from the n weeks of history before ``week``
    (P11 slice reaches the parquet scan as a range filter)."""
    hist = history_slice(tx, "purchase_date", week, n_weeks)
    ranking, choice, _ = weekly_run(hist, customers, products, model_path, k)
    return ranking.withColumn("decision", F.lit(choice.decision))


def model_dir(spark, name: str) -> str:
    return shared_path(spark, f"models/{name}")
