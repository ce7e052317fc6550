"""Model decisions on small inputs: reuse, retrain and the explicit baseline."""

import uuid

from pyspark.sql import functions as F

from cartwheel.plans import weekly as W


def _rows(spark, n=200):
    return spark.range(n).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 2 + F.col("id") % 5).cast("double").alias("a"))


def test_choose_model_retrains_then_reuses(spark):
    df, path = _rows(spark), W.model_dir(spark, uuid.uuid4().hex)
    first = W.choose_model(df, df, df, path, features=["a"])
    second = W.choose_model(df, df, df, path, features=["a"])
    drifted = W.choose_model(df, df, df.where("label = 1"), path, features=["a"])
    assert (first.decision, first.reason) == ("retrain", "no saved model")
    assert second.decision == "reuse" and drifted.decision == "retrain"
    assert abs(second.model.coefficients[0] - first.model.coefficients[0]) < 1e-12


def test_choose_model_falls_back_to_the_baseline(spark):
    df = _rows(spark).withColumn("a", F.lit(None).cast("double"))
    choice = W.choose_model(df, df, df, W.model_dir(spark, uuid.uuid4().hex), features=["a"])
    assert choice.decision == "baseline" and choice.model is None and choice.reason.startswith("fit failed")
