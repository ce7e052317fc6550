"""Guided search over preprocessing and model (M6): a density-ratio sampler fed
by the run log, with TRAIN for fitting, VALID for choosing and TEST for the
report alone.

Every finished trial is appended to the run log (S12); before each round the
sampler reads the log again, so a search goes on from the trials of an earlier
one, and a lost driver loses no more than the running round.  Trials of a round
are concurrent Spark jobs."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import metrics
from cartwheel.operators.models import eval_scored, score
from cartwheel.operators.prep import build_preprocess
from cartwheel.sources.io import best_run, log_run

# name -> choices, or (low, high[, 'log' | 'int'])
SPACE = {"num_imputer": ["mean", "median"], "num_scaler": ["standard", "robust"], "min_share": (0.001, 0.02), "rare": ["true", "false"],
         "maxIter": (5, 40, "int"), "stepSize": (0.02, 0.3, "log"), "maxDepth": (2, 6, "int"), "minInstancesPerNode": (1, 50, "int"),
         "subsamplingRate": (0.5, 1.0), "minInfoGain": (1e-6, 1e-2, "log")}


def _scale(spec) -> tuple[float, float, str]:
    low, high, *kind = spec
    kind = kind[0] if kind else ""
    return (math.log(low), math.log(high), kind) if kind == "log" else (float(low), float(high), kind)


def _value(spec, x: float):
    _, _, kind = _scale(spec)
    low, high = spec[0], spec[1]
    return float(min(max(math.exp(x), low), high)) if kind == "log" else int(min(max(round(x), low), high)) if kind == "int" else float(min(max(x, low), high))


class _Numbers:
    """A truncated normal around every seen value, as wide as the gap to its
    neighbours, and one over the whole range."""

    def __init__(self, spec, seen: list):
        self.low, self.high, kind = _scale(spec)
        x = sorted(math.log(v) if kind == "log" else float(v) for v in seen)
        span = (self.high - self.low) or 1.0
        edge = [self.low, *x, self.high]
        width = [max(edge[i + 1] - edge[i], edge[i + 2] - edge[i + 1], span / (1 + len(x)) / 2) for i in range(len(x))]
        self.mean = np.array([*x, (self.low + self.high) / 2])
        self.width = np.array([*np.minimum(width, span), span])

    def draw(self, rng, n: int) -> np.ndarray:
        k = rng.integers(len(self.mean), size=n)
        return np.clip(rng.normal(self.mean[k], self.width[k]), self.low, self.high)

    def log_density(self, x: np.ndarray) -> np.ndarray:
        cdf = lambda z: np.array([math.erf(v / math.sqrt(2)) for v in z])
        mass = 0.5 * (cdf((self.high - self.mean) / self.width) - cdf((self.low - self.mean) / self.width))
        p = np.exp(-0.5 * ((x[:, None] - self.mean) / self.width) ** 2) / self.width / np.maximum(mass, 1e-12)
        return np.log(np.maximum(p.mean(axis=1), 1e-300))


class _Choices:
    """Shares of the seen choices, each counted once more."""

    def __init__(self, choices: list, seen: list):
        self.p = np.array([1.0 + sum(s == c for s in seen) for c in choices])
        self.p /= self.p.sum()

    def draw(self, rng, n: int) -> np.ndarray:
        return rng.choice(len(self.p), size=n, p=self.p)

    def log_density(self, x: np.ndarray) -> np.ndarray:
        return np.log(self.p[x])


def suggest(history: Sequence[tuple[dict, float]], space: dict, rng: np.random.Generator, startup: int = 5, share: float = 0.25,
            candidates: int = 24) -> dict:
    """The next trial: at random for the first ``startup`` trials, then, a
    parameter at a time, the candidate that is likeliest under the best
    ``share`` of the trials against the others."""
    done = sorted((h for h in history if h[1] is not None and not math.isnan(h[1])), key=lambda h: -h[1])
    good = done[:max(1, math.ceil(share * len(done)))] if len(done) >= startup else []
    rest = done[len(good):]
    out = {}
    for name, spec in space.items():
        seen = [[p[name] for p, _ in part if name in p] for part in (good, rest)]
        kind = _Choices if isinstance(spec, list) else _Numbers
        near, far = (kind(spec, s if good else []) for s in seen)
        x = near.draw(rng, candidates if good else 1)
        best = x[int(np.argmax(near.log_density(x) - far.log_density(x)))] if good else x[0]
        if not good and kind is _Numbers:
            best = rng.uniform(near.low, near.high)
        out[name] = spec[int(best)] if kind is _Choices else _value(spec, float(best))
    return out


def _typed(params: dict[str, str], space: dict) -> dict:
    """Parameters of a log row, which are strings, as the space has them."""
    return {k: (v if isinstance(space[k], list) else int(float(v)) if "int" in space[k] else float(v)) for k, v in params.items() if k in space}


def read_runs(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def make_pipeline(params: dict, num: Sequence[str], cat: Sequence[str], label: str, seed: int = 7) -> Pipeline:
    pre = build_preprocess(num, cat, params["num_scaler"], params["num_imputer"], params["min_share"], params["rare"] == "true")
    own = {k: v for k, v in params.items() if k in ("maxIter", "stepSize", "maxDepth", "minInstancesPerNode", "subsamplingRate", "minInfoGain")}
    return Pipeline(stages=[*pre.getStages(), GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **own)])


def guided_search(train: DataFrame, valid: DataFrame, num: Sequence[str], cat: Sequence[str], label: str, log_path: str, n: int,
                  space: dict = SPACE, seed: int = 7, parallel: int = 2, startup: int = 5) -> DataFrame:
    """The run log after ``n`` more trials: run_name, params, metrics (pr_auc,
    roc_auc, threshold, f1 on VALID, seconds), artifact (null, or why it failed).
    A failed trial is logged without metrics and counts as no evidence."""
    spark = train.sparkSession
    log_schema = "run_name string, params map<string,string>, metrics map<string,double>, artifact string"

    def trial(job):
        name, params = job
        t = time.time()
        try:
            model = make_pipeline(params, num, cat, label).fit(train)
            found, why = eval_scored(score(valid, model, [label]), label), None
        except Exception as e:  # noqa: BLE001 - recorded in the run log
            found, why = {}, f"failed: {e!r}"[:500]
        return (name, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in found.items() if v is not None} | {"seconds": time.time() - t}, why)

    done = 0
    while done < n:
        runs = read_runs(spark, log_path)
        logged = runs.select("params", F.col("metrics")["pr_auc"].alias("v")).collect() if runs is not None else []  # a row a trial
        history = [(_typed(r["params"], space), r["v"]) for r in logged]
        rng = np.random.default_rng([seed, len(history)])
        jobs = [(f"trial_{len(history) + i:04d}", suggest(history, space, rng, startup)) for i in range(min(parallel, n - done))]
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            rows = list(pool.map(trial, jobs))
        log_run(spark.createDataFrame(rows, log_schema).coalesce(1), log_path)
        done += len(jobs)
    return read_runs(spark, log_path)


def report_best(runs: DataFrame, train: DataFrame, valid: DataFrame, test: DataFrame, num: Sequence[str], cat: Sequence[str], label: str,
                space: dict = SPACE) -> DataFrame:
    """The best run on VALID, fitted again on TRAIN, on all three parts: split,
    n_rows, pr_auc, roc_auc, threshold (chosen on VALID), f1 at that threshold."""
    best = best_run(runs, "pr_auc").first()
    model = make_pipeline(_typed(best["params"], space), num, cat, label).fit(train)
    cut = best["metrics"]["threshold"]
    rows = []
    for name, part in (("train", train), ("valid", valid), ("test", test)):
        s = score(part, model, [label]).select(F.col(label).alias("y"), F.col("proba").cast("double").alias("score"))
        c = s.agg(F.count("*").alias("n"), F.count_if((F.col("score") >= cut) & (F.col("y") == 1)).alias("tp"),
                  F.count_if(F.col("score") >= cut).alias("pp"), F.count_if(F.col("y") == 1).alias("p")).first()
        f1 = 2 * c["tp"] / (c["pp"] + c["p"]) if c["pp"] + c["p"] else 0.0
        rows.append((name, c["n"], metrics.average_precision(s).first()[0], metrics.roc_auc(s).first()[0], cut, f1))
    return train.sparkSession.createDataFrame(rows, "split string, n_rows long, pr_auc double, roc_auc double, threshold double, f1 double")
