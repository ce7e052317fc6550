"""Logistic regression (M1) over a dense pairs x weeks grid, without its rows.

MLlib keeps every row of the grid as a vector, in memory or on disk.  Here a
task keeps one small record per pair, and every evaluation of the loss makes
the weeks of a few thousand pairs at a time.  The steps are those of MLlib's
binomial fit (standardised and centred features, L2 on the scaled
coefficients, Breeze's L-BFGS with a strong Wolfe search), so the model is the
one it would return for the rows, up to rounding.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.session import materialize

BLOCK = 8192  # pairs of a record, at most
TILE = 512    # pairs whose weeks are made at once, so that they stay in a core's cache


# ---------------------------------------------------------------- Breeze's L-BFGS

class _Failed(Exception):
    """A step that Breeze gives up: the history is dropped once, then the search ends."""


def _interpolate(l, r):
    """The least point of the cubic through two brackets (t, slope, value), off their ends."""
    d1 = l[1] + r[1] - 3 * (l[2] - r[2]) / (l[0] - r[0])
    inner = d1 * d1 - l[1] * r[1]
    d2 = math.sqrt(inner) if inner >= 0 else math.nan
    t = r[0] - (r[0] - l[0]) * (r[1] + d2 - d1) / (r[1] - l[1] + 2 * d2)
    low, high = l[0] + 0.1 * (r[0] - l[0]), l[0] + 0.9 * (r[0] - l[0])
    return low if t < low else high if t > high else t


def _wolfe(phi: Callable, zero: tuple, t: float, rounds: int = 10) -> float:
    """A step that meets the strong Wolfe conditions; ``phi`` gives (t, slope, value)."""
    c1, c2, (_, slope, value) = 1e-4, 0.9, zero
    if slope > 0:
        raise _Failed("no direction of descent")

    def zoom(low, high):
        for _ in range(rounds):
            c = phi(_interpolate(high, low) if low[0] > high[0] else _interpolate(low, high))
            if c[2] > value + c1 * c[0] * slope or c[2] >= low[2]:
                high = c
            else:
                if abs(c[1]) <= c2 * abs(slope):
                    return c[0]
                if c[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _Failed("zoom")

    low = zero
    for i in range(rounds):
        c = phi(t)
        if not math.isfinite(c[2]):
            t /= 2
            continue
        if c[2] > value + c1 * t * slope or (c[2] >= low[2] and i > 0):
            return zoom(low, c)
        if abs(c[1]) <= c2 * abs(slope):
            return c[0]
        if c[1] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _Failed("line search")


def lbfgs(f: Callable, x: np.ndarray, max_iter: int, tol: float, memory: int = 10) -> np.ndarray:
    """Minimise ``f`` (value, gradient) from ``x`` in the steps of Breeze's LBFGS."""
    seen: dict = {}

    def at(z):  # the last points, as the search ends where it evaluated
        key = z.tobytes()
        if key not in seen:
            if len(seen) > 24:
                seen.clear()
            seen[key] = f(z)
        return seen[key]

    value, grad = at(x)
    first, values, past, failed, i = value, [math.inf], [], False, 0

    def done():
        return (i >= max_iter or len(values) >= 2 and abs(value - max(values)) <= tol * first
                or np.linalg.norm(grad) <= max(tol * value, 1e-8))

    while not done():
        try:
            d = grad.copy()
            kept = []
            for s, y in past:
                rho = s @ y
                a = s @ d / rho if rho else math.nan
                if math.isnan(a):
                    raise _Failed("history")
                d -= a * y
                kept.append((a, rho))
            if past:
                s, y = past[0]
                if not s @ y >= 0:
                    raise _Failed("history")
                d *= (s @ y) / (y @ y)
            for (s, y), (a, rho) in zip(reversed(past), reversed(kept)):
                d += (a - y @ d / rho) * s
            d = -d

            def phi(t):
                v, g = at(x + t * d)
                return t, float(g @ d), v

            step = _wolfe(phi, (0.0, float(grad @ d), value), 1 / np.linalg.norm(d) if i == 0 else 1.0)
            if step * np.linalg.norm(grad) < 1e-10:
                raise _Failed("step too small")
            z = x + step * d
            v, g = at(z)
            past = [(z - x, g - grad), *past][:memory]
            values = [*values, v][-20:]
            x, value, grad, failed, i = z, v, g, False, i + 1
        except _Failed:
            if failed:
                break
            failed, past = True, []
    return x


# ---------------------------------------------------------------- records

STATE = ["cp_prev_bought", "cp_count_4w", "cp_count_12w", "cp_recency_lagged", "cp_prev_bought_lagged"]
PRIORS = ["prod_prior_rate", "cust_cat_prior_rate"]


def _smallest(a: np.ndarray) -> np.ndarray:
    """``a`` in the smallest integers that hold it."""
    return a.astype(np.promote_types(np.min_scalar_type(a.min(initial=0)), np.min_scalar_type(a.max(initial=0))))


def state_tables(active, copies, copy, weeks: int, all_weeks: int) -> np.ndarray:
    """STATE and the label of pairs in their first ``weeks`` weeks, as ``pair_features_at`` gives them."""
    n = len(active)
    copies, copy = (np.asarray(c, np.int64)[:, None] for c in (copies, copy))
    hit = np.zeros((n, all_weeks + 2), np.int64)
    hit[np.repeat(np.arange(n), [len(x) for x in active]), np.array([w for x in active for w in x], np.int64)] = 1
    buys = np.concatenate([np.zeros((n, 1), np.int64), np.cumsum(hit, axis=1)], axis=1)  # before a week
    t, every = np.arange(weeks), np.arange(all_weeks + 2)

    def before(d):
        r = np.maximum(t * copies + copy + d, 0)
        w = r // copies
        return copies * np.take_along_axis(buys, w, 1) + (r - w * copies) * np.take_along_axis(hit, w, 1)

    last = np.maximum.accumulate(np.where(hit == 1, every, -1), axis=1)
    last = np.concatenate([np.full((n, 1), -1), last], axis=1)[:, :weeks]
    last = np.where((copy > 0) & (hit[:, :weeks] == 1), t, last)
    now, after = before(0), before(1)
    return np.stack([now, after - before(-3), after - before(-11), np.where(last < 0, 999, t - last), now - before(-1), before(2) - after], axis=1)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and how many each row has."""
    return pc.list_flatten(column).to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _record(b: pa.RecordBatch, weeks: int, all_weeks: int, others: int) -> dict:
    """A block of pairs in the order of their histories: the table of its distinct histories, its product
    curves, and by pair the steps and the pairs of the customer x category prior and the other features."""
    n, states = b.num_rows, {}
    copies, copy = (b.column(i).to_numpy() for i in (1, 2))
    keys = zip(map(tuple, b.column(0).to_pylist()), copies.tolist(), copy.tolist())
    state = np.array([states.setdefault(k, len(states)) for k in keys])
    order = np.argsort(state, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    names = {}
    curve = np.array([names.setdefault(p, (len(names), i))[0] for i, p in enumerate(b.column(3).to_pylist())])
    curves = [c[:weeks] if c else [math.nan] * weeks for c in b.column(4).take(pa.array([i for _, i in names.values()])).to_pylist()]
    at, long = _flat(b.column(5))
    cum, _ = _flat(b.column(6))
    rows = np.repeat(np.arange(n), long)
    adds = cum - np.where(np.diff(rows, prepend=-1) == 0, np.concatenate([[0], cum[:-1]]), 0)  # what a step adds to the sum
    rows, at = place[rows], at.astype(np.int64) + 1
    kept = np.lexsort((at, rows))
    kept = kept[at[kept] < weeks]
    return {
        "state": _smallest(state[order]), "table": _smallest(state_tables(*zip(*states), weeks, all_weeks)),
        "curve": _smallest(curve[order]), "curves": np.array(curves, float).reshape(len(curves), weeks),
        "rows": _smallest(rows[kept]), "weeks": _smallest(at[kept]), "adds": _smallest(adds[kept].astype(np.int64)),
        "pairs": b.column(7).to_numpy(zero_copy_only=False).astype(float)[order],
        "others": np.array([b.column(8 + i).to_numpy(zero_copy_only=False).astype(float)[order] for i in range(others)]).reshape(others, n),
    }


def _priors(r: dict, lo: int, hi: int, weeks: int, out: np.ndarray | None = None, work: np.ndarray | None = None) -> np.ndarray:
    """The customer x category prior of pairs lo to hi in every week."""
    a, b = np.searchsorted(r["rows"], [lo, hi])
    out = np.empty((hi - lo, weeks)) if out is None else out
    out[...] = 0.0
    out[r["rows"][a:b].astype(np.int64) - lo, r["weeks"][a:b]] = r["adds"][a:b]
    np.cumsum(out, axis=1, out=out)
    work = np.multiply(r["pairs"][lo:hi, None], np.arange(weeks), out=work)
    out += 1.0
    work += 2.0
    out /= work
    return out


def _moments(v: np.ndarray, w: np.ndarray | None = None) -> tuple[float, float, float]:
    """Weight, mean and sum of squares around it; exact where all values are equal."""
    v = v.ravel()
    w = np.ones(len(v)) if w is None else w
    mean = v[0] + float((v - v[0]) @ w / w.sum())
    return float(w.sum()), mean, float((v - mean) ** 2 @ w)


def _merged(a: tuple, b: tuple) -> tuple:
    n, d = a[0] + b[0], b[1] - a[1]
    return n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n


def _totals(r: dict, weeks: int) -> list:
    """Positive labels, and the moments of STATE, PRIORS and the other features."""
    n, table = len(r["state"]), r["table"].astype(float)
    uses = np.bincount(r["state"], minlength=len(table)).astype(float)
    used = np.bincount(r["curve"], minlength=len(r["curves"])).astype(float)
    prior = functools.reduce(_merged, (_moments(_priors(r, lo, min(lo + TILE, n), weeks)) for lo in range(0, n, TILE)))
    return [float(uses @ table[:, -1].sum(axis=1)), *(_moments(table[:, k], np.repeat(uses, weeks)) for k in range(len(STATE))),
            _moments(r["curves"], np.repeat(used, weeks)), prior, *(_moments(v, np.full(n, float(weeks))) for v in r["others"])]


def _loss(r: dict, weeks: int, coef: np.ndarray, intercept: float) -> np.ndarray:
    """Log loss of the block's rows and its gradient by coefficient and intercept."""
    k, n = len(STATE), len(r["state"])
    state, labels = np.full((len(r["table"]), weeks), intercept), r["table"][:, -1].astype(float)
    for j in range(k):
        state += coef[j] * r["table"][:, j]  # the part of every history, week by week
    own = coef[k + 2:] @ r["others"]
    miss, g, loss = np.zeros_like(state), np.zeros(len(coef) + 1), 0.0
    room = np.empty((6, min(TILE, n), weeks))  # the same memory for all tiles
    for lo in range(0, n, TILE):
        hi = min(lo + TILE, n)
        curve, prior, m, e, work, label = room[:, :hi - lo]
        s = r["state"][lo:hi]
        np.take(r["curves"], r["curve"][lo:hi], axis=0, out=curve, mode="clip")
        np.take(labels, s, axis=0, out=label, mode="clip")
        _priors(r, lo, hi, weeks, prior, work)
        np.multiply(curve, coef[k], out=m)
        m += np.multiply(prior, coef[k + 1], out=work)
        m += np.take(state, s, axis=0, out=work, mode="clip")
        m += own[lo:hi, None]
        np.abs(m, out=e)
        np.exp(np.negative(e, out=e), out=e)
        loss += float(np.maximum(m, 0.0, out=work).sum()) - float(np.vdot(m, label))
        np.add(e, 1.0, out=work)
        # log(1 + e) of a tile's rows as the log of their product: a factor is 2 at most
        loss += float(np.log(np.multiply.reduce(work, axis=0)).sum())
        np.copyto(e, 1.0, where=m > 0)
        e /= work
        e -= label  # predicted less true
        starts = np.flatnonzero(np.diff(s.astype(np.int64), prepend=-1))
        miss[s[starts]] += np.add.reduceat(e, starts, axis=0)
        g[k] += np.vdot(e, curve)
        g[k + 1] += np.vdot(e, prior)
        g[k + 2:-1] += r["others"][:, lo:hi] @ e.sum(axis=1)
    g[:k] = [np.vdot(r["table"][:, j].astype(float), miss) for j in range(k)]
    g[-1] = miss.sum()
    return np.concatenate([[loss], g])


def fit_grid_logreg(lr: LogisticRegression, folded: DataFrame, features: list[str], weeks: int, all_weeks: int,
                    rows: DataFrame) -> LogisticRegressionModel:
    """``lr.fit`` on the first ``weeks`` weeks of the grid whose pairs ``folded`` lists (``PairGrid.folded``),
    with the STATE and PRIORS features, others being columns of a pair.  ``rows`` are those of the
    grid: of one label only, MLlib needs just one of them."""
    spark = folded.sparkSession
    others = [f for f in features if f not in STATE + PRIORS]
    names = STATE + PRIORS + others
    if sorted(names) != sorted(features):
        raise ValueError(f"the grid fit needs {STATE + PRIORS}")
    none = F.array().cast("array<bigint>")
    steps = lambda field: F.coalesce(F.transform("_m", lambda e: e[field].cast("bigint")), none)
    pairs = folded.select(
        "_active", F.col("_copies").cast("bigint"), F.col("_copy").cast("bigint"), "product_id", "_pc", steps("week_idx"), steps("cum"),
        F.when(F.col("_known"), F.col("_p").cast("double")), *[F.col(c).cast("double") for c in others]).toDF(
        "active", "copies", "copy", "product", "curve", "at", "cum", "pairs", *[f"x{i}" for i in range(len(others))])

    def pack(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                data = pickle.dumps(_record(b.slice(lo, BLOCK), weeks, all_weeks, len(others)), protocol=5)
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["record"])

    if weeks < 1:
        raise ValueError("no row to fit")
    records = materialize(pairs.mapInArrow(pack, "record binary")).rdd

    def total(part):
        out = None
        for r in part:
            t = _totals(pickle.loads(r[0]), weeks)
            out = t if out is None else [out[0] + t[0], *map(_merged, out[1:], t[1:])]
        return [] if out is None else [out]

    totals = records.mapPartitions(total).collect()  # a few numbers a task
    if not totals:
        raise ValueError("no row to fit")
    positive, *moments = functools.reduce(lambda a, b: [a[0] + b[0], *map(_merged, a[1:], b[1:])], totals)
    n, mean = moments[0][0], np.array([m[1] for m in moments])
    if not np.isfinite([m[1:] for m in moments]).all():
        raise ValueError("features must not be null, NaN or infinite")
    if positive in (0, n):
        return lr.fit(rows.limit(1))
    std = np.sqrt([m[2] / max(n - 1, 1) for m in moments])
    inverse = np.where(std > 0, 1 / np.where(std > 0, std, 1), 0.0)
    l2 = lr.getRegParam()

    def objective(z):
        coef = z[:-1] * inverse
        intercept = z[-1] - float(coef @ mean)
        sums = sum(records.mapPartitions(lambda part: [sum((_loss(pickle.loads(r[0]), weeks, coef, intercept) for r in part), np.zeros(len(z) + 1))])
                   .collect())
        g = np.append(inverse * (sums[1:-1] - mean * sums[-1]), sums[-1]) / n
        g[:-1] += l2 * z[:-1]
        return sums[0] / n + 0.5 * l2 * float(z[:-1] @ z[:-1]), g

    start = np.zeros(len(names) + 1)
    start[-1] = math.log(positive / (n - positive))
    z = lbfgs(objective, start, lr.getMaxIter(), lr.getTol())
    coef = z[:-1] * inverse
    by_name = dict(zip(names, coef.tolist()))
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        lr.uid, _py2java(spark.sparkContext, Vectors.dense([by_name[f] for f in features])), float(z[-1] - coef @ mean))
    return lr._copyValues(LogisticRegressionModel(java))
