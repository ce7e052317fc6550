"""Node tables: importances of a hand-made tree, Shapley values against all
coalitions, and fitted models read back."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import models as M
from cartwheel.operators import trees as R


def random_tree(rng, tree, n_features, depth):
    rows, size = [], itertools.count()

    def grow(n, d):
        node = next(size)
        if d == depth or rng.random() < 0.15 or n < 2:
            rows.append(dict(tree=tree, node=node, left=-1, right=-1, feature=None, threshold=None, categories=None, n=n, gain=None, value=rng.uniform(-1, 1)))
            return node
        r = dict(tree=tree, node=node, feature=rng.randrange(n_features), n=n, gain=rng.random(), value=None, threshold=None, categories=None)
        if rng.random() < 0.3:
            r["categories"] = [0.0, 2.0]
        else:
            r["threshold"] = rng.uniform(0, 3)
        rows.append(r)
        k = rng.randrange(0, n + 1)
        r["left"], r["right"] = grow(k, d + 1), grow(n - k, d + 1)
        return node

    grow(100, 0)
    return rows


def worth(rows, x, known):
    """Expected margin: known features decide, others count by their share of rows."""
    nodes = {r["node"]: r for r in rows}

    def go(i):
        r = nodes[i]
        if r["left"] < 0:
            return r["value"]
        left = x[r["feature"]] in r["categories"] if r["threshold"] is None else x[r["feature"]] <= r["threshold"]
        if r["feature"] in known:
            return go(r["left"] if left else r["right"])
        a = nodes[r["left"]]["n"] / r["n"] if r["n"] else 0.0
        b = nodes[r["right"]]["n"] / r["n"] if r["n"] else 0.0
        return a * go(r["left"]) + b * go(r["right"])

    return go(0)


@pytest.mark.parametrize("seed", range(6))
def test_shapley_equals_all_coalitions(seed):
    rng = random.Random(seed)
    forest = [random_tree(rng, t, 4, 6) for t in range(3)]
    e = R.Ensemble([r for tree in forest for r in tree])
    x = np.array([[rng.choice([0.0, 1.0, 2.0, 2.5, float("nan")]) for _ in range(4)] for _ in range(25)])
    phi = e.shapley(x)
    for row, got in zip(x, phi):
        v = {s: sum(worth(tree, row, s) for tree in forest) for k in range(5) for s in itertools.combinations(range(4), k)}
        for i in range(4):
            want = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (v[tuple(sorted((*s, i)))] - v[s]) for s in v if i not in s)
            assert got[i] == pytest.approx(want, abs=1e-12)
        assert e.base() == pytest.approx(v[()]) and e.base() + got.sum() == pytest.approx(v[0, 1, 2, 3])
    assert np.allclose(e.margin(x), e.base() + phi.sum(axis=1))


def test_importances_of_a_hand_made_tree(spark):
    rows = [(0, 0, 1, 2, 0, 1.0, None, 100, 0.4, None), (0, 1, 3, 4, 1, 2.0, None, 60, 0.1, None), (0, 2, -1, -1, None, None, None, 40, None, 0.5),
            (0, 3, -1, -1, None, None, None, 20, None, 0.1), (0, 4, 5, 6, 0, 3.0, [1.0], 40, 0.2, None),
            (0, 5, -1, -1, None, None, None, 30, None, 0.2), (0, 6, -1, -1, None, None, None, 10, None, 0.9)]
    got = {(r["kind"], r["feature"]): r["importance"] for r in R.importances_by_kind(spark.createDataFrame(rows, R.NODES), ["a", "b", "c"]).collect()}
    assert got["weight", "a"] == pytest.approx(2 / 3) and got["weight", "c"] == 0
    assert got["cover", "a"] == pytest.approx(70 / 130) and got["gain", "a"] == pytest.approx(0.3 / 0.4)
    for kind in ("weight", "cover", "gain"):
        assert sum(v for (k, _), v in got.items() if k == kind) == pytest.approx(1)
    single = R.importances_by_kind(spark.createDataFrame(rows[2:3], R.NODES), ["a"])
    assert {r["importance"] for r in single.collect()} == {0.0}


@pytest.mark.parametrize("kind,params", [("tree", {}), ("forest", {"numTrees": 4}), ("gbt", {"maxIter": 3})])
def test_fitted_models_read_back(spark, kind, params):
    d = spark.range(400).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                (F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("c"))
    d = M.assemble(d.withColumn("label", ((F.col("a") > 8) & (F.col("c") > 0.3) | (F.col("b") == 2)).cast("double")), ["a", "b", "c"])
    model = M.make_classifier(kind, **params).fit(d)
    nodes = R.node_table(model, spark)
    e = R.Ensemble(nodes.collect())
    rows = model.transform(d).orderBy("id").collect()
    want = [r["rawPrediction"][1] if kind == "gbt" else r["probability"][1] for r in rows]
    x = np.array([[r["a"], r["b"], r["c"]] for r in rows])
    assert np.allclose(e.margin(x), want)
    total = R.tree_contributions(nodes, d, ["a", "b", "c"], "id").groupBy("id").agg(F.sum("contribution").alias("s")).orderBy("id").collect()
    assert np.allclose([r["s"] + e.base() for r in total], want)
    m = R.measured(nodes, d, ["a", "b", "c"], "label").where("node = 0").first()
    assert m["n"] == 400
    assert R.tree_contributions(nodes, d.limit(0), ["a", "b", "c"], "id").count() == 0


def test_precision_bound_holds_the_share():
    from cartwheel.operators.explain import precision_bound
    assert precision_bound(0, 10, 0.05) == 0 == precision_bound(0, 0, 0.05)
    assert precision_bound(1000, 1000, 0.05) == math.floor(1e4 * 0.05 ** (1 / 1000)) / 1e4
    for n, k in ((50, 45), (500, 480), (20, 3)):
        b = precision_bound(k, n, 0.01)
        tail = math.fsum(math.comb(n, j) * b**j * (1 - b)**(n - j) for j in range(k, n + 1))
        assert 0 < b < k / n and tail <= 0.01  # so many hits are unlikely below the bound


def test_anchor_says_whether_it_reaches_the_target(spark):
    from cartwheel.operators.explain import anchor_rule
    df = spark.range(4000).select("id", (F.col("id") % 100).cast("double").alias("a"), (F.pmod(F.xxhash64("id"), F.lit(97))).cast("double").alias("b"),
                                  F.lit(1.0).alias("c"))
    df = df.withColumn("y", F.when((F.col("a") > 74) & (F.col("b") > 72), 1).otherwise((F.pmod(F.xxhash64("id"), F.lit(2)) == 0).cast("int")))
    row = {"a": 99.0, "b": 96.0, "c": 1.0, "y": 1}
    r = anchor_rule(df, row, ["a", "b", "c"], "y", 0.95)
    assert r["reached"] and r["rule"] == "a in quartile 4 AND b in quartile 4" and r["lower_bound"] >= 0.95 and r["precision"] == 1
    r = anchor_rule(df, {**row, "a": 1.0}, ["a", "b", "c"], "y", 0.95)
    assert not r["reached"] and r["lower_bound"] < 0.95 and r["covered"] > 0
