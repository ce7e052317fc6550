"""The guided search's sampler and log, and extremely randomised trees."""

import math

import numpy as np
from pyspark.sql import functions as F

from cartwheel.operators import extra_trees as E
from cartwheel.operators import guided as S
from cartwheel.operators import trees as R

SPACE = {"x": (0.0, 10.0), "lr": (1e-4, 1.0, "log"), "n": (1, 50, "int"), "kind": ["a", "b", "c"]}


def goal(p):
    return -(p["x"] - 3) ** 2 - (math.log10(p["lr"]) + 2) ** 2 - ((p["n"] - 20) / 10) ** 2 + (p["kind"] == "b")


def test_sampler_keeps_the_space_and_beats_chance():
    guided, chance = [], []
    for seed in range(6):
        rng, history = np.random.default_rng(seed), []
        for _ in range(60):
            p = S.suggest(history, SPACE, rng)
            assert 0 <= p["x"] <= 10 and 1e-4 <= p["lr"] <= 1 and 1 <= p["n"] <= 50 and isinstance(p["n"], int) and p["kind"] in SPACE["kind"]
            history.append((p, goal(p)))
        guided.append(np.mean([v for _, v in history[30:]]))
        chance.append(np.mean([goal(S.suggest([], SPACE, rng)) for _ in range(30)]))
    assert np.mean(guided) > np.mean(chance) / 3  # both negative: three times nearer
    assert S.suggest([({"x": 1.0}, None), ({"x": 2.0}, float("nan"))], SPACE, np.random.default_rng(0))  # failed trials are no evidence


def test_search_goes_on_from_its_log_and_records_failures(spark, tmp_path):
    df = spark.range(300).select("id", (F.col("id") % 17).cast("double").alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).cast("double").alias("b"),
                                 F.concat(F.lit("c"), F.col("id") % 4).alias("c"), (F.col("id") % 17 > 8).cast("double").alias("label"))
    path = str(tmp_path / "runs")
    space = {**S.SPACE, "maxIter": (2, 3, "int"), "maxDepth": (2, 2, "int"), "min_share": (0.01, 0.3)}
    train, valid, test = (df.where(F.col("id") % 3 == k) for k in range(3))
    assert S.guided_search(train, valid, ["a", "b"], ["c"], "label", path, 2, space).count() == 2
    runs = S.guided_search(train, valid, ["a", "b"], ["c"], "label", path, 1, {**space, "num_scaler": ["none"]})
    assert runs.count() == 3 and runs.where("artifact is not null").count() == 1
    got = {r["split"]: r for r in S.report_best(runs, train, valid, test, ["a", "b"], ["c"], "label", space).collect()}
    assert set(got) == {"train", "valid", "test"} and len({r["threshold"] for r in got.values()}) == 1 and got["test"]["n_rows"] == 100


def test_extra_trees_by_definition(spark):
    """Every split is the better of the drawn ones, on the node's rows; partitions don't matter."""
    rng = np.random.default_rng(2)
    x = np.round(rng.standard_normal((300, 3)), 2)
    x[::17, 1] = np.nan
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > 0)).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, label double")
    nodes = E.fit_extra_trees(df, ["a", "b", "c"], n_trees=4, max_depth=4, n_features=2).orderBy("tree", "node").collect()
    again = E.fit_extra_trees(df.repartition(7), ["a", "b", "c"], n_trees=4, max_depth=4, n_features=2).orderBy("tree", "node").collect()
    assert [r[:4] + r[4:5] for r in nodes] == [r[:4] + r[4:5] for r in again]
    gini = lambda v: 2 * v.mean() * (1 - v.mean()) if len(v) else 0.0
    table = {(r["tree"], r["node"]): r for r in nodes}

    def check(t, node, rows):
        r = table[t, node]
        assert r["n"] == len(rows)
        if r["left"] < 0:
            assert abs(r["value"] * 4 - y[rows].mean()) < 1e-9
            return
        best = None
        for f in E.drawn_features(7, t, node, 3, 2):
            v = x[rows, f]
            lo, hi = np.nanmin(v), np.nanmax(v)
            th = lo + E._draw(7, t, node, f) * (hi - lo)
            left = v <= th
            if lo < hi and 0 < left.sum() < len(rows):
                gain = gini(y[rows]) - (left.sum() * gini(y[rows][left]) + (~left).sum() * gini(y[rows][~left])) / len(rows)
                best = max(best or (-1,), (gain, -f, th))
        assert (r["feature"], r["threshold"]) == (-best[1], best[2]) and abs(r["gain"] - best[0]) < 1e-9
        left = x[rows, r["feature"]] <= r["threshold"]
        check(t, r["left"], rows[left])
        check(t, r["right"], rows[~left])

    for t in range(4):
        check(t, 1, np.arange(300))
    scored = E.score_trees(spark.createDataFrame(nodes, R.NODES), df, ["a", "b", "c"], ["id"]).orderBy("id").collect()
    hit = np.mean([(r["proba"] > 0.5) == v for r, v in zip(scored, y)])
    assert hit > 0.75
    assert E.fit_extra_trees(df.limit(0), ["a"], n_trees=2).count() == 0
