"""The neighbour search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import neighbours as N


def brute(rows, cols, k):
    """sklearn's rule: distances over common columns, weights 1 / distance, mean of donors at 0."""
    out = []
    for i, row in enumerate(rows):
        filled = list(row)
        for c in range(cols):
            if row[c] is not None:
                continue
            near, rest = [], [o for o in range(cols) if o != c]
            for j, other in enumerate(rows):
                both = [o for o in rest if row[o] is not None and other[o] is not None]
                if other[c] is not None and both:
                    near.append((math.sqrt(sum((row[o] - other[o]) ** 2 for o in both) * len(rest) / len(both)), j, other[c]))
            near = sorted(near)[:k]
            have = [r[c] for r in rows if r[c] is not None]
            zero = [v for d, _, v in near if d == 0]
            filled[c] = (sum(zero) / len(zero) if zero else sum(v / d for d, _, v in near) / sum(1 / d for d, _, _ in near) if near
                         else sum(have) / len(have) if have else None)
        out.append(filled)
    return out


@pytest.mark.parametrize("seed,n,leaf", [(1, 300, 8), (2, 120, 4)])
def test_columns_match_brute_force(spark, monkeypatch, seed, n, leaf):
    monkeypatch.setattr(N, "LEAF_ROWS", leaf)
    rng = np.random.default_rng(seed)
    x = np.round(rng.standard_normal((n, 4)) * [1, 5, 1, 20], 1)
    x[: n // 3] = x[0]  # a third of the rows are one vector
    x[n // 2:n // 2 + 5] = 1e6
    rows = [[None if rng.random() < 0.2 else float(v) for v in r] for r in x]
    rows[-1] = [None] * 4
    df = spark.createDataFrame([(i, *r, "z", i) for i, r in enumerate(rows)], "id long, a double, b double, c double, d double, fill string, v int")
    got = {r["id"]: r for r in N.impute_knn_columns(df, "id", ["a", "b", "c", "d"], 3).collect()}
    for i, want in enumerate(brute(rows, 4, 3)):
        assert [got[i][c] for c in "abcd"] == pytest.approx(want, abs=1e-9), i
        assert got[i]["fill"] == "z" and got[i]["v"] == i


def test_few_donors_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1.0, None, None), (2, None, 2.0, None), (3, 4.0, 5.0, None), (4, float("nan"), 5.0, None)], "id long, a double, b double, c double")
    got = {r["id"]: r for r in N.impute_knn_columns(df, "id", ["a", "b", "c"], 5).collect()}
    assert got[1]["b"] == 5.0 and got[4]["a"] == 4.0 and got[2]["a"] == 4.0 and all(r["c"] is None for r in got.values())
    assert N.impute_knn_columns(df.limit(0), "id", ["a", "b"]).count() == 0


def test_leaves_are_small_and_boxes_bound_the_search(spark, monkeypatch):
    """Donors that share a vector don't make a hot leaf; round two meets a small part of all pairs."""
    monkeypatch.setattr(N, "LEAF_ROWS", 32)
    rng = np.random.default_rng(5)
    rows = [(i, float(i), [0.5, 0.5] if i % 3 == 0 else rng.random(2).tolist()) for i in range(6000)]
    donors = spark.createDataFrame(rows, "did long, dv double, v array<double>")
    probes = spark.createDataFrame([(i, rng.random(2).tolist()) for i in range(200)], "pid long, v array<double>")
    met = []
    around = N.Forest.around
    top = N.nearest_donors(probes, donors, 2, 5).orderBy("pid", "rank").collect()
    x = np.array([r[2] for r in rows])
    for r in probes.collect():
        gap = np.sqrt(((x - r["v"]) ** 2).sum(axis=1))
        want = sorted(zip(gap.tolist(), range(6000)))[:5]
        assert [t["did"] for t in top if t["pid"] == r["pid"]] == [j for _, j in want]
    f = N.Forest(2)
    distinct = np.unique(x, axis=0)
    f.grow(3, distinct, -(-len(distinct) // 32))
    leaf = f.leaf_of(distinct)
    f.close({int(k): (distinct[leaf == k].min(axis=0), distinct[leaf == k].max(axis=0), int((leaf == k).sum())) for k in np.unique(leaf)})
    assert np.bincount(leaf).max() <= 64
    row, leaves = around(f, distinct[:100], np.full(100, 0.02))
    met = f.count[leaves].sum() / 100
    assert met < 0.1 * len(distinct)


def test_a_leaf_gives_back_no_more_than_k_donors_within_the_bound(monkeypatch):
    monkeypatch.setattr(N, "PAIRS", 700)  # several blocks
    rng = np.random.default_rng(8)
    x, w = np.round(rng.random((50, 3)), 1), np.round(rng.random((90, 3)), 1)
    x[rng.random(x.shape) < 0.2], w[rng.random(w.shape) < 0.2] = np.nan, np.nan
    bound = np.where(rng.random(50) < 0.5, np.inf, 0.3)
    got = list(zip(*(c.tolist() for c in N.leaf_search(x, w, bound, 4))))
    want = []
    for i, a in enumerate(x):
        far = []
        for j, b in enumerate(w):
            both = ~(np.isnan(a) | np.isnan(b))
            if both.any():
                far.append((math.sqrt(((a - b)[both] ** 2).sum() * 3 / both.sum()), j))
        want += [(i, j, pytest.approx(f)) for f, j in sorted(far)[:4] if f <= bound[i]]
    assert [(i, j) for i, j, _ in got] == [(i, j) for i, j, _ in want] and [g[2] for g in got] == [q[2] for q in want]


def test_probes_with_one_feature_meet_few_leaves(spark, monkeypatch):
    """Trees over the features in common: no search along the others, however many donors there are."""
    monkeypatch.setattr(N, "LEAF_ROWS", 16)
    rng = np.random.default_rng(6)
    x = rng.random((4000, 3))
    donors = spark.createDataFrame([(i, float(i), r) for i, r in enumerate(x.tolist())], "did long, dv double, v array<double>")
    asked = [[float(a), None, None] for a in rng.random(40)] + [[None, 0.5, 0.5]]
    probes = spark.createDataFrame(list(enumerate(asked)), "pid long, v array<double>")
    seen = spark.sparkContext.accumulator(0)
    search = N.leaf_search

    def counting(x, w, bound, k):
        seen.add(len(x) * len(w))
        return search(x, w, bound, k)

    monkeypatch.setattr(N, "leaf_search", counting)
    for views, most in ((16, 41 * 16 * 12), (0, 41 * 4000 * 2)):
        monkeypatch.setattr(N, "MAX_VIEWS", views)
        before = seen.value
        top = N.nearest_donors(probes, donors, 3, 5).orderBy("pid", "rank").collect()
        for p, v in enumerate(asked):
            own = [i for i in range(3) if v[i] is not None]
            gap = np.sqrt(sum((x[:, i] - v[i]) ** 2 for i in own) * (3 / len(own)))
            assert [t["did"] for t in top if t["pid"] == p] == np.argsort(gap, kind="stable")[:5].tolist()
        assert seen.value - before < most, views
