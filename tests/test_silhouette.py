"""The exact silhouette against brute force."""

import math

import numpy as np
import pytest

from cartwheel.operators import silhouette as S


def test_matches_brute_force_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(S, "CELLS", 300)
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, (rng.normal(i % 3, 0.6, 2)).tolist()) for i in range(90)]
    rows += [(100, 7, [9.0, 9.0]), (101, -1, [0.0, 0.0]), (102, None, [0.0, 0.0]), (103, 1, None), (104, 2, rows[2][2]), (104, 2, rows[2][2])]
    df = spark.createDataFrame(rows, "id long, cluster int, features array<double>")
    known = [r for r in rows if r[1] is not None and r[1] >= 0 and r[2]]
    want = []
    for k, (i, c, v) in enumerate(known):
        by = {}
        for j, (_, o, w) in enumerate(known):
            if j != k:
                by.setdefault(o, []).append(math.dist(v, w))
        a = sum(by[c]) / len(by[c]) if c in by else None
        b = min(sum(x) / len(x) for o, x in by.items() if o != c)
        want.append((i, 0.0 if a is None else (b - a) / max(a, b)))
    got = sorted((r["id"], r["silhouette"]) for r in S.silhouette_rows(df).collect())
    assert [g[0] for g in got] == [w[0] for w in sorted(want)] and [g[1] for g in got] == pytest.approx([w[1] for w in sorted(want)])
    mean = {r["cluster"]: r["silhouette"] for r in S.silhouette_exact(df).collect()}
    assert mean[None] == pytest.approx(sum(w[1] for w in want) / len(want)) and mean[7] == 0
    some = S.silhouette_rows(df, every=3).collect()
    assert 0 < len(some) < len(want) and all(r["silhouette"] == pytest.approx(dict(got)[r["id"]]) for r in some if r["id"] != 104)
    assert S.silhouette_exact(df.where("cluster = 1")).count() == 0


def test_distances_of_near_and_far_rows(monkeypatch):
    """Equal rows are at 0 and near ones keep their digits, far from the origin too; far pairs need no differences."""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (60, 64)) + 1e4
    y = np.concatenate((x[:20], x[20:40] + 1e-6, rng.normal(0, 1, (50, 64)) + 1e4))
    want = np.array([[math.dist(a, b) for b in y.tolist()] for a in x.tolist()])
    got = S._distances(x, y)
    assert (np.diag(got)[:20] == 0).all() and got == pytest.approx(want, rel=1e-9)
    assert np.isinf(S._distances(np.full((1, 2), np.inf), np.zeros((1, 2)))).all()
    taken = []
    monkeypatch.setattr(S.np, "nonzero", lambda m, real=np.nonzero: taken.append(int(m.sum())) or real(m))
    S._distances(x, y)
    assert taken and sum(taken) <= 60
