"""The tiled convolution against plain loops."""

import random

import pytest

from cartwheel.operators import grid


def looped(cells, name):
    m, off = grid.kernels()[name]
    kh, kw = len(m), len(m[0])
    held, times, size = {}, {}, {}
    for f, c, y, x, v in cells:
        held[f, c, y, x] = held.get((f, c, y, x), 0) + (v or 0)
        times[f, c, y, x] = times.get((f, c, y, x), 0) + 1
        h, w = size.get((f, c), (0, 0))
        size[f, c] = max(h, y + 1), max(w, x + 1)
    mirror = lambda i, n: -i - 1 if i < 0 else 2 * n - i - 1 if i >= n else i
    clip = lambda z: int(min(max(z, 0), 255))
    out = {}
    for (f, c, y, x), n in times.items():
        h, w = size[f, c]
        s = sum(m[i][j] * held.get((f, c, mirror(y + (kh - 1) // 2 - i, h), mirror(x + (kw - 1) // 2 - j, w)), 0)
                for i in range(kh) for j in range(kw))
        out[f, c, y, x] = clip(clip(round(n * s, 9)) + off)
    return out


@pytest.mark.parametrize("name", ["binomial7", "box7", "emboss"])
def test_convolution_over_tiles_holes_copies_and_nulls(spark, name):
    rng = random.Random(name)
    cells = [(1, 0, y, x, rng.randrange(256)) for y in range(70) for x in range(37) if rng.random() < 0.9]  # several tiles
    cells += [(2, 1, y, x, rng.randrange(256)) for y in range(2) for x in range(3)]  # smaller than the kernel
    cells += [(3, 2, 0, 0, None), (3, 2, 0, 1, 7), (3, 2, 0, 1, 9)]
    df = spark.createDataFrame(cells + [(None, 0, 0, 0, 5), (4, 0, None, 0, 5)], "frame long, channel int, y int, x int, v int")
    got = grid.convolve(df, name)
    assert {tuple(r)[:4]: r["v"] for r in got.collect()} == looped(cells, name)
    assert [t for _, t in got.dtypes] == ["bigint", "int", "int", "int", "int"]


def test_convolution_sends_a_cell_once_not_once_a_weight(spark):
    df = spark.range(64).selectExpr("1L AS frame", "0 AS channel", "cast(id div 8 AS int) AS y", "cast(id % 8 AS int) AS x", "1 AS v")
    plan = grid.convolve(df, "box7")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "ki" not in plan
