"""Exact interpolated quantiles without gathering a column into one task.

``percentile`` (exact) merges every distinct value of a group in a single
task; at scale that is unbounded.  Here each wanted rank is found in rounds,
for all columns at once.  A round takes approximate quantiles around the open
ranks (one aggregate), then counts the rows below and up to each of these
values (another aggregate).  A value with ``below <= rank < up to`` is the
answer; otherwise the next round looks strictly between the two nearest
values.  With the smallest and the largest value among those counted, every
round settles a rank or shrinks its range to about 6 / ``accuracy`` of its
rows, so the rounds grow with the logarithm of the rows.  There is one path
for all sizes; only bounds and counts reach the driver.
Interpolation matches ``percentile`` / ``quantile_cont``: position (n−1)·p
between the two neighbouring ranks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 2_000


class _Ranks:
    """What is known of one column: rows, wanted ranks, counted values."""

    def __init__(self, n: int, probs: Sequence[float]):
        self.n = n
        self.pos = [(n - 1) * p for p in probs] if n else [None for _ in probs]
        self.open = {k for h in self.pos if h is not None for k in (math.floor(h), min(math.ceil(h), n - 1))}
        self.counted: dict[float, tuple[int, int]] = {}  # value → rows below it, rows up to it
        self.found: dict[int, float] = {}

    def settle(self) -> None:
        for v, (below, upto) in self.counted.items():
            for k in [k for k in self.open if below <= k < upto]:
                self.found[k] = v
                self.open.discard(k)

    def ranges(self) -> dict[tuple[float | None, float | None], list[int]]:
        """Open ranks by the counted values on either side."""
        out: dict[tuple, list[int]] = {}
        for k in sorted(self.open):
            lo = max((v for v, (_, upto) in self.counted.items() if upto <= k), default=None)
            hi = min((v for v, (below, _) in self.counted.items() if below > k), default=None)
            out.setdefault((lo, hi), []).append(k)
        return out

    def rows_between(self, lo: float | None, hi: float | None) -> int:
        return (self.n if hi is None else self.counted[hi][0]) - (0 if lo is None else self.counted[lo][1])

    def result(self) -> list[float | None]:
        out = []
        for h in self.pos:
            if h is None:
                out.append(None)
                continue
            a, b = self.found[math.floor(h)], self.found[min(math.ceil(h), self.n - 1)]
            out.append(a if a == b else a + (h - math.floor(h)) * (b - a))
        return out


def _between(v: Column, lo: float | None, hi: float | None) -> Column:
    inside = v
    if lo is not None:
        inside = F.when(v > F.lit(lo), inside)
    if hi is not None:
        inside = F.when(v < F.lit(hi), inside)
    return inside


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int = ACCURACY) -> dict[str, tuple[int, list[float | None]]]:
    """(n non-null, [quantile for each p]) of each of ``cols``, with linear interpolation."""
    names = [f"v{i}" for i in range(len(cols))]
    if not names:
        return {}
    rows = df.select(*[F.col(c).cast("double").alias(v) for c, v in zip(cols, names)])
    rows = rows.select(*[F.when(~F.isnan(v), F.col(v)).alias(v) for v in names])  # nulls stay null
    first = rows.agg(*[F.count(v).alias(v) for v in names]).first()
    state = {v: _Ranks(first[v], probs) for v in names}
    while any(s.open for s in state.values()):
        looks = []  # (column, aggregates of one open range)
        for v, s in state.items():
            for (lo, hi), ranks in s.ranges().items():
                x, n = _between(F.col(v), lo, hi), s.rows_between(lo, hi)
                below = 0 if lo is None else s.counted[lo][1]
                near = {min(max((k - below + 1) / n + d / accuracy, 0.0), 1.0) for k in ranks for d in (-2, 0, 2)}
                looks.append((v, F.array(F.min(x), F.max(x)), F.percentile_approx(x, F.array(*[F.lit(p) for p in sorted(near)]), accuracy)))
        ends = rows.agg(*[c.alias(f"{kind}{i}") for i, (_, ext, mid) in enumerate(looks) for kind, c in (("e", ext), ("m", mid))]).first()
        values = sorted({(v, x) for i, (v, _, _) in enumerate(looks) for x in [*ends[f"e{i}"], *ends[f"m{i}"]]})
        counts = rows.agg(*[F.count_if(test).alias(f"{kind}{i}") for i, (v, x) in enumerate(values)
                            for kind, test in (("b", F.col(v) < F.lit(x)), ("u", F.col(v) <= F.lit(x)))]).first()
        for i, (v, x) in enumerate(values):
            state[v].counted[x] = (counts[f"b{i}"], counts[f"u{i}"])
        for s in state.values():
            s.settle()
    return {c: (state[v].n, state[v].result()) for c, v in zip(cols, names)}


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], accuracy: int = ACCURACY) -> tuple[int, list[float | None]]:
    """(n non-null, [quantile for each p]) with linear interpolation."""
    return column_quantiles(df, [col], probs, accuracy)[col]


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float], **kw) -> DataFrame:
    """One-row DataFrame with ``_q_<col>`` = array of exact quantiles (for
    broadcasting back into a plan)."""
    found = column_quantiles(df, cols, probs, **kw)
    schema = ", ".join(f"_q_{c} array<double>" for c in cols)
    return df.sparkSession.createDataFrame([tuple(found[c][1] for c in cols)], schema)
