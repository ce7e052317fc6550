"""Extremely randomised trees (M2): thresholds drawn at random in each node,
grown a level at a time from statistics that Spark merges.

All trees grow together on all rows (no bootstrap).  A level takes two passes:
the range of the drawn features in every open node, then the class weights on
either side of one random threshold a feature.  Passes route Arrow batches
through the trees so far, which are broadcast; a batch emits a row a node and
feature.  What the driver gathers is bounded by the trees, their depth and the
drawn features.  The result is a node table (``trees.NODES``), so importances
and Shapley values read it as they read a fitted model's.

Draws come from md5 of (seed, tree, node, feature), with nodes numbered from 1
and children 2n and 2n + 1: the same rows give the same trees, however they are
partitioned."""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators.trees import NODES, Ensemble, _matrix
from cartwheel.session import materialize, shipped


def _draw(*key) -> float:
    """A number from 0 to 1, fixed by the key."""
    return int(hashlib.md5("|".join(map(str, key)).encode()).hexdigest()[:8], 16) / 2**32


def drawn_features(seed: int, tree: int, node: int, d: int, m: int) -> list[int]:
    return sorted(sorted(range(d), key=lambda f: (_draw(seed, tree, node, f, "pick"), f))[:m])


class _Growing:
    """Splits so far: for each tree, node -> (feature, threshold)."""

    def __init__(self, n_trees: int):
        self.splits: list[dict[int, tuple[int, float]]] = [{} for _ in range(n_trees)]

    def node_of(self, tree: int, x: np.ndarray) -> np.ndarray:
        at, splits = np.ones(len(x), np.int64), self.splits[tree]
        if not splits:
            return at
        size = max(splits) + 1
        feature, threshold = np.full(size, -1), np.zeros(size)
        for node, (f, th) in splits.items():
            feature[node], threshold[node] = f, th
        while True:
            inner = np.flatnonzero(at < size)
            inner = inner[feature[at[inner]] >= 0]
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = 2 * node + ~(x[inner, feature[node]] <= threshold[node])


def _by_node(at: np.ndarray, open_nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row order, the open nodes that have rows, and where each begins."""
    order = np.argsort(at, kind="stable")
    order = order[np.isin(at[order], open_nodes)]
    nodes, first = np.unique(at[order], return_index=True)
    return order, nodes, first


def fit_extra_trees(df: DataFrame, cols: Sequence[str], label: str = "label", weight: str | None = None, n_trees: int = 30,
                    max_depth: int = 5, min_rows: int = 1, n_features: int | None = None, seed: int = 7) -> DataFrame:
    """Node table of the trees; a leaf's value is the (weighted) share of label 1
    over the number of trees.  ``n_features`` are drawn in a node (square root by
    default).  Rows without a label are ignored; a missing value goes right."""
    cols, spark = list(cols), df.sparkSession
    d = len(cols)
    m = n_features or max(1, round(math.sqrt(d)))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = materialize(df.where(F.col(label).isNotNull()).select((F.col(label) == 1).cast("double").alias("y"), w.alias("w"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]))
    grown = _Growing(n_trees)
    level = {t: [1] for t in range(n_trees)}
    nodes: dict[tuple[int, int], dict] = {}

    def gather(work, emit, schema, by, *aggs):
        shared = shipped(spark, (grown, work))

        arrow = _arrow(schema)

        def run(batches: Iterator[pa.RecordBatch]):
            g, work = pickle.loads(shared.value)
            for b in batches:
                if b.num_rows:
                    x, y, w = _matrix(b, 2, d), b.column(0).to_numpy(), b.column(1).to_numpy()
                    out = [r for t, own in work.items() for r in emit(g, t, own, x, y, w)]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), arrow)], schema=arrow)

        return rows.mapInArrow(run, schema).groupBy(*by).agg(*aggs).collect()

    def ranges(g, t, open_nodes, x, y, w):
        order, here, first = _by_node(g.node_of(t, x), np.array(sorted(open_nodes)))
        if not len(here):
            return
        xs = x[order]
        low, high = np.fmin.reduceat(xs, first, axis=0), np.fmax.reduceat(xs, first, axis=0)
        n = np.diff(np.append(first, len(order)))
        one, all_ = np.add.reduceat((y * w)[order], first), np.add.reduceat(w[order], first)
        for k, node in enumerate(here.tolist()):
            for f in drawn_features(seed, t, node, d, m):
                yield t, node, f, float(low[k, f]), float(high[k, f]), int(n[k]), float(one[k]), float(all_[k])

    def sides(g, t, cuts, x, y, w):
        order, here, first = _by_node(g.node_of(t, x), np.array(sorted(cuts)))
        ends = np.append(first[1:], len(order))
        for node, a, z in zip(here.tolist(), first.tolist(), ends.tolist()):
            own = order[a:z]
            for f, th in cuts[node]:
                left = x[own, f] <= th
                yield t, node, f, int(left.sum()), float((y * w)[own][left].sum()), float(w[own][left].sum())

    for depth in range(max_depth + 1):
        work = {t: own for t, own in level.items() if own}
        if not work:
            break
        got = gather(work, ranges, _schema("tree int, node long, f int, low double, high double, n long, one double, w double"), ["tree", "node", "f"],
                     F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("w").alias("w"))
        cuts: dict[int, dict[int, list]] = {}
        for r in got:
            nodes[r["tree"], r["node"]] = {"n": r["n"], "one": r["one"], "w": r["w"]}
            open_ = depth < max_depth and r["n"] >= 2 * min_rows and 0 < r["one"] < r["w"]
            if open_ and r["low"] < r["high"]:  # a NaN compares false
                th = r["low"] + _draw(seed, r["tree"], r["node"], r["f"]) * (r["high"] - r["low"])
                cuts.setdefault(r["tree"], {}).setdefault(r["node"], []).append((r["f"], th))
        level = {}
        if not cuts:
            break
        best: dict[tuple[int, int], tuple] = {}
        at = {(t, node, f): th for t, own in cuts.items() for node, v in own.items() for f, th in v}
        for r in gather(cuts, sides, _schema("tree int, node long, f int, n long, one double, w double"), ["tree", "node", "f"],
                        F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("w").alias("w")):
            p = nodes[r["tree"], r["node"]]
            if min(r["n"], p["n"] - r["n"]) < max(1, min_rows):
                continue
            gini = lambda one, w: 2 * one / w * (1 - one / w) if w > 0 else 0.0
            rest = p["w"] - r["w"]
            gain = gini(p["one"], p["w"]) - (r["w"] * gini(r["one"], r["w"]) + rest * gini(p["one"] - r["one"], rest)) / p["w"]
            key = (r["tree"], r["node"])
            found = (gain, -r["f"], at[r["tree"], r["node"], r["f"]])
            if gain > 1e-12 and (key not in best or found > best[key]):
                best[key] = found
        for (t, node), (gain, f, th) in best.items():
            nodes[t, node] |= {"feature": -f, "threshold": th, "gain": gain}
            grown.splits[t][node] = (-f, th)
            level.setdefault(t, []).extend([2 * node, 2 * node + 1])

    table = []
    for (t, node), r in sorted(nodes.items()):
        inner = "feature" in r
        table.append((t, node, 2 * node if inner else -1, 2 * node + 1 if inner else -1, r.get("feature"), r.get("threshold"), None, r["n"],
                      r.get("gain"), None if inner else (r["one"] / r["w"] if r["w"] else 0.0) / n_trees))
    return spark.createDataFrame(table, NODES)


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.DoubleType: pa.float64()}
    return pa.schema([(f.name, kinds[type(f.dataType)]) for f in schema.fields])


def score_trees(nodes: DataFrame, df: DataFrame, cols: Sequence[str], ids: Sequence[str], out: str = "proba") -> DataFrame:
    """ids and the margin of the node table for every row (for ``fit_extra_trees``, P(class 1))."""
    cols, ids = list(cols), list(ids)
    shared = shipped(df.sparkSession, Ensemble(nodes.collect()))
    rows = df.select(*ids, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])
    schema = T.StructType([*rows.schema.fields[:len(ids)], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]):
        e = pickle.loads(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:len(ids)], pa.array(e.margin(_matrix(b, len(ids), len(cols))))], names=schema.names)

    return rows.mapInArrow(run, schema)
