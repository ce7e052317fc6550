"""Node tables of tree ensembles: reading a fitted model's, measuring one on
rows, importances by kind (X1) and path-dependent Shapley values (X4).

A node table has a row per node: tree, node, left, right (-1 at a leaf),
feature (place in the feature list), threshold (left takes values up to it) or
categories (left takes these), n (rows that reached it), gain, value (what a
leaf adds to the margin).  It is bounded by the trees and their depth, so it is
broadcast; rows are explained in Arrow batches."""

from __future__ import annotations

import json
import pickle
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.session import shared_path, shipped

NODES = ("tree int, node int, left int, right int, feature int, threshold double, categories array<double>, "
         "n long, gain double, value double")


def node_table(model, spark: SparkSession) -> DataFrame:
    """The node table of a fitted tree, forest or boosted ensemble, from its
    saved form.  ``value`` is the share of class 1 over the number of trees, or
    a boosted tree's weighted output."""
    path = shared_path(spark, f"nodes_{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    # a classifier of its own is one file of nodes; an ensemble names each node's tree
    data = spark.read.parquet(f"{path}/data")
    node = (data.select(F.col("treeID").alias("tree"), "nodeData.*") if "treeID" in data.columns else data.select(F.lit(0).alias("tree"), "*"))
    boosted = "GBT" in json.loads(spark.read.text(f"{path}/metadata").first().value)["class"]
    if boosted:
        weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
        node = node.join(F.broadcast(weights), "tree")
        value = F.col("weight") * F.col("prediction")
    else:
        total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
        value = F.col("impurityStats")[1] / total / getattr(model, "getNumTrees", 1)
    leaf = F.col("leftChild") < 0
    categorical = F.col("split.numCategories") >= 0
    values = F.col("split.leftCategoriesOrThreshold")
    return node.select("tree", F.col("id").alias("node"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
                       F.when(~leaf, F.col("split.featureIndex")).alias("feature"), F.when(~leaf & ~categorical, values[0]).alias("threshold"),
                       F.when(~leaf & categorical, values).alias("categories"), F.col("rawCount").alias("n"),
                       F.when(~leaf, F.col("gain")).alias("gain"), F.when(leaf, value).alias("value"))


@dataclass
class Leaf:
    """A leaf's path: its features, the share of rows that each lets pass on average, and its conditions."""

    tree: int
    value: float
    features: np.ndarray
    share: np.ndarray
    steps: list[list[tuple[int, bool]]]  # per feature: (split, goes left)


class Ensemble:
    """The leaves and splits of a node table."""

    def __init__(self, rows: Sequence):
        nodes = {(r["tree"], r["node"]): r for r in rows}
        self.splits, self.leaves, self.nodes = [], [], []
        children = {(t, c) for (t, _), r in nodes.items() for c in (r["left"], r["right"])}
        for key in sorted(nodes):
            if key not in children:
                self._walk(nodes, key, [])

    def _walk(self, nodes, key, path):
        stack = [(key, path)]
        while stack:
            key, path = stack.pop()
            r = nodes[key]
            self.nodes.append((key, [(s, left) for s, left, _ in path]))
            if r["left"] < 0:
                by: dict[int, list] = {}
                for s, left, share in path:
                    by.setdefault(self.splits[s][0], []).append((s, left, share))
                self.leaves.append(Leaf(key[0], r["value"] or 0.0, np.array(list(by), np.int64),
                                        np.array([np.prod([x[2] for x in v]) for v in by.values()]),
                                        [[x[:2] for x in v] for v in by.values()]))
                continue
            self.splits.append((r["feature"], r["threshold"], r["categories"]))
            for child, left in (("right", False), ("left", True)):
                below = (key[0], r[child])
                share = (nodes[below]["n"] or 0) / r["n"] if r["n"] else 0.0
                stack.append((below, [*path, (len(self.splits) - 1, left, share)]))

    def goes_left(self, x: np.ndarray) -> np.ndarray:
        """Rows by splits; a missing value goes right."""
        out = np.zeros((len(x), len(self.splits)), bool)
        for j, (f, threshold, categories) in enumerate(self.splits):
            out[:, j] = np.isin(x[:, f], categories) if threshold is None else x[:, f] <= threshold
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        left, out = self.goes_left(x), np.zeros(len(x))
        for leaf in self.leaves:
            out[_passes(left, [s for steps in leaf.steps for s in steps])] += leaf.value
        return out

    def base(self) -> float:
        """The margin when no feature is known."""
        return float(sum(x.value * x.share.prod() for x in self.leaves))

    def shapley(self, x: np.ndarray) -> np.ndarray:
        """Contributions, rows by features: a leaf is a product over the features
        of its path, so its values come from the coefficients of one polynomial
        for each feature left out."""
        left, out = self.goes_left(x), np.zeros(x.shape)
        for leaf in self.leaves:
            m = len(leaf.features)
            if not m or not leaf.value:
                continue
            known = np.stack([_passes(left, s) for s in leaf.steps], axis=1)
            pattern, row = np.unique(known, axis=0, return_inverse=True)
            own = _weights(pattern.astype(float), leaf.share) * (pattern - leaf.share) * leaf.value
            out[:, leaf.features] += own[row.ravel()]
        return out


def _passes(left: np.ndarray, steps: list[tuple[int, bool]]) -> np.ndarray:
    ok = np.ones(len(left), bool)
    for s, is_left in steps:
        ok &= left[:, s] == is_left
    return ok


def _weights(one: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """For each pattern and left-out feature i: the sum over sets S of the others
    of |S|! (m - |S| - 1)! / m! times the product of ``one`` in S and ``zero`` outside."""
    rows, m = one.shape
    scale = np.ones(m)  # |S|! (m - |S| - 1)! / m!
    scale[0] = 1 / m
    for s in range(1, m):
        scale[s] = scale[s - 1] * s / (m - s)
    out = np.zeros((rows, m))
    for i in range(m):
        by_size = np.zeros((rows, m))
        by_size[:, 0] = 1
        for j in range(m):
            if j != i:
                grown = by_size * zero[j]
                grown[:, 1:] += by_size[:, :-1] * one[:, j:j + 1]
                by_size = grown
        out[:, i] = by_size @ scale
    return out


def _matrix(b: pa.RecordBatch, first: int, n: int) -> np.ndarray:
    return np.stack([np.asarray(b.column(first + j).to_pandas(), np.float64) for j in range(n)], axis=1) if b.num_rows else np.zeros((0, n))


def tree_contributions(nodes: DataFrame, df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """Long form (id, feature, contribution) of path-dependent Shapley values:
    with ``base_value`` they add up to the margin of every row."""
    cols = list(cols)
    shared = shipped(df.sparkSession, Ensemble(nodes.collect()))
    rows = df.select(id_col, *[F.col(c).cast("double") for c in cols])
    schema = T.StructType([rows.schema[0], T.StructField("phi", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]):
        e = pickle.loads(shared.value)
        for b in batches:
            phi = e.shapley(_matrix(b, 1, len(cols)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(phi) + 1) * len(cols), pa.int32()), pa.array(phi.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], schema.names)

    names = F.array(*[F.lit(c) for c in cols])
    return (rows.mapInArrow(run, schema).select(id_col, F.explode(F.arrays_zip(names.alias("feature"), F.col("phi").alias("contribution"))).alias("x"))
            .select(id_col, "x.feature", "x.contribution"))


def base_value(nodes: DataFrame) -> float:
    return Ensemble(nodes.collect()).base()


def measured(nodes: DataFrame, df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """The node table with n, gain (of the Gini impurity) and value (share of
    label 1 over the number of trees) as ``df`` gives them; 0 where no row comes."""
    cols = list(cols)
    shared = shipped(df.sparkSession, Ensemble(nodes.collect()))

    def run(batches: Iterator[pa.RecordBatch]):
        e = pickle.loads(shared.value)
        for b in batches:
            left, y = e.goes_left(_matrix(b, 1, len(cols))), b.column(0).to_numpy(zero_copy_only=False)
            got = [_passes(left, steps) for _, steps in e.nodes]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k, _ in e.nodes], pa.int32()) for i in (0, 1)]
                + [pa.array([int(g.sum()) for g in got], pa.int64()), pa.array([int((y[g] == 1).sum()) for g in got], pa.int64())],
                ["tree", "node", "n", "pos"])

    counts = (df.select(F.col(label).cast("double"), *[F.col(c).cast("double") for c in cols])
              .mapInArrow(run, "tree int, node int, n long, pos long").groupBy("tree", "node").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")))
    own = nodes.drop("n", "gain", "value").join(counts, ["tree", "node"], "left").fillna(0, ["n", "pos"])
    own = own.withColumn("trees", F.lit(nodes.select("tree").distinct().count()))
    share = F.when(F.col("n") > 0, F.col("pos") / F.col("n")).otherwise(0.0)
    gini = 2 * share * (1 - share)
    own = own.withColumn("gini", gini)
    child = own.select("tree", F.col("node").alias("c"), F.col("n").alias("cn"), F.col("gini").alias("cg"))
    for side in ("left", "right"):
        own = own.join(child.select("tree", F.col("c").alias(side), F.col("cn").alias(f"n_{side}"), F.col("cg").alias(f"g_{side}")), ["tree", side], "left")
    below = (F.col("n_left") * F.col("g_left") + F.col("n_right") * F.col("g_right")) / F.col("n")
    return own.select("tree", "node", "left", "right", "feature", "threshold", "categories", "n",
                      F.when(F.col("left") >= 0, F.when(F.col("n") > 0, F.col("gini") - below).otherwise(0.0)).alias("gain"),
                      F.when(F.col("left") < 0, share / F.col("trees")).alias("value"))


def importances_by_kind(nodes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(kind, feature, importance, rank) for the kinds weight (number of splits),
    cover (mean rows of a feature's splits) and gain (their mean gain), each
    normalised to sum 1; features without a split have 0."""
    spark = nodes.sparkSession
    names = spark.createDataFrame(list(enumerate(cols)), "feature int, name string")
    split = nodes.where("left >= 0").groupBy("feature").agg(
        F.count("*").cast("double").alias("weight"), F.avg("n").alias("cover"), F.avg("gain").alias("gain"))
    long = F.broadcast(names).join(split, "feature", "left").fillna(0.0).unpivot(["name"], ["weight", "cover", "gain"], "kind", "v")
    total = long.groupBy("kind").agg(F.sum("v").alias("total"))
    out = long.join(total, "kind").select("kind", F.col("name").alias("feature"),
                                          F.when(F.col("total") != 0, F.col("v") / F.col("total")).otherwise(0.0).alias("importance"))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("importance"), "feature")))
