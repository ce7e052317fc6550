"""Nearest donors over several features, some missing (F4): a partition tree
for each pattern of present features and each set of them that a probe has too
(a view), true boxes around its leaves, and a search in two rounds.

Donors with equal features are one class, of which the k smallest ids can
matter; rows to fill that are alike are searched once.  So no vector that many
rows share becomes a hot leaf, and leaves hold about ``LEAF_ROWS`` donors.
Round one takes a row to the nearest leaves that hold k donors together; the
k-th distance found there bounds the true one.  Round two meets the donors of
all leaves whose box is not farther than that, which is exact.

A leaf's donors travel as one row and the probes that meet it in rows of many
probes each, so pairs are compared inside the tasks: a leaf gives back at most k
donors for a probe, none beyond the bound.  Probes go in the order of their
nearest leaves, so that a row holds many.  A probe with few features meets trees
over just these, not all leaves along the other ones.  A table with more than
``MAX_VIEWS`` patterns of probes has one tree for each pattern of donors, as
views would multiply the donors.

Trees are cut from a bounded sample; any cut is right, because the boxes are
aggregated from all donors.  Leaves, and with them what is broadcast, are
bounded by ``MAX_LEAVES``."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.session import materialize, shipped

LEAF_ROWS = 256
MAX_LEAVES = 1 << 15
SAMPLE_ROWS = 200_000
MAX_VIEWS = 16
MEETS = 1 << 18       # (probe, leaf) in the rows that a task writes at a time
PAIRS = 1 << 18       # distances taken at a time


def _patterns(x: np.ndarray) -> np.ndarray:
    return (~np.isnan(x)) @ (1 << np.arange(x.shape[1], dtype=np.int64))


class Forest:
    """A tree for each pattern of present features, or for each view of it.

    ``dim`` is -1 at a leaf; boxes and counts are of the donors below a node."""

    def __init__(self, d: int, views: bool = False):
        self.d, self.views = d, views
        self.dim, self.cut, self.left, self.right = [], [], [], []
        self.roots: dict[tuple[int, int], int] = {}  # by pattern and features in use

    def _node(self) -> int:
        for a, v in ((self.dim, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1)):
            a.append(v)
        return len(self.dim) - 1

    def grow(self, pattern: int, rows: np.ndarray, leaves: int, over: int | None = None):
        """Split the widest feature (of ``over``) at its median until there are ``leaves`` leaves."""
        over = pattern if over is None else over
        own = [i for i in range(self.d) if over >> i & 1]
        root = self.roots[pattern, over] = self._node()
        todo = [(root, rows, leaves)]
        while todo:
            node, rows, leaves = todo.pop()
            if leaves < 2 or len(rows) < 2 or not own:
                continue
            spread = rows[:, own].max(axis=0) - rows[:, own].min(axis=0)
            f = own[int(np.argmax(spread))]
            values = np.sort(rows[:, f])
            cut = values[(len(values) - 1) // 2]
            if cut >= values[-1]:  # the upper half is one value
                below = values[values < cut]
                if not len(below):
                    continue
                cut = below[-1]
            low = rows[:, f] <= cut
            self.dim[node], self.cut[node] = f, float(cut)
            self.left[node], self.right[node] = self._node(), self._node()
            todo += [(self.left[node], rows[low], leaves // 2), (self.right[node], rows[~low], leaves - leaves // 2)]

    def close(self, boxes: dict[int, tuple[np.ndarray, np.ndarray, int]]):
        """Take the boxes of the leaves (node -> low, high, donors) up to the roots."""
        n = len(self.dim)
        self.low, self.high, self.count = np.full((n, self.d), np.nan), np.full((n, self.d), np.nan), np.zeros(n, np.int64)
        for node in range(n - 1, -1, -1):  # children come after their parent
            if self.dim[node] < 0:
                if node in boxes:
                    self.low[node], self.high[node], self.count[node] = boxes[node]
            else:
                a, b = self.left[node], self.right[node]
                self.low[node], self.high[node] = np.fmin(self.low[a], self.low[b]), np.fmax(self.high[a], self.high[b])
                self.count[node] = self.count[a] + self.count[b]
        self.dim, self.cut, self.left, self.right = (np.array(x) for x in (self.dim, self.cut, self.left, self.right))

    def leaf_of(self, x: np.ndarray, pattern: np.ndarray | None = None) -> np.ndarray:
        """The leaf of donors; ``pattern`` is that before the view, of which ``x`` has the features."""
        dim, cut, left, right = (np.array(v) for v in (self.dim, self.cut, self.left, self.right))
        over = _patterns(x)
        pattern = over if pattern is None else pattern
        at = np.array([self.roots[p] for p in zip(pattern.tolist(), over.tolist())], np.int64)
        while True:
            inner = np.flatnonzero(dim[at] >= 0)
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = np.where(x[inner, dim[node]] <= cut[node], left[node], right[node])

    def far(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Least distance of each row to a donor below its node; infinite if no feature is in common."""
        off = np.fmax(np.fmax(self.low[node] - x, x - self.high[node]), 0.0)
        known = ~(np.isnan(x) | np.isnan(self.low[node]))
        n = known.sum(axis=1)
        return np.where(n > 0, np.sqrt((np.where(known, off, 0.0) ** 2).sum(axis=1) * self.d / np.maximum(n, 1)), np.inf)

    def _roots(self, x: np.ndarray) -> np.ndarray:
        """Distance of each row to each root, infinite if that isn't its view."""
        out = np.stack([self.far(x, np.full(len(x), r)) for r in self.roots.values()], axis=1)
        if self.views:
            pattern, over = np.array(list(self.roots)).T
            out[(_patterns(x)[:, None] & pattern) != over] = np.inf
        return out

    def _leaves(self, row: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._within(row, node, None, None)

    def _within(self, row, node, x, bound) -> tuple[np.ndarray, np.ndarray]:
        """The leaves below the nodes (not farther than the row's bound)."""
        rows, leaves = [], []
        while len(row):
            keep = self.count[node] > 0
            if bound is not None:
                keep &= self.far(x[row], node) <= bound[row]
            row, node = row[keep], node[keep]
            leaf = self.dim[node] < 0
            rows.append(row[leaf])
            leaves.append(node[leaf])
            row, node = row[~leaf], node[~leaf]
            row, node = np.concatenate((row, row)), np.concatenate((self.left[node], self.right[node]))
        return (np.concatenate(rows), np.concatenate(leaves)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def nearest(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of leaves near each row that hold at least k donors together, or of all that have a feature in common."""
        roots = np.array(list(self.roots.values()))
        to_root = self._roots(x)
        enough = np.where(self.count[roots] >= k, to_root, np.inf)
        at = roots[enough.argmin(axis=1)]
        few = np.isinf(enough.min(axis=1))
        moving = np.flatnonzero(~few)
        while len(moving):
            moving = moving[self.dim[at[moving]] >= 0]
            a, b = self.left[at[moving]], self.right[at[moving]]
            near_a = np.where(self.count[a] >= k, self.far(x[moving], a), np.inf)
            near_b = np.where(self.count[b] >= k, self.far(x[moving], b), np.inf)
            on = ~(np.isinf(near_a) & np.isinf(near_b))
            at[moving] = np.where(on, np.where(near_a <= near_b, a, b), at[moving])
            moving = moving[on]
        row, leaf = self._leaves(np.flatnonzero(~few), at[~few])
        r, j = np.nonzero(~np.isinf(to_root) & few[:, None])
        more, leaves = self._leaves(r, roots[j])
        return np.concatenate((row, more)), np.concatenate((leaf, leaves))

    def around(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves not farther than each row's bound."""
        roots = np.array(list(self.roots.values()))
        row, j = np.nonzero(~np.isinf(self._roots(x)))
        return self._within(row, roots[j], x, bound * (1 + 1e-9))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def leaf_search(x: np.ndarray, w: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probe, donor, distance): for each of the probes ``x`` the k nearest of a
    leaf's donors ``w``, ties by their order, not farther than its bound."""
    d = x.shape[1]
    found = []
    step = max(1, PAIRS // max(1, len(w)))
    for i in range(0, len(x), step):
        part = x[i:i + step]
        total, both = np.zeros((len(part), len(w))), np.zeros((len(part), len(w)), np.int64)
        for f in range(d):
            known = ~(np.isnan(part[:, f, None]) | np.isnan(w[None, :, f]))
            off = np.where(known, part[:, f, None] - w[None, :, f], 0.0)
            total += off * off
            both += known
        dist = np.sqrt(total * (d / np.maximum(both, 1)))
        key = np.where((both > 0) & ~np.isnan(dist), dist, np.inf)
        most = bound[i:i + step]
        if len(w) > k:
            most = np.minimum(most, np.partition(key, k - 1, axis=1)[:, k - 1])
        r, j = np.nonzero((key <= most[:, None]) & (both > 0))
        order = np.lexsort((j, key[r, j], r))
        r, j = r[order], j[order]
        first = np.searchsorted(r, np.arange(len(part)))
        keep = np.arange(len(r)) - first[r] < k
        r, j = r[keep], j[keep]
        found.append((r + i, j, dist[r, j]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _views(donors: DataFrame, probes: DataFrame, d: int, k: int) -> tuple[DataFrame, bool]:
    """Donors (did, dv, v, p: pattern), by ``v`` and pattern the k smallest ids: each
    once for every set of its features that probes have too, if these are few."""
    spark = probes.sparkSession
    bits = sum((F.when(F.col("v")[i].isNotNull(), 1 << i).otherwise(0) for i in range(d)), F.lit(0)).cast("long")
    few = lambda df: (df.withColumn("_n", F.row_number().over(Window.partitionBy("p", "v").orderBy("did")))
                      .where(F.col("_n") <= k).drop("_n"))
    donors = materialize(few(donors.where(F.exists("v", lambda x: x.isNotNull())).withColumn("p", bits)))
    asked = [r["p"] for r in probes.select(bits.alias("p")).distinct().limit(MAX_VIEWS + 1).collect()]
    if len(asked) > MAX_VIEWS:
        return donors, False
    have = [r["p"] for r in donors.select("p").distinct().collect()]  # at most 2^d rows
    sets = sorted({(p, p & q) for p in have for q in asked if p & q})
    views = spark.createDataFrame(sets, "p long, s long")
    own = F.array(*[F.when(F.col("s").bitwiseAND(1 << i) > 0, F.col("v")[i]) for i in range(d)])
    return materialize(few(donors.join(F.broadcast(views), "p").withColumn("v", own).drop("s"))), True


def nearest_donors(probes: DataFrame, donors: DataFrame, d: int, k: int) -> DataFrame:
    """(pid, did, dv, dist, rank): the k nearest ``donors`` (did, dv, v) of each of
    ``probes`` (pid, v) with a feature in common; ties by did.  ``v`` has ``d``
    numbers or nulls; the distance is taken over the features that both have,
    scaled up to all ``d``."""
    spark = probes.sparkSession
    probes = probes.select("pid", "v")
    did, dv = donors.schema["did"].dataType, donors.schema["dv"].dataType
    top_schema = T.StructType([probes.schema["pid"], T.StructField("did", did), T.StructField("dv", dv), T.StructField("dist", T.DoubleType())])
    order = Window.partitionBy("pid").orderBy("dist", "did")
    best = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    donors, views = _views(donors.select("did", "dv", "v"), probes, d, k)
    bits = sum((F.when(F.col("v")[i].isNotNull(), 1 << i).otherwise(0) for i in range(d)), F.lit(0)).cast("long")
    counts = {(r["p"], r["s"]): r["n"] for r in donors.groupBy("p", bits.alias("s")).agg(F.count("*").alias("n")).collect()}  # at most 2^d, with views 2^d * MAX_VIEWS rows
    total = sum(counts.values())
    if not total:
        return best(spark.createDataFrame([], top_schema))
    forest = Forest(d, views)
    leaf_rows = max(LEAF_ROWS, -(-total // MAX_LEAVES))
    got = donors.orderBy(F.xxhash64("v"), "did").select("p", "v").limit(min(SAMPLE_ROWS, 64 * (total // leaf_rows + 1))).toArrow().combine_chunks()
    sample, kind = _matrix(got["v"].combine_chunks(), d), got["p"].to_numpy()
    over = _patterns(sample)
    for (p, s), n in sorted(counts.items()):
        forest.grow(p, sample[(kind == p) & (over == s)], -(-n // leaf_rows), s)
    cut = shipped(spark, forest)
    placed_schema = T.StructType([T.StructField("leaf", T.LongType()), *donors.schema.fields])

    def place(batches: Iterator[pa.RecordBatch]):
        at, f = [placed_schema.names.index(c) - 1 for c in ("v", "p")], pickle.loads(cut.value)
        for b in batches:
            leaf = f.leaf_of(_matrix(b.column(at[0]), d), b.column(at[1]).to_numpy()) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *b.columns], placed_schema.names)

    placed = materialize(donors.mapInArrow(place, placed_schema))
    own = placed.groupBy("leaf").agg(F.count("*").alias("n"), *[f(F.col("v")[i]).alias(f"{name}{i}") for i in range(d) for name, f in (("a", F.min), ("z", F.max))])
    number = lambda x: np.nan if x is None else x
    forest.close({r["leaf"]: (np.array([number(r[f"a{i}"]) for i in range(d)]), np.array([number(r[f"z{i}"]) for i in range(d)]), r["n"])
                  for r in own.collect()})  # a row a leaf
    tree = shipped(spark, forest)
    # a row a leaf, its donors in the order of their ids
    leaves = materialize(placed.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("did", "dv", "v"))).alias("donors")))

    homed_schema = T.StructType([*probes.schema.fields, T.StructField("home", T.LongType())])

    def home(batches: Iterator[pa.RecordBatch]):
        f = pickle.loads(tree.value)
        for b in batches:
            at = np.full(b.num_rows, -1, np.int64)
            for i in range(0, b.num_rows, 1024):
                row, leaf = f.nearest(_matrix(b.column(1).slice(i, 1024), d), k)
                at[row + i] = leaf
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], homed_schema.names)

    homed = probes.mapInArrow(home, homed_schema)
    homed = materialize(homed.repartitionByRange("home").sortWithinPartitions("home"))  # neighbours meet the same leaves
    met_schema = T.StructType([T.StructField("leaf", T.LongType()), T.StructField("pid", T.ArrayType(probes.schema["pid"].dataType)),
                               T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("bound", T.ArrayType(T.DoubleType()))])

    def packed(b, x, bound, row, leaf):
        """A row for each leaf, with all the probes that meet it."""
        order = np.argsort(leaf, kind="stable")
        row, leaf = row[order], leaf[order]
        first = np.flatnonzero(np.diff(leaf, prepend=-1))
        ends = np.append(first, len(leaf))
        lists = lambda values, n=1: pa.ListArray.from_arrays(pa.array(ends * n, pa.int32()), values)
        return pa.RecordBatch.from_arrays([pa.array(leaf[first]), lists(b.column(0).take(pa.array(row))), lists(pa.array(x[row].reshape(-1)), d),
                                           lists(pa.array(bound[row]))], met_schema.names)

    def meet(rows, bounded):
        def run(batches: Iterator[pa.RecordBatch]):
            f = pickle.loads(tree.value)
            for b in batches:
                x = _matrix(b.column(1), d)
                bound = b.column(2).to_numpy() if bounded else np.full(len(x), np.inf)
                met, size = [], 0
                for i in range(0, len(x), 1024):  # frontiers stay small
                    row, leaf = f.around(x[i:i + 1024], bound[i:i + 1024]) if bounded else f.nearest(x[i:i + 1024], k)
                    met.append((row + i, leaf))
                    size += len(row)
                    if size >= MEETS or i + 1024 >= len(x):
                        yield packed(b, x, bound, *(np.concatenate(c) for c in zip(*met)))
                        met, size = [], 0

        return rows.mapInArrow(run, met_schema)

    def search(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            pids, vs, bounds, donors = (b.column(c) for c in ("pid", "v", "bound", "donors"))
            for i in range(b.num_rows):
                own = donors[i].values
                w, x = _matrix(own.field("v"), d), pc.list_flatten(vs.slice(i, 1)).to_numpy(zero_copy_only=False).reshape(-1, d)
                r, j, dist = leaf_search(x, w, bounds[i].values.to_numpy(zero_copy_only=False), k)
                j = pa.array(j)
                yield pa.RecordBatch.from_arrays([pids[i].values.take(pa.array(r)), own.field("did").take(j), own.field("dv").take(j), pa.array(dist)], top_schema.names)

    def near(met):
        return met.join(leaves, "leaf").select("pid", "v", "bound", "donors").mapInArrow(search, top_schema)

    first = near(meet(homed.select("pid", "v"), False))
    bound = first.groupBy("pid").agg(F.get(F.sort_array(F.collect_list("dist")), F.lit(k - 1)).alias("bound"))
    second = homed.join(bound, "pid", "left").select("pid", "v", F.coalesce("bound", F.lit(float("inf"))).alias("bound"), "home")
    second = materialize(second.repartitionByRange("home").sortWithinPartitions("home").drop("home"))
    return best(near(meet(second, True)))


def _fills(df: DataFrame, target: str, features: Sequence[str], id_col: str, k: int, exact) -> DataFrame:
    """(v, fill) for the rows without a target; ``exact`` aggregates the values of donors at distance 0."""
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    rows = df.select(F.col(id_col).alias("did"), number(target).alias("dv"), F.array(*[number(c) for c in features]).alias("v"))
    probes = materialize(rows.where("dv is null").select("v").distinct().withColumn("pid", F.monotonically_increasing_id()))
    top = nearest_donors(probes, rows.where("dv is not null"), len(features), k)
    weight = 1.0 / F.greatest(F.col("dist"), F.lit(1e-12))
    zero = F.col("dist") == 0
    fill = top.groupBy("pid").agg(F.coalesce(exact(F.when(zero, F.col("dv"))), F.sum(weight * F.col("dv")) / F.sum(weight)).alias("fill"))
    mean = rows.agg(F.avg("dv").alias("mean"))
    return (probes.join(fill, "pid", "left").crossJoin(F.broadcast(mean))
            .select(F.col("v").alias("_v"), F.coalesce("fill", "mean").alias("_fill")))


def fill_from_neighbours(df: DataFrame, id_col: str, target: str, features: Sequence[str], k: int) -> DataFrame:
    """One column filled from the features; see ``prep.impute_knn``."""
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    key = "__key " + target
    fills = _fills(df, target, features, id_col, k, F.max).withColumnRenamed("_v", key).withColumnRenamed("_fill", "__fill " + target)
    marked = df.withColumn(key, F.when(number(target).isNull(), F.array(*[number(c) for c in features])))
    out = marked.join(fills, key, "left")
    return out.select(*[F.coalesce(number(c), F.col("__fill " + target)).alias(c) if c == target else F.col(c) for c in df.columns])


def impute_knn_columns(df: DataFrame, id_col: str, cols: Sequence[str], k: int = 5) -> DataFrame:
    """Every missing number of ``cols`` filled from the k nearest rows that have
    it, weighted by inverse distance (donors at distance 0 count alone, their
    mean).  Distances use the other columns that both rows have, and the values
    before filling.  A row with nothing in common with any donor takes the
    column's mean; a column without a value stays null."""
    cols = list(cols)
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    out = df
    keys = {c: F.array(*[number(o) for o in cols if o != c]) for c in cols}
    gone = {c: number(c).isNull() for c in cols}
    marked = out.select("*", *[F.when(gone[c], keys[c]).alias(f"__key {c}") for c in cols])
    for c in cols:
        fills = _fills(df, c, [o for o in cols if o != c], id_col, k, F.avg).withColumnRenamed("_fill", f"__fill {c}")
        marked = marked.join(fills.withColumnRenamed("_v", f"__key {c}"), f"__key {c}", "left")
    return marked.select(*[F.coalesce(number(c), F.col(f"__fill {c}")).alias(c) if c in cols else F.col(c) for c in df.columns])
