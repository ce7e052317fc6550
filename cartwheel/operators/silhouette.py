"""Exact silhouette with Euclidean distances (M14): sums of distances to every
cluster, a broadcast block of query rows at a time against all rows.

The work is that of all pairs, which an exact answer needs; ``every`` restricts
the query rows (the share 1 / every of them, by a hash of the id) where that is
too much, and what is averaged is then exact for those rows.  Distances come
from matrix products.  No pair becomes a
row: a task adds up a matrix of query rows by clusters and emits it once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.session import materialize

BLOCK_BYTES = 8 << 20  # of query rows in one broadcast
CELLS = 1 << 21        # distances computed at a time
PAIRS = 1 << 14        # near pairs taken by difference at a time
NEAR = 1e-4            # of the squared lengths: nearer pairs are


def _matrix(column: pa.Array) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By a product of the rows less a common centre; near pairs, where that
    loses digits, by difference, so that equal rows are at distance 0."""
    with np.errstate(invalid="ignore", over="ignore"):
        centre = a.mean(axis=0)
        x, y = a - centre, b - centre
        size = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :]
        out = size - 2 * (x @ y.T)
        i, j = np.nonzero(~(out > NEAR * size))
        for lo in range(0, len(i), PAIRS):
            off = a[i[lo:lo + PAIRS]] - b[j[lo:lo + PAIRS]]
            out[i[lo:lo + PAIRS], j[lo:lo + PAIRS]] = (off * off).sum(axis=1)
    return np.sqrt(out)


def silhouette_rows(df: DataFrame, id_col: str = "id", vec: str = "features", cluster: str = "cluster", every: int = 1) -> DataFrame:
    """(id, cluster, silhouette): (b - a) / max(a, b) of each row, where a is the
    mean distance to the others of its cluster and b the least mean distance to
    another cluster; 0 in a cluster of one.  Noise (-1), null clusters and null
    vectors are left out; with fewer than two clusters there are no rows."""
    spark = df.sparkSession
    rows = materialize(df.where(F.col(cluster).isNotNull() & (F.col(cluster) >= 0) & (F.size(F.col(vec)) > 0)).select(
        F.col(id_col).alias("id"), F.col(cluster).cast("long").alias("cluster"), F.col(vec).cast("array<double>").alias("v"))
        .repartition(spark.sparkContext.defaultParallelism))  # the work is in the pairs, not in the bytes
    sizes = {r["cluster"]: r["n"] for r in rows.groupBy("cluster").agg(F.count("*").alias("n")).orderBy("cluster").collect()}  # a row a cluster
    schema = f"id {rows.schema['id'].dataType.simpleString()}, cluster long, silhouette double"
    if len(sizes) < 2:
        return spark.createDataFrame([], schema)
    names = np.array(list(sizes))
    queries = rows.withColumn("q", F.monotonically_increasing_id()).where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0) if every > 1 else (
        rows.withColumn("q", F.monotonically_increasing_id()))
    queries = materialize(queries)
    n = -(-(queries.agg(F.sum(8 * F.size("v") + 64)).first()[0] or 0) // BLOCK_BYTES)
    parts = []
    for i in range(n):
        block = queries.where(F.pmod(F.xxhash64("q"), F.lit(n)) == i).select("q", "v").toArrow()
        if not block.num_rows:
            continue
        shared = spark.sparkContext.broadcast((block["q"].to_numpy(), _matrix(pa.concat_arrays(block["v"].chunks))))

        def add(batches: Iterator[pa.RecordBatch], shared=shared):
            q, x = shared.value
            total, step = np.zeros((len(q), len(names))), max(1, CELLS // len(q))
            for b in batches:
                if b.num_rows:
                    at, y = np.searchsorted(names, b.column(0).to_numpy()), _matrix(b.column(1))
                    order = np.argsort(at, kind="stable")
                    for lo in range(0, len(order), step):
                        own = order[lo:lo + step]
                        here, first = np.unique(at[own], return_index=True)
                        total[:, here] += np.add.reduceat(_distances(x, y[own]), first, axis=1)
            sums = pa.ListArray.from_arrays(pa.array(np.arange(len(q) + 1) * len(names), pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(q), sums], ["q", "s"])

        parts.append(rows.select("cluster", "v").mapInArrow(add, "q long, s array<double>"))
    if not parts:
        return spark.createDataFrame([], schema)
    sums = parts[0]
    for p in parts[1:]:
        sums = sums.unionByName(p)
    sums = sums.groupBy("q").agg(*[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(len(names))])
    own = F.col("cluster")
    a = sum((F.when(own == int(c), F.col(f"s{j}") / max(1, sizes[c] - 1)) .otherwise(0.0) for j, c in enumerate(names.tolist())), F.lit(0.0))
    b = F.array_min(F.array(*[F.when(own != int(c), F.col(f"s{j}") / sizes[c]) for j, c in enumerate(names.tolist())]))
    alone = own.isin([int(c) for c, k in sizes.items() if k == 1])
    out = queries.select("q", "id", "cluster").join(sums, "q").withColumn("_a", a).withColumn("_b", b)
    top = F.greatest("_a", "_b")
    return out.select("id", "cluster", F.when(alone | (top == 0), 0.0).otherwise((F.col("_b") - F.col("_a")) / top).alias("silhouette"))


def silhouette_exact(df: DataFrame, id_col: str = "id", vec: str = "features", cluster: str = "cluster", every: int = 1) -> DataFrame:
    """(cluster, n, silhouette): the mean of every cluster, and of all rows under the null cluster."""
    s = silhouette_rows(df, id_col, vec, cluster, every)
    mean = [F.count("*").alias("n"), F.avg("silhouette").alias("silhouette")]
    return s.groupBy("cluster").agg(*mean).unionByName(s.groupBy().agg(*mean).where("n > 0").select(F.lit(None).cast("long").alias("cluster"), "n", "silhouette"))
