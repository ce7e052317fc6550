"""Cosine top-k behind a prefilter: random-hyperplane signatures in several
tables, probed in more than one bucket, matched on the bucket keys, and verified
by the exact cosine (V2).

A table's bucket is the signs of ``bits`` projections.  A query looks into its
own bucket and into those that differ in its least certain signs.  The buckets
of the documents are matched in their own tasks (``dense``), so that neither
vectors nor pairs are shuffled, however little the buckets prune.  ``fit`` chooses
the number of bits on a bounded sample: the most for which the wanted recall is
reached there.  (Neighbours in a sample are farther than among all rows, so the
sample's recall is the harder one.)  Queries that meet fewer than k rows are
answered by the exact search."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.dense import nearest, whole
from cartwheel.operators.retrieval import _union, cosine_topk
from cartwheel.session import materialize

SAMPLE_ROWS, SAMPLE_QUERIES = 10_000, 200  # bounds of the sample for ``fit``
TABLES = 32
PROBES = 6


@dataclass
class Planes:
    """Normals of the hyperplanes, a column each: ``bits`` for each of ``tables``."""

    normals: np.ndarray
    tables: int
    bits: int
    probes: int

    def signs(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        side = (vectors @ self.normals).reshape(len(vectors), self.tables, self.bits)
        code = ((side > 0) @ (1 << np.arange(self.bits, dtype=np.int64))) | (np.arange(self.tables, dtype=np.int64) << self.bits)
        return code, np.abs(side)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """One bucket key a table for each vector."""
        return self.signs(vectors)[0]

    def probe_keys(self, vectors: np.ndarray) -> np.ndarray:
        """The own bucket, those with one of the ``probes`` least certain signs
        changed, and those with the least certain one and another changed."""
        code, size = self.signs(vectors)
        flip = 1 << np.argsort(size, axis=2, kind="stable")[:, :, :self.probes].astype(np.int64)
        near = [code[:, :, None], code[:, :, None] ^ flip, code[:, :, None] ^ flip[:, :, :1] ^ flip[:, :, 1:3]]
        return np.concatenate(near, axis=2).reshape(len(vectors), -1)


def planes(dim: int, bits: int, tables: int = TABLES, probes: int = PROBES, seed: int = 7) -> Planes:
    return Planes(np.random.default_rng(seed).standard_normal((dim, tables * bits)), tables, bits, min(probes, bits))


def _matrix(column: pa.Array) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def fit(queries: DataFrame, docs: DataFrame, k: int, recall: float = 0.95, vec: str = "embedding", tables: int = TABLES,
        probes: int = PROBES, seed: int = 7) -> tuple[Planes | None, float]:
    """Planes with the most bits that reach ``recall`` on a sample, and that
    recall; (None, 1.0) if no number of bits does.  The samples, at most
    ``SAMPLE_ROWS`` rows and ``SAMPLE_QUERIES`` queries, are those with the
    smallest hashes of their vectors."""
    def sample(df, n):
        rows = df.select(F.col(vec).cast("array<double>").alias("v")).where(F.size("v") > 0)
        got = rows.distinct().orderBy(F.xxhash64("v"), "v").limit(n).toArrow()["v"]
        return _matrix(pa.concat_arrays(got.chunks)) if len(got) else np.zeros((0, 0))

    d, q = sample(docs, SAMPLE_ROWS), sample(queries, SAMPLE_QUERIES)
    if not len(d) or not len(q):
        return None, 1.0
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    k = min(k, len(d))
    sims = unit(q) @ unit(d).T
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    for bits in range(max(1, int(np.log2(len(d)))) + 8, 3, -1):
        p = planes(d.shape[1], bits, tables, probes, seed)
        own, near = p.keys(d), p.probe_keys(q).reshape(len(q), tables, -1)
        met = (own[best][:, :, :, None] == near[:, None, :, :]).any(axis=(2, 3))
        if met.mean() >= recall:
            return p, float(met.mean())
    return None, 1.0


def lsh_topk(queries: DataFrame, docs: DataFrame, k: int, q_id: str = "query_id", d_id: str = "doc_id", vec: str = "embedding",
             recall: float = 0.95, tables: int = TABLES, probes: int = PROBES, seed: int = 7) -> DataFrame:
    """(query_id, doc_id, similarity, rank) as ``cosine_topk`` gives, found among
    the rows that share a bucket with the query.  Null and empty vectors are
    left to the exact search."""
    q = materialize(queries.select(F.col(q_id).alias("query_id"), F.col(vec).cast("array<double>").alias("v")))
    d = docs.select(F.col(d_id).alias("doc_id"), F.col(vec).cast("array<double>").alias("v"))
    p, _ = fit(q, d, k, recall, "v", tables, probes, seed)
    if p is None:
        return cosine_topk(q, d, k, vec="v")
    dim = len(p.normals)
    parts = nearest(q.where(whole("v", dim)), d.where(whole("v", dim)), k, dim, p)
    if not parts:
        return cosine_topk(q, d, k, vec="v")
    rank = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "doc_id")
    top = _union(parts).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    top = materialize(top)
    full = top.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k).select("query_id")
    rest = q.join(full, "query_id", "left_anti")
    return top.join(full, "query_id", "left_semi").unionByName(cosine_topk(rest, d, k, vec="v"))


def recall_at_k(found: DataFrame, exact: DataFrame) -> DataFrame:
    """n_queries, n_exact (pairs of the exact answer) and the share of them in ``found``."""
    pair = ["query_id", "doc_id"]
    both = exact.select(*pair).join(found.select(*pair, F.lit(1).alias("hit")), pair, "left")
    return both.agg(F.count_distinct("query_id").alias("n_queries"), F.count("*").alias("n_exact"),
                    (F.count("hit") / F.count("*")).alias("recall"))
