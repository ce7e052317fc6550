"""Top-k search with sparse term vectors: an inverted list of the queries, a
block of documents at a time, and the k best of every block.

The queries' postings are broadcast in batches of measured bytes.  A task
scores a block of documents against the inverted list at once and emits at most
k rows a query and block, so no row is made for a (query, document) pair that
only shares a common term."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_BYTES = 64 << 20   # of query terms in one broadcast
BLOCK_CELLS = 1 << 22    # scores of one block: documents times queries
BLOCK_TERMS = 1 << 22    # term matches expanded at a time


def _weights(row: np.ndarray, term: np.ndarray, idf: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) with their weights: 1, or tf-idf in rows of length one."""
    key, tf = np.unique(row.astype(np.int64) << 32 | term, return_counts=True)
    row, term = key >> 32, key & 0xFFFFFFFF
    if idf is None:
        return row, term, np.ones(len(key))
    w = tf * idf[term]
    norm = np.sqrt(np.bincount(row, w * w))
    return row, term, w / norm[row]


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores above zero in each column; ties go to the first rows."""
    if len(scores) > k:
        least = -np.partition(-scores, k - 1, axis=0)[k - 1]
        above, at = scores > least, scores == least
        keep = above | (at & (np.cumsum(at, axis=0) <= k - above.sum(axis=0)))
    else:
        keep = np.ones(scores.shape, bool)
    return np.nonzero(keep & (scores > 0))


class InvertedList:
    """Query terms: for each known term, the queries that have it and their weights."""

    def __init__(self, ids: pa.Array, lists: pa.Array, idf: np.ndarray | None = None):
        self.ids, self.idf = ids, idf
        flat = pc.list_flatten(lists)
        self.terms = flat.unique()
        row = pc.list_parent_indices(lists).to_numpy()
        if idf is None:  # terms of any type, numbered by their place among the queries' terms
            term = pc.index_in(flat, self.terms).to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            term = flat.to_numpy().astype(np.int64)
        row, term, self.weight = _weights(row, term, idf)
        order = np.argsort(term, kind="stable")
        self.query, self.weight = row[order], self.weight[order]
        self.first = np.searchsorted(term[order], np.arange((len(self.terms) if idf is None else len(idf)) + 1))

    def search(self, lists: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document row, query row, score) of the k best documents of each query in each block."""
        flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
        if self.idf is None:
            term = pc.index_in(flat, self.terms)
            known = term.is_valid().to_numpy(zero_copy_only=False)
            row, term = row[known], term.drop_null().to_numpy().astype(np.int64)
        else:
            term = flat.to_numpy().astype(np.int64)
        row, term, weight = _weights(row, term, self.idf)
        n = len(self.ids)
        step = max(1, BLOCK_CELLS // max(1, n))
        for lo in range(0, len(lists), step):
            hi = min(lo + step, len(lists))
            a, z = np.searchsorted(row, (lo, hi))
            scores = np.zeros((hi - lo) * n)
            own = self.first[term[a:z] + 1] - self.first[term[a:z]]
            ends = np.cumsum(own)
            i = 0
            while i < z - a:  # expand the matches of some document terms
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + BLOCK_TERMS)))
                many = own[i:j]
                src = np.repeat(np.arange(a + i, a + j), many)
                at = np.arange(len(src)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.first[term[a + i:a + j]], many)
                scores += np.bincount((row[src] - lo) * n + self.query[at], weight[src] * self.weight[at], minlength=len(scores))
                i = j
            scores = scores.reshape(hi - lo, n)
            if self.idf is not None:
                scores = np.round(scores, 9)  # so that equal texts tie whatever the order of the sum
            d, q = _best(scores, k)
            yield d + lo, q, scores[d, q]


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def sparse_topk(queries: DataFrame, docs: DataFrame, k: int, idf: np.ndarray | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank): the k documents with the highest dot
    product for each query; ties by document id; only documents with a score
    above zero.

    ``queries`` are (query_id, terms), ``docs`` (doc_id, terms), arrays of terms.
    Without ``idf`` a distinct term weighs 1; with it terms are numbers below
    its length, weighed by tf-idf in vectors of length one."""
    spark = docs.sparkSession
    queries = queries.select("query_id", "terms").where(F.size("terms") > 0)
    size = F.aggregate(F.transform("terms", lambda x: F.octet_length(x.cast("string"))), F.lit(0).cast("long"), lambda a, x: a + x + 16) + 64
    n = -(-(queries.agg(F.sum(size)).first()[0] or 0) // BATCH_BYTES)
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("score", T.DoubleType())])
    rows = docs.select("doc_id", "terms")  # a filter on the terms would make them twice
    parts = []
    for i in range(n):
        batch = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i).toArrow().combine_chunks()
        shared = spark.sparkContext.broadcast((_whole(batch["query_id"]), _whole(batch["terms"]), idf))

        def search(batches: Iterator[pa.RecordBatch], shared=shared):
            found = InvertedList(*shared.value)
            for b in batches:
                b = pa.Table.from_batches([b]).sort_by("doc_id")  # ties inside a block go to the first rows
                names, lists = _whole(b["doc_id"]), _whole(b["terms"])
                for d, q, s in found.search(lists, k):
                    yield pa.RecordBatch.from_arrays([found.ids.take(pa.array(q)), names.take(pa.array(d)), pa.array(s)], schema.names)

        parts.append(rows.mapInArrow(search, schema))
    if not parts:
        parts = [spark.createDataFrame([], schema)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hashed(rows: DataFrame, buckets: int) -> DataFrame:
    """(id, terms) with the tokens of ``terms`` as bucket numbers: the first 32 bits
    of their md5, modulo ``buckets``.  A task hashes a token once a batch."""
    schema = T.StructType([rows.schema.fields[0], T.StructField("terms", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            lists = b.column(1)
            flat = pc.list_flatten(lists).dictionary_encode()
            places = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % buckets for w in flat.dictionary.to_pylist()]
            terms = pa.array(places, pa.int32()).take(flat.indices)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32(), mask=np.append(lists.is_null().to_numpy(zero_copy_only=False), False))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, terms)], schema.names)

    return rows.mapInArrow(run, schema)


def smooth_idf(docs: DataFrame, buckets: int) -> np.ndarray:
    """ln((1 + documents) / (1 + documents with the bucket)) + 1 of every bucket."""
    n = docs.count()
    df = docs.select(F.explode(F.array_distinct("terms")).alias("b")).groupBy("b").agg(F.count("*").alias("n")).toPandas()  # at most ``buckets`` rows
    held = np.zeros(buckets, np.int64)
    held[df["b"].to_numpy(np.int64)] = df["n"].to_numpy(np.int64)
    return np.log((1 + n) / (1 + held)) + 1
