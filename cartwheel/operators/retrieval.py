"""Text retrieval (V1-V5) as Spark jobs.

Chunks are generated with ``sequence`` + ``posexplode`` (whole texts, every
chunk).  Cosine, keyword and semantic search score every chunk against the
queries, broadcast in batches of measured size, then keep the top-k per query
with a ``row_number`` filter that Spark pre-limits per task, so that no more
than k rows a query and task are shuffled.  ``lsh.lsh_topk`` is the cosine
search that compares likely neighbours only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.scalars import tokenize
from cartwheel.operators.dense import nearest, whole
from cartwheel.operators.sparse import hashed, smooth_idf, sparse_topk
from cartwheel.session import bounded_broadcast, materialize

RANKED_ROWS = 1 << 18

def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# V1
def chunk(df: DataFrame, id_col: str, text: str = "text", size: int = 1000, overlap: int = 200) -> DataFrame:
    """Fixed-size character chunks starting every size−overlap characters;
    whitespace-only chunks dropped.  (doc, chunk_no, start, chunk)."""
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(step))
    pieces = F.transform(starts, lambda s: F.substring(F.col(text), s + 1, F.lit(size)))  # a row has its piece, not the text
    c = df.where(F.length(text) > 0).select(id_col, F.posexplode(pieces).alias("chunk_no", "chunk"))
    return c.where(F.col("chunk").rlike(r"\S")).select(id_col, "chunk_no", (F.col("chunk_no") * step).alias("start"), "chunk")


# V2
def cosine_topk(queries: DataFrame, docs: DataFrame, k: int, q_id: str = "query_id", d_id: str = "doc_id",
                vec: str = "embedding") -> DataFrame:
    """Top-k documents per query by dot/(|d|·(|q|+1e-10) + 1e-10); ties by doc id.

    All pairs are scored, in tiles inside the tasks (``dense``); a null vector, a null
    in it or another length than the query's has no cosine and ranks last."""
    q = queries.select(F.col(q_id).alias("query_id"), F.col(vec).cast("array<double>").alias("v"))
    d = docs.select(F.col(d_id).alias("doc_id"), F.col(vec).cast("array<double>").alias("v"))
    q = materialize(q)
    parts = []
    for r in q.groupBy(F.size("v").alias("n")).count().collect():  # a row a length
        if r["n"] is not None and r["n"] >= 0:
            own = q.where(whole("v", r["n"]))
            parts += nearest(own, d.where(whole("v", r["n"])), k, r["n"])
            parts.append(_without_cosine(own, d.where(~whole("v", r["n"])), k))
    known = F.coalesce(~F.exists("v", lambda x: x.isNull()), F.lit(False))
    s = _union([_without_cosine(q.where(~known), d, k), *parts])
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "doc_id")
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _without_cosine(queries: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Documents that have no cosine with the queries rank last, by id: the first k of them can."""
    first = docs.select("doc_id").orderBy("doc_id").limit(k)
    return queries.select("query_id").crossJoin(F.broadcast(first)).withColumn("similarity", F.lit(None).cast("double"))


# V3
def keyword_topk(queries: DataFrame, chunks: DataFrame, k: int, q_id: str = "query_id", q_text: str = "text",
                 c_id: str = "chunk_id", c_text: str = "chunk") -> DataFrame:
    """Top-k chunks per query by the number of shared distinct tokens; ties
    by chunk id; zero-score chunks fill the list when fewer than k overlap.

    A block of chunks at a time is scored against the queries' inverted list
    (``sparse_topk``): a common token makes no row for each pair that shares it."""
    terms = lambda df, i, t, name: df.select(F.col(i).alias(name), tokenize(t).alias("terms"))
    hits = sparse_topk(terms(queries, q_id, q_text, "query_id"), terms(chunks, c_id, c_text, "doc_id"), k)
    hits = hits.select("query_id", F.col("doc_id").alias("chunk_id"), F.col("score").cast("bigint").alias("score"))
    return _filled(hits, queries, chunks, k, q_id, c_id)


def _filled(hits: DataFrame, queries: DataFrame, chunks: DataFrame, k: int, q_id: str, c_id: str) -> DataFrame:
    """Ranks of the hits, with chunks of score zero where fewer than k have one:
    the k smallest chunk ids, for every query (k x queries rows).  The chunks are
    read for that only if a query is short of hits."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")
    cand = materialize(hits.groupBy("query_id", "chunk_id").agg(F.max("score").alias("score")))
    ids = queries.select(F.col(q_id).alias("query_id"))
    met = cand.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    if not ids.join(met, "query_id", "left_anti").isEmpty():
        first_k = chunks.select(F.col(c_id).alias("chunk_id")).distinct().orderBy("chunk_id").limit(k)
        fill = ids.crossJoin(F.broadcast(first_k)).withColumn("score", F.lit(0).cast(hits.schema["score"].dataType))
        cand = cand.unionByName(fill).groupBy("query_id", "chunk_id").agg(F.max("score").alias("score"))
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def semantic_topk(queries: DataFrame, chunks: DataFrame, k: int, q_id: str = "query_id", q_text: str = "text",
                  c_id: str = "chunk_id", c_text: str = "chunk", buckets: int = 1 << 18) -> DataFrame:
    """Top-k chunks per query by the cosine of hashed tf-idf vectors; ties by
    chunk id, fillers as in ``keyword_topk``.

    A vector has a place for each of ``buckets`` token hashes; it is kept sparse,
    and written once for the weights and the search.
    The weights of the buckets (at most ``buckets`` numbers) are broadcast."""
    terms = lambda df, i, t, name: hashed(df.select(F.col(i).alias(name), tokenize(t).alias("terms")), buckets)
    docs = materialize(terms(chunks, c_id, c_text, "doc_id"))
    hits = sparse_topk(terms(queries, q_id, q_text, "query_id"), docs, k, smooth_idf(docs, buckets))
    return _filled(hits.select("query_id", F.col("doc_id").alias("chunk_id"), "score"), queries, chunks, k, q_id, c_id)


# V4
def build_context(ranked: DataFrame, texts: DataFrame, q_id: str = "query_id", c_id: str = "chunk_id",
                  text: str = "chunk") -> DataFrame:
    """Top-k texts in rank order joined by a blank line, one row per query.  Up to
    ``RANKED_ROWS`` ranks are broadcast, so that the texts stay where they are."""
    ranked = bounded_broadcast(materialize(ranked), RANKED_ROWS)
    j = texts.select(F.col(c_id).alias("chunk_id"), F.col(text).alias("_t")).join(ranked, "chunk_id")
    g = j.groupBy(q_id).agg(F.array_sort(F.collect_list(F.struct("rank", "_t"))).alias("_l"))
    return g.select(q_id, F.array_join(F.transform("_l", lambda s: s["_t"]), "\n\n").alias("context"))


# V5
def retrieval_grid(docs: DataFrame, queries: DataFrame, sizes: Sequence[int] = (500, 1000, 2000),
                   ks: Sequence[int] = (1, 3, 5, 10), overlap: int = 200, id_col: str = "doc_id") -> DataFrame:
    """Keyword and semantic retrieval for every (chunk size, k): per configuration
    the number of retrieved chunks, queries answered and mean score (shared
    tokens or cosine).  One chunking, one scoring and one aggregate per size and
    kind of search, for all k."""
    kmax = max(ks)
    parts = []
    for size in sizes:
        ch = chunk(docs, id_col, size=size, overlap=overlap)
        ch = ch.withColumn("chunk_id", F.concat_ws(":", F.col(id_col).cast("string"), F.lpad(F.col("chunk_no").cast("string"), 6, "0")))
        for kind, find in (("keyword", keyword_topk), ("semantic", semantic_topk)):
            # every query that has rows has one of rank 1
            row = lambda k: F.struct(
                F.lit(size).alias("chunk_size"), F.lit(k).alias("k"), F.lit(kind).alias("search"),  # noqa: B023
                F.count_if(F.col("rank") <= k).alias("n_retrieved"), F.count_if(F.col("rank") == 1).alias("n_queries"),
                F.round(F.avg(F.when(F.col("rank") <= k, F.col("score"))), 6).alias("mean_score"))
            parts.append(find(queries, ch, kmax).agg(F.array(*[row(k) for k in ks]).alias("_r")).select(F.inline("_r")))
    return _union(parts)
