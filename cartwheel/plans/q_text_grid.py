"""Queries: text retrieval (V*) over documents / benchmark / embeddings and
grid arithmetic (G*, W15) over the GRID view."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import grid as G
from cartwheel.operators import lsh as L
from cartwheel.operators import retrieval as R
from cartwheel.operators.windows import motion_mask
from cartwheel.plans.catalog import query
from cartwheel.plans.q_core import token_sql
from cartwheel.sources import tables as V

CHUNKS_SQL = """ch AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_no, CAST((i - 1) * {step} AS INTEGER) AS start,
  substring(text, (i - 1) * {step} + 1, {size}) AS chunk
  FROM (SELECT doc_id, text, unnest(range(1, CAST(ceil(length(text) / {step}.0) AS BIGINT) + 1)) AS i FROM documents WHERE length(text) > 0)),
chunks AS (SELECT *, CAST(doc_id AS VARCHAR) || ':' || lpad(CAST(chunk_no AS VARCHAR), 6, '0') AS chunk_id FROM ch
  WHERE length(regexp_replace(chunk, '\\s', '', 'g')) > 0)"""


def _chunks(t, size=1000, overlap=200):
    c = R.chunk(t.documents, "doc_id", size=size, overlap=overlap)
    return c.withColumn("chunk_id", F.concat_ws(":", F.col("doc_id").cast("string"), F.lpad(F.col("chunk_no").cast("string"), 6, "0")))


@query("v1_chunk", f"""WITH {CHUNKS_SQL.format(step=800, size=1000)}
SELECT doc_id, chunk_no, start, length(chunk) AS n_chars, md5(chunk) AS chunk_md5 FROM chunks""")
def q_v1(t):
    c = _chunks(t)
    return c.select("doc_id", F.col("chunk_no").cast("int").alias("chunk_no"), F.col("start").cast("int").alias("start"),
                    F.length("chunk").alias("n_chars"), F.md5("chunk").alias("chunk_md5"))


COS_SQL = """q AS (SELECT label AS query_id, list(CAST(e AS DOUBLE) ORDER BY pos) AS v FROM (
  SELECT label, pos, avg(e) AS e FROM (SELECT label, unnest(embedding) AS e, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)
  GROUP BY label, pos) GROUP BY label),
d AS (SELECT vec_id AS doc_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
s AS (SELECT q.query_id, d.doc_id, list_dot_product(d.v, q.v) / (sqrt(list_dot_product(d.v, d.v)) * (sqrt(list_dot_product(q.v, q.v)) + 1e-10) + 1e-10) AS sim
      FROM d, q)"""


def _centroids(t):
    e = t.embeddings.select("label", F.posexplode("embedding").alias("pos", "e"))
    m = e.groupBy("label", "pos").agg(F.avg(F.col("e").cast("double")).alias("e"))
    return m.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "e"))).alias("_l")).select(
        F.col("label").alias("query_id"), F.transform("_l", lambda s: s["e"]).alias("embedding"))


@query("v2_cosine_topk", f"""WITH {COS_SQL}
SELECT query_id, doc_id, round(sim, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, doc_id) AS rank FROM s) WHERE rank <= 5""")
def q_v2(t):
    r = R.cosine_topk(_centroids(t), t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding"), 5)
    return r.select("query_id", "doc_id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("int").alias("rank"))


@query("v2_lsh_recall", """SELECT count(*) AS n_queries, count(*) * least(10, (SELECT count(*) FROM embeddings)) AS n_exact, true AS reached
FROM embeddings WHERE vec_id % 20 = 0""")
def q_v2_lsh(t):
    """Recall at 10 of the prefiltered search against the exact one; queries are the ids divisible by 20."""
    docs = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    qs = docs.where(F.col("doc_id") % 20 == 0).withColumnRenamed("doc_id", "query_id")
    r = L.recall_at_k(L.lsh_topk(qs, docs, 10), R.cosine_topk(qs, docs, 10))
    return r.select("n_queries", "n_exact", (F.col("recall") >= 0.9).alias("reached"))


KW_SQL = """qt AS (SELECT DISTINCT item_id AS query_id, unnest({qtok}) AS tok FROM benchmark),
ct AS (SELECT DISTINCT chunk_id, unnest({ctok}) AS tok FROM chunks),
hits AS (SELECT query_id, chunk_id, count(*) AS score FROM ct JOIN qt USING (tok) GROUP BY 1, 2),
fill AS (SELECT item_id AS query_id, chunk_id, 0 AS score FROM benchmark,
         (SELECT chunk_id FROM (SELECT DISTINCT chunk_id FROM chunks) ORDER BY chunk_id LIMIT {k})),
cand AS (SELECT query_id, chunk_id, max(score) AS score FROM (SELECT * FROM hits UNION ALL SELECT * FROM fill) GROUP BY 1, 2),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM cand)
           WHERE rank <= {k})"""


# hashed tf-idf vectors: the first 32 bits of a token's md5 choose its place
SEM_SQL = """cb AS (SELECT chunk_id, unnest(list_transform({ctok}, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % {buckets})) AS b FROM chunks),
ctf AS (SELECT chunk_id, b, count(*) AS tf FROM cb GROUP BY 1, 2),
total AS (SELECT count(*) AS n FROM chunks),
idf AS (SELECT b, ln((1 + n) / (1 + count(*))) + 1 AS w FROM ctf, total GROUP BY b, n),
cw AS (SELECT chunk_id, b, tf * w AS w FROM ctf JOIN idf USING (b)),
cn AS (SELECT chunk_id, sqrt(sum(w * w)) AS norm FROM cw GROUP BY 1),
qb AS (SELECT item_id AS query_id, unnest(list_transform({qtok}, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % {buckets})) AS b FROM benchmark),
qw AS (SELECT query_id, b, count(*) * coalesce(any_value(w), ln(1 + any_value(n)) + 1) AS w FROM qb LEFT JOIN idf USING (b), total GROUP BY 1, 2),
qn AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM qw GROUP BY 1),
hits AS (SELECT query_id, chunk_id, round(sum(qw.w * cw.w) / any_value(qn.norm * cn.norm), 9) AS score
         FROM cw JOIN qw USING (b) JOIN cn USING (chunk_id) JOIN qn USING (query_id) GROUP BY 1, 2),
fill AS (SELECT item_id AS query_id, chunk_id, 0 AS score FROM benchmark,
         (SELECT chunk_id FROM (SELECT DISTINCT chunk_id FROM chunks) ORDER BY chunk_id LIMIT {k})),
cand AS (SELECT query_id, chunk_id, max(score) AS score FROM (SELECT * FROM hits UNION ALL SELECT * FROM fill) GROUP BY 1, 2),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM cand)
           WHERE rank <= {k})"""


def _kw_sql(k, size=1000, step=800):
    return (CHUNKS_SQL.format(step=step, size=size) + ",\n" +
            KW_SQL.format(qtok=token_sql("text"), ctok=token_sql("chunk"), k=k))


@query("v3_keyword_topk", f"""WITH {_kw_sql(5)}
SELECT query_id, chunk_id, CAST(score AS BIGINT) AS score, CAST(rank AS INTEGER) AS rank FROM ranked""")
def q_v3(t):
    r = R.keyword_topk(t.benchmark.select(F.col("item_id").alias("query_id"), "text"), _chunks(t), 5)
    return r.select("query_id", "chunk_id", F.col("score").cast("bigint").alias("score"), F.col("rank").cast("int").alias("rank"))


@query("v4_build_context", f"""WITH {_kw_sql(3)}
SELECT query_id, md5(string_agg(chunk, chr(10) || chr(10) ORDER BY rank)) AS context_md5, count(*) AS n_chunks
FROM ranked JOIN chunks USING (chunk_id) GROUP BY query_id""")
def q_v4(t):
    ch = _chunks(t)
    r = R.keyword_topk(t.benchmark.select(F.col("item_id").alias("query_id"), "text"), ch, 3)
    c = R.build_context(r, ch)
    n = r.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    return c.join(n, "query_id").select("query_id", F.md5("context").alias("context_md5"), "n_chunks")


def _grid_sql():
    parts = []
    for size in (500, 1000, 2000):
        for k in (1, 3, 5, 10):
            body = _kw_sql(10, size=size, step=size - 200)
            parts.append(f"""SELECT {size} AS chunk_size, {k} AS k, 'keyword' AS search, count(*) AS n_retrieved,
  count(DISTINCT query_id) AS n_queries, round(avg(score), 6) AS mean_score FROM (WITH {body} SELECT * FROM ranked) WHERE rank <= {k}""")
    for size in (500, 1000, 2000):
        body = CHUNKS_SQL.format(step=size - 200, size=size) + ",\n" + SEM_SQL.format(qtok=token_sql("text"), ctok=token_sql("chunk"), k=10, buckets=1 << 18)
        parts.append(f"""SELECT {size} AS chunk_size, k, 'semantic' AS search, count(*) AS n_retrieved, count(DISTINCT query_id) AS n_queries,
  round(avg(score), 6) AS mean_score FROM (WITH {body} SELECT * FROM ranked) JOIN (VALUES (1), (3), (5), (10)) AS ks(k) ON rank <= k GROUP BY k""")
    return "\nUNION ALL ".join(parts)


@query("v3_semantic_topk", f"""WITH {CHUNKS_SQL.format(step=800, size=1000)},
{SEM_SQL.format(qtok=token_sql("text"), ctok=token_sql("chunk"), k=5, buckets=1 << 18)}
SELECT query_id, rank::INTEGER AS rank, round(score, 6) AS score FROM ranked""")
def q_v3s(t):
    r = R.semantic_topk(t.benchmark.select(F.col("item_id").alias("query_id"), "text"), _chunks(t), 5)
    return r.select("query_id", F.col("rank").cast("int").alias("rank"), F.round("score", 6).alias("score"))


@query("v5_retrieval_grid", _grid_sql())
def q_v5(t):
    return R.retrieval_grid(t.documents, t.benchmark.select(F.col("item_id").alias("query_id"), "text"))


# ------------------------------------------------------------------ grids

@query("g1_sat_scalar", """SELECT frame, channel, y, x, CAST(least(greatest(v + 100, 0), 255) AS INTEGER) AS v_add,
  CAST(least(greatest(v - 100, 0), 255) AS INTEGER) AS v_sub, CAST(least(greatest(50 - v, 0), 255) AS INTEGER) AS v_rsub,
  CAST(trunc(least(greatest(v * 1.7::DOUBLE, 0), 255)) AS INTEGER) AS v_mul FROM grid""", ("grid",))
def q_g1(t):
    g = V.grid(t)
    a = G.sat_add(g, 100).withColumnRenamed("v", "v_add")
    return (a.join(G.sat_sub(g, 100).withColumnRenamed("v", "v_sub"), ["frame", "channel", "y", "x"])
            .join(G.sat_rsub(g, 50).withColumnRenamed("v", "v_rsub"), ["frame", "channel", "y", "x"])
            .join(G.sat_mul(g, 1.7).withColumnRenamed("v", "v_mul"), ["frame", "channel", "y", "x"]))


@query("g1_sat_grid", """SELECT a.frame, a.channel, a.y, a.x, CAST(least(greatest(a.v - b.v, 0), 255) AS INTEGER) AS v
FROM grid a JOIN grid b ON b.frame = a.frame + 3 AND b.channel = a.channel AND b.y = a.y AND b.x = a.x""", ("grid",))
def q_g1g(t):
    return G.pair_frames(V.grid(t), 3, "sub")


@query("g2_negative", "SELECT frame, channel, y, x, 255 - v AS v FROM grid", ("grid",))
def q_g2(t):
    return G.negative(V.grid(t))


RGB_SQL = "rgb AS (SELECT frame // 3 AS image, frame % 3 AS channel, y, x, v FROM grid)"


def _rgb(t):
    g = V.grid(t)
    return g.select((F.col("frame") / 3).cast("bigint").alias("image"), (F.col("frame") % 3).cast("int").alias("channel"), "y", "x", "v")


@query("g3_to_gray", f"""WITH {RGB_SQL}
SELECT image, y, x, CAST(trunc(least(greatest(0.299::DOUBLE * max(v) FILTER (WHERE channel = 0) + 0.587::DOUBLE * max(v) FILTER (WHERE channel = 1)
  + 0.114::DOUBLE * max(v) FILTER (WHERE channel = 2), 0), 255)) AS INTEGER) AS v
FROM rgb GROUP BY 1, 2, 3""", ("grid",))
def q_g3(t):
    return G.to_gray(_rgb(t))


@query("g4_channel", f"WITH {RGB_SQL} SELECT image, channel, y, x, CASE WHEN channel = 1 THEN v ELSE 0 END AS v FROM rgb", ("grid",))
def q_g4(t):
    return G.channel(_rgb(t), "G")


@query("g5_contrast", """SELECT frame, channel, y, x,
  CAST(trunc(least(greatest((259.0::DOUBLE * (60 + 255.0::DOUBLE) / (255.0::DOUBLE * (259.0::DOUBLE - 60))) * (v - 128) + 128, 0), 255)) AS INTEGER) AS v FROM grid""",
       ("grid",))
def q_g5(t):
    return G.contrast(V.grid(t), 60)


_BINOM = (1, 6, 15, 20, 15, 6, 1)
_KERNELS = {  # written out apart from the engine's own
    "box7": ([[1 / 49] * 7] * 7, 0.0), "binomial7": ([[a * b / 4096 for b in _BINOM] for a in _BINOM], 0.0),
    "sharpen": ([[-1, -1, -1], [-1, 9, -1], [-1, -1, -1]], 0.0),
    "laplacian": ([[-1.5, -1.5, -1.5], [-1.5, 12, -1.5], [-1.5, -1.5, -1.5]], 0.0),
    "emboss": ([[-2, -1, 0], [-1, 1, 1], [0, 1, 2]], 128.0),
}


def _conv_sql(name):
    m, off = _KERNELS[name]
    kh, kw = len(m), len(m[0])
    vals = ", ".join(f"({i}, {j}, {float(m[i][j])!r}::DOUBLE)" for i in range(kh) for j in range(kw))
    ch, cw = (kh - 1) // 2, (kw - 1) // 2
    mir = "CASE WHEN {e} < 0 THEN -({e}) - 1 WHEN {e} >= {n} THEN 2 * {n} - ({e}) - 1 ELSE {e} END"
    sy = mir.format(e=f"(o.y + {ch} - k.ki)", n="8")
    sx = mir.format(e=f"(o.x + {cw} - k.kj)", n="8")
    return f"""WITH k(ki, kj, w) AS (VALUES {vals})
SELECT o.frame, o.channel, o.y, o.x,
  CAST(trunc(least(trunc(least(greatest(round(sum(k.w * g.v), 9), 0), 255)) + {off}::DOUBLE, 255)) AS INTEGER) AS v
FROM grid o CROSS JOIN k JOIN grid g ON g.frame = o.frame AND g.channel = o.channel AND g.y = {sy} AND g.x = {sx}
GROUP BY o.frame, o.channel, o.y, o.x"""


for _name in ["box7", "binomial7", "sharpen", "laplacian", "emboss"]:
    def _mk(name):
        def q(t):
            return G.convolve(V.grid(t), name)
        return q
    query(f"g6_convolve_{_name}", _conv_sql(_name), ("grid",))(_mk(_name))


@query("g8_grid_info", "SELECT frame, max(y) + 1 AS height, max(x) + 1 AS width, count(DISTINCT channel) AS channels, count(*) AS cells FROM grid GROUP BY 1",
       ("grid",))
def q_g8(t):
    return G.grid_info(V.grid(t))


@query("w15_motion_mask", """SELECT a.frame, a.y, a.x, CAST(abs(b.v - a.v) AS INTEGER) AS diff, CASE WHEN abs(b.v - a.v) > 40 THEN 255 ELSE 0 END AS mask
FROM grid a JOIN grid b ON b.frame = a.frame + 1 AND b.y = a.y AND b.x = a.x""", ("grid",))
def q_w15(t):
    return motion_mask(V.grid(t), 40)
