"""The prefiltered cosine search against the exact one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import lsh, retrieval


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], "doc_id long, embedding array<double>")


def clustered(n, dim=32, seed=3, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(1, n // 12), dim))
    return [(i, centres[i % len(centres)] + spread * rng.standard_normal(dim)) for i in range(n)]


def as_queries(df):
    return df.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")


def test_recall_and_share_of_pairs_on_clustered_vectors(spark):
    docs = vectors(spark, clustered(4000)).cache()
    qs = as_queries(docs)
    exact = retrieval.cosine_topk(qs, docs, 10)
    r = lsh.recall_at_k(lsh.lsh_topk(qs, docs, 10), exact).first()
    assert r["n_queries"] == 200 and r["n_exact"] == 2000 and r["recall"] >= 0.9
    p, reached = lsh.fit(qs, docs, 10)
    assert reached >= 0.95 and p.bits >= 10
    v = np.array([r["embedding"] for r in docs.orderBy("doc_id").collect()])
    own, near = p.keys(v), p.probe_keys(v[::20]).reshape(200, p.tables, -1)
    met = np.zeros((200, 4000), bool)
    for t in range(p.tables):
        for j in range(near.shape[2]):
            met |= near[:, t, j][:, None] == own[:, t][None, :]
    assert met.mean() < 0.15  # most pairs are never compared


def test_hot_vector_ties_and_rows_without_a_vector(spark):
    """A third of the rows share a vector: ids decide, and the answer is the exact one."""
    rows = clustered(300) + [(1000 + i, np.ones(32)) for i in range(150)] + [(5000, np.zeros(32)), (5020, None), (5040, [])]
    docs = vectors(spark, rows)
    qs = as_queries(docs).where("query_id >= 1000 or query_id < 200")
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["similarity"]) for r in lsh.lsh_topk(qs, docs, 5).collect()}
    want = {(r["query_id"], r["rank"]): (r["doc_id"], r["similarity"]) for r in retrieval.cosine_topk(qs, docs, 5).collect()}
    assert set(got) == set(want)
    for key in want:
        if 1000 <= key[0] < 2000:
            assert got[key][0] == want[key][0] and got[key][1] == pytest.approx(want[key][1])
    assert sum(got[k][0] == want[k][0] for k in want) >= 0.9 * len(want)


def test_plan_has_no_pairs_of_all_rows(spark):
    docs = vectors(spark, clustered(2000))
    plan = lsh.lsh_topk(as_queries(docs), docs, 5)
    left = plan._jdf.queryExecution().optimizedPlan().toString().split("Union")[1]
    assert "key" not in left  # buckets were joined and written before
    assert lsh.lsh_topk(as_queries(docs).limit(0), docs, 5).count() == 0
    assert lsh.lsh_topk(as_queries(docs), docs.limit(0), 5).count() == 0


def test_probes_are_buckets_of_changed_signs():
    p = lsh.planes(8, 6, tables=3, probes=4)
    v = np.random.default_rng(1).standard_normal((20, 8))
    own, near = p.keys(v), p.probe_keys(v).reshape(20, 3, -1)
    change = near ^ own[:, :, None]
    assert (change >> 6 == 0).all() and sorted(set(np.bitwise_count(change).ravel().tolist())) == [0, 1, 2]
    assert all(len(set(x)) == len(x) for row in near.tolist() for x in row)


def test_exact_search_in_tiles(spark, monkeypatch):
    """Ties, nulls, lengths and not-a-number rank as a sort of all pairs does, and no pair becomes a row."""
    from cartwheel.operators import dense
    monkeypatch.setattr(dense, "TILE_DOCS", 16)
    monkeypatch.setattr(dense, "TILE_QUERIES", 8)
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-2, 3, 6)) for i in range(90)] + [(i, np.ones(6)) for i in range(90, 130)]
    rows += [(200, None), (201, []), (202, np.ones(3)), (203, [np.nan, 1, 1, 1, 1, 1]), (204, np.zeros(6)), (205, np.ones(6) * 2)]
    docs = vectors(spark, rows)
    docs = docs.unionByName(docs.where("doc_id = 90").selectExpr("206L as doc_id", "array(1D, null, 1D, 1D, 1D, 1D) as embedding"))
    qs = docs.where("doc_id % 10 = 0 or doc_id > 199").withColumnRenamed("doc_id", "query_id")
    v = {r["doc_id"]: r["embedding"] for r in docs.collect()}

    def cosine(q, d):
        if q is None or d is None or len(q) != len(d) or None in q or None in d:
            return None
        dot = sum((a * b for a, b in zip(q, d)), 0.0)
        return dot / (sum(a * a for a in d) ** 0.5 * (sum(a * a for a in q) ** 0.5 + 1e-10) + 1e-10)

    def last(s):
        return (2, 0) if s is None else (0, 0) if s != s else (1, -s)

    plan = retrieval.cosine_topk(qs, docs, 7)
    got = {(r["query_id"], r["rank"]): r["doc_id"] for r in plan.collect()}
    want = {}
    for (q,) in qs.select("query_id").collect():
        for n, d in enumerate(sorted(v, key=lambda d: (last(cosine(v[q], v[d])), d))[:7]):
            want[q, n + 1] = d
    assert got == want
    assert "zip_with" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in lsh.lsh_topk(qs.where("query_id < 200"), docs.where("size(embedding) = 6"), 7)._jdf.queryExecution().optimizedPlan().toString()
