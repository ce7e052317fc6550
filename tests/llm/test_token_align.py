"""Alignment of two tokenizers: against plain Python loops, and on edge cases."""

import hashlib
from collections import Counter

import pytest

from cartwheel.llm import token_align as A
from conftest import SMALL


@pytest.fixture(scope="module")
def sides():
    return [k(open(f"{A.FOLDER}/{f}", "rb").read()) for k, f in ((A.ByteTokens, A.A_FILE), (A.PieceTokens, A.B_FILE))]


def plain(rows, sides):
    """(id, n_a, n_b, groups, links) of each row, one token at a time."""
    names = [s.bytes.to_pylist() for s in sides]
    out = []
    for key, text in rows:
        ids = [s.encode([text])[0] if text else [] for s in sides]
        if not text or any(b"".join(n[i] for i in x) != b" " + text.encode() for n, x in zip(names, ids)):
            out.append((key, 0, 0, "", []))
            continue
        ends = []
        for n, x in zip(names, ids):
            e, own = 0, []
            for i in x:
                e += len(n[i])
                own.append(e)
            ends.append(own)
        groups, i, j, links = [], 0, 0, []
        for cut in sorted(set(ends[0]) & set(ends[1])):
            i2 = max(k for k, e in enumerate(ends[0]) if e == cut) + 1 if len(ends[0]) < 400 else ends[0].index(cut) + 1
            j2 = max(k for k, e in enumerate(ends[1]) if e == cut) + 1 if len(ends[1]) < 400 else ends[1].index(cut) + 1
            groups.append(",".join(map(str, ids[0][i:i2])) + "|" + ",".join(map(str, ids[1][j:j2])))
            links.append((ids[0][i2 - 1], ids[1][j2 - 1]))
            i, j = i2, j2
        out.append((key, len(ids[0]), len(ids[1]), ";".join(groups), links))
    return out


def expected(rows, sides):
    found = plain(rows, sides)
    count = Counter(x for r in found for x in r[4])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(k, na, nb, g, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if na else "") for k, na, nb, g, links in found]


def test_query_against_plain_python(spark, sides):
    from cartwheel.llm.registry import all_queries
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r for r in all_queries()["op12_token_align"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    for k, na, nb, g, links, best, total, sha in expected(rows, sides):
        r = got[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (
            na, nb, g.count("|"), links, best, total, sha), k


def test_segments_give_the_tokens_of_whole_texts(sides, monkeypatch):
    """Cut at blanks, remembered, forgotten: always the tokens of the whole text."""
    import random
    monkeypatch.setattr(A, "CACHE_SEGMENTS", 50)
    rng = random.Random(4)
    alphabet = ["a", "the", " ", " ", "  ", "\n", "\t", " \n ", "'s", "'", "é", "日本", "\u00a0", "\u2003", "\x1c", "\x85", "12", "!?", "▁", "🙂", "\u0301", "<s>", "<|endoftext|>", "ing"]
    segments = A.Segments(*sides)
    assert segments.cut
    for _ in range(60):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(20)]
        for got, side in zip(segments.tokens(texts), sides):
            assert got.to_pylist() == [side.encode([t])[0] if t else [] for t in texts]


def test_edge_rows(spark, sides, monkeypatch):
    monkeypatch.setattr(A, "SLICE_BYTES", 200)
    texts = [None, "", " ", "a", "a", "<|endoftext|> </s> <s>", "naïve café 日本語 🙂 ‍", "x▁y", "tab\tline\n\n  end ",
             "\u0000 zero", "ﬁ ligature ① Ⅳ", "word " * 20_000, "q" * 5_000]
    df = spark.createDataFrame([(i, t, "p", "g") for i, t in enumerate(texts)], "doc_id long, text string, pairs string, id string").coalesce(1)
    got = A.align_tokens(df, with_groups=True).collect()
    short = [(i, t) for i, t in enumerate(texts) if not t or len(t) < 1000]
    for r, (k, na, nb, g, _, _, _, sha) in zip([r for r in got if r.doc_id < 11], expected(short, sides)):
        assert (r.doc_id, r.n_a, r.n_b, r.groups, r.groups_sha256) == (k, na, nb, g, sha), texts[k]
        assert r.n_links == len(r.pairs) and 0 <= r.n_best <= r.n_links <= r.count_sum
    assert got[3].n_a and got[0].n_a == got[1].n_a == 0 and got[1].groups_sha256 == ""
    assert got[7].n_a == 0  # the second vocabulary writes a blank with this character
    assert got[11].n_links >= 20_000 and got[12].n_groups >= 1
    assert A.align_tokens(df.limit(0)).count() == 0


def test_counted_pairs_keep_the_bound(spark, sides):
    """Only pairs of which one ends with the other are linked, and the bound counts them."""
    bound = A.pair_bound(sides[0].bytes, sides[1].bytes)
    assert bound < 400_000
    a, b = sides[0].bytes.to_pylist(), sides[1].bytes.to_pylist()
    rows = A.align_tokens(spark.read.parquet(f"{SMALL}/documents.parquet")).select("pairs").collect()
    pairs = {p for r in rows for p in r.pairs}
    for p in pairs:
        x, y = a[p // len(b)], b[p % len(b)]
        assert x.endswith(y) or y.endswith(x)
    assert 1000 < len(pairs) <= bound


def test_links_are_counted_and_scored_in_slices(monkeypatch):
    """Many lists at once take memory for a slice of their links, whatever the batch."""
    import tracemalloc
    from itertools import chain

    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(3)
    cuts = np.sort(rng.integers(0, 1_000_000, 2_000))
    links = rng.integers(0, 500, 1_000_000).astype(np.int32) * 3
    cuts[:2], cuts[-1] = 0, len(links)
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(links))
    pair, n = np.unique(links, return_counts=True)
    best = n >= np.median(n)
    monkeypatch.setattr(A, "SLICE_LINKS", 10_000)
    tracemalloc.start()
    got = A.score_pairs(lists, pair, n, best)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    at = np.searchsorted(pair, links)
    for x, y in zip(got, (best, n)):
        want = np.concatenate(([0], np.cumsum(y[at], dtype=np.int64)))
        assert x.to_pylist() == (want[cuts[1:]] - want[cuts[:-1]]).tolist()
    assert peak < 4_000_000  # eight bytes a link would be 8 MB
    parts = list(A.count_pairs(lists))
    assert len(parts) > 50
    total = Counter()
    for p, k in chain.from_iterable(zip(t["pair"].to_pylist(), t["n"].to_pylist()) for t in parts):
        total[p] += k
    assert total == dict(zip(pair.tolist(), n.tolist()))
    empty = pa.array([None, []], pa.list_(pa.int32()))
    assert [x.to_pylist() for x in A.score_pairs(empty, pair, n, best)] == [[0, 0], [0, 0]]
    assert [x.to_pylist() for x in A.score_pairs(lists[:0], pair, n, best)] == [[], []]


def test_pairs_only_when_asked_for(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    both = [A.align_tokens(df, with_pairs=w) for w in (True, False)]
    assert "pairs" not in both[1].columns and both[0].drop("pairs").columns == both[1].columns
    assert sorted(map(tuple, both[0].drop("pairs").collect())) == sorted(map(tuple, both[1].collect()))
