"""Periodic runs: against plain Python, in pieces, and on edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import periodic_runs as P
from conftest import SMALL


def plain_runs(words, least=12):
    """Every period of every stretch, by definition."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((a, m, q) for (a, m), q in out.items())


def by_start(runs):
    return sorted(map(tuple, np.asarray(runs).tolist()), key=lambda r: (r[0], r[2]))


def plain_kept(words, runs):
    lost = {i for a, m, q in runs for i in range(a + q, a + m)}
    return [w for i, w in enumerate(words) if i not in lost]


def cases():
    rng = random.Random(5)
    yield []
    yield [b"a"] * 11
    yield [b"a"] * 12
    yield [b"a"] * 500
    yield [b"a", b"b", b"a"] * 4
    yield [b"%d" % i for i in range(300)] * 2
    yield [b"%d" % i for i in range(300)] * 2 + [b"0"]
    thue = [0]
    for _ in range(11):
        thue += [1 - x for x in thue]
    yield [b"%d" % x for x in thue]  # polynomial hashes modulo 2^64 collide on it
    fib, last = [0, 1], [0]
    while len(fib) < 900:
        fib, last = fib + last, fib
    yield [b"%d" % x for x in fib]
    for n, letters in ((40, 2), (200, 2), (400, 3), (60, 1), (700, 40)):
        for _ in range(25):
            w = [b"%d" % rng.randrange(letters) for _ in range(n)]
            for _ in range(rng.randrange(4)):
                a = rng.randrange(n)
                p = 1 + rng.randrange(max(1, (n - a) // 2))
                z = min(n, a + p * rng.randrange(1, 9) + rng.randrange(p))
                w[a:z] = [w[a + (i - a) % p] for i in range(a, z)]
            yield w


def test_runs_match_plain_python():
    for words in cases():
        got = P.runs_of(words)
        assert got.tolist() == [list(r) for r in by_start(plain_runs(words))], len(words)
        kept = P.kept_words(len(words), got)
        assert [words[i] for i in np.flatnonzero(kept)] == plain_kept(words, plain_runs(words))


@pytest.mark.parametrize("least", [2, 3, 5, 12, 30])
def test_least_length_and_pieces(least):
    """Pieces of any size give the runs of the whole."""
    rng = random.Random(least)
    for words in list(cases())[:60:3]:
        ids, want = P.numbered(words), by_start(plain_runs(words, least))
        whole, pieces, single = (P.SquareCatcher(least) for _ in range(3))
        whole.append(ids)
        at = 0
        while at < len(ids):
            step = rng.randrange(0, 50)
            pieces.append(ids[at:at + step])
            at += step
        for i in range(len(ids) if len(ids) <= 250 else 0):
            single.append(ids[i:i + 1])
        assert whole.runs().tolist() == [list(r) for r in want]
        assert pieces.runs().tolist() == [list(r) for r in want]
        assert len(ids) > 250 or single.runs().tolist() == [list(r) for r in want]


def test_long_text_is_fast():
    import time
    t = time.time()
    rng = np.random.default_rng(3)
    for ids in (np.zeros(300_000, np.int64), rng.integers(0, 2, 300_000), np.tile(rng.integers(0, 99, 7919), 40)):
        c = P.SquareCatcher()
        c.append(ids)
        assert len(c.runs())
    assert time.time() - t < 60


def test_query_against_plain_python(spark):
    from cartwheel.llm.registry import all_queries
    got = {r.doc_id: r for r in all_queries()["op13_periodic_runs"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words = P.WORD.findall((d.text or "").encode())
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        runs = by_start(plain_runs(words))
        r = got[d.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(plain_kept(words, runs))).hexdigest()
    assert planted > 5


def test_edge_rows(spark):
    texts = [None, "", " \n\t", "a " * 12, "a " * 12, "é ü " * 20, "x\u00a0y " * 30, "w " * 200_000]
    df = spark.createDataFrame([(None if i == 5 else i, t, "r", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, runs string, id int")
    got = P.periodic_runs(df).collect()
    assert [r.n_words for r in got] == [0, 0, 0, 12, 12, 40, 30, 200_000]
    assert [[tuple(x) for x in r.runs] for r in got] == [[], [], [], [(0, 12, 1)], [(0, 12, 1)], [(0, 40, 2)], [(0, 30, 1)], [(0, 200_000, 1)]]
    assert [r.collapsed for r in got] == ["", "", "", "a", "a", "é ü", "x\u00a0y", "w"]
    assert got[5].doc_id is None and P.periodic_runs(df.limit(0)).count() == 0
    assert P.planted(df.select("doc_id", F.lit(None).cast("string").alias("text"))).count() == len(texts)
