"""Exact and near copies, packing, URL verdicts, archive records, tool calls and the pipeline."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import exact_dedup, near_join, packing, tool_calls, url_filter, warc
from conftest import SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, sid string, a int, n int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, None, "x", "y", 1, 2) for i, t in rows], DOCS)


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# ---------------------------------------------------------------- exact copies

@pytest.mark.parametrize("digest", [exact_dedup.content_hash, lambda t: bytes([len(t) % 2]) * 16])
def test_exact_groups(spark, digest):
    """Also with a hash that collides all the time."""
    d = docs(spark, [(1, "Aa"), (2, "aA"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "bb"), (8, "x" * 100_000), (9, "X" * 100_000), (9, "aa"), (None, "bb"), (None, "null id")])
    got = exact_dedup.exact_groups(d, digest=digest).collect()
    want = {}
    for r in d.collect():
        want.setdefault(low(r.text), []).append(r.doc_id)
    rows = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got)
    expect = Counter()
    for t, ids in want.items():
        keep = min((i for i in ids if i is not None), default=None)
        expect.update((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    assert rows == expect


def test_drop_copies(spark):
    d = docs(spark, [(1, "a"), (2, "A"), (3, "b"), (4, None), (5, "")])
    kept = exact_dedup.drop_copies(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    repeated = docs(spark, [(1, "a"), (1, "a"), (1, "b"), (2, "A"), (None, "c"), (None, "C"), (None, "a")])
    kept = sorted(((r.doc_id, low(r.text)) for r in exact_dedup.drop_copies(repeated).collect()), key=str)
    assert kept == [(1, "a"), (1, "b"), (None, "c")]
    assert exact_dedup.drop_copies(d.limit(0)).count() == 0
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(d, keep="max").collect()) == [2, 3, 5]


# ---------------------------------------------------------------- near copies

def plain_components(rows, k, num, den=100):
    sets, by = {}, {}
    for i, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        s = {tuple(ws[j:j + k]) for j in range(len(ws) - k + 1)} if len(ws) >= k else ({tuple(ws)} if ws else set())
        sets[i] = s
        for x in s:
            by.setdefault(x, []).append(i)
    common = Counter((a, b) for ids in by.values() for n, a in enumerate(ids) for b in ids[n + 1:])
    to = {i: i for i in sets}

    def find(x):
        while to[x] != x:
            to[x] = to[to[x]]
            x = to[x]
        return x

    for (a, b), c in common.items():
        if den * c >= num * (len(sets[a]) + len(sets[b]) - c):
            a, b = sorted((find(a), find(b)))
            to[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check_components(d, k, num):
    rows = [(r.doc_id, r.text) for r in d.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_join.link_components(d, k, num).collect()}
    assert got == plain_components(rows, k, num)


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80)])
def test_near_join_matches_all_pairs(spark, k, num):
    check_components(table(spark, "documents"), k, num)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_join_on_planted_groups(spark, seed):
    """Edited copies around the threshold, chains of edits, passages that many
    share, sets of every small size."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(5000)}"
    shared = [[word() for _ in range(n)] for n in (12, 40)]
    texts = [[word() for _ in range(n)] for n in range(0, 30)]
    for _ in range(25):
        base = [word() for _ in range(int(rng.integers(5, 160)))] + shared[int(rng.integers(2))] * int(rng.integers(0, 2))
        texts.append(base)
        chain = list(base)
        for _ in range(int(rng.integers(1, 12))):
            copy = list(chain if rng.integers(2) else base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(len(copy)))] = word()
            texts.append(copy)
            chain = copy
    texts += [shared[0] + [word() for _ in range(4)] for _ in range(40)]
    d = docs(spark, [(i, " ".join(t)) for i, t in enumerate(rng.permutation(np.array(texts, object)))]).repartition(3)
    check_components(d, 4, 85)
    check_components(d, 5, 80)


def test_sketches_never_lose_a_link():
    """Any two sets that link share a key, whichever shingles count as hot."""
    rng = np.random.default_rng(5)
    for num in (80, 85):
        for _ in range(300):
            n = int(rng.integers(1, 200))
            x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            gone = int(rng.integers(0, len(x) * (100 - num) // 100 + 2))
            new = int(rng.integers(0, len(x) * (100 - num) // 100 + 2))
            y = np.unique(np.concatenate((rng.permutation(x)[gone:], rng.integers(0, 2**63, new).astype(np.uint64))))
            common = len(np.intersect1d(x, y))
            if 100 * common < num * (len(x) + len(y) - common) or np.array_equal(x, y):
                continue
            hot = rng.permutation(x)[:int(rng.integers(0, len(x) + 1))]
            s = near_join.Sketches(num, 100, hot)
            assert np.intersect1d(s.keys(x), s.keys(y)).size


def test_near_join_edge_cases(spark):
    d = docs(spark, [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a"), (7, "b c d e f " * 9000), (8, "b c d e f " * 9000 + "x"), (9, "z y")])
    check_components(d, 4, 85)
    with_null = docs(spark, [(None, "p q r s t u v w x y z 1 2 3"), (5, "p q r s t u v w x y z 1 2 3"), (5, "p q r s t u v w x y z 1 2 3"), (None, "solo one")])
    got = Counter((r.doc_id, r.component_id) for r in near_join.link_components(with_null).collect())
    assert got == Counter({(None, 5): 1, (5, 5): 2, (None, None): 1})
    assert near_join.link_components(d.limit(0)).count() == 0
    kept = near_join.drop_near_copies(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 9]


def test_drop_near_copies_of_a_repeated_id(spark):
    """An id with a near copy of a smaller id's text loses that row only."""
    one, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, one), (2, one + " x"), (2, other), (2, other), (2, None), (3, other + " y"), (4, one + " z"), (None, one)]
    kept = near_join.drop_near_copies(docs(spark, rows))
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, one), (2, other), (2, other), (2, None), (None, one)])


def test_components_of_a_long_chain(spark):
    n = 300
    order = np.random.default_rng(0).permutation(n).tolist()
    edges = [(order[i], order[i + 1]) for i in range(n - 1) if i != 150] + [(7, 7)]
    got = {r.node: r.root for r in near_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {min(order[:151]), min(order[151:])} and got[order[0]] == min(order[:151])
    assert near_join.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- packing

def check_packing(rows, lengths, sizes):
    pieces, bins = {}, {}
    for r in rows:
        if r.bin_id is None:
            assert r.length == 0
            continue
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        bins.setdefault(r.bin_id, []).append(r)
    for i, n in lengths.items():  # every token once, in order
        at = 0
        for start, length in sorted(pieces.get(i, [])):
            assert start == at
            at += length
        assert at == n
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert {r.bin_size for r in b} == {min(s for s in sizes if s >= at)}
    return bins


def test_packing_of_documents(spark):
    d = table(spark, "documents")
    lengths = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in d.collect()}
    bins = check_packing(packing.pack(d).collect(), lengths, packing.SIZES)
    room = sum(b[0].bin_size for b in bins.values())
    assert sum(lengths.values()) <= room <= 1.03 * sum(lengths.values()) + max(packing.SIZES)
    check_packing(packing.pack(d, group_pieces=20).collect(), lengths, packing.SIZES)


def test_best_fit_takes_the_least_room():
    bins, at, size = packing.best_fit(np.array([8, 5, 4, 3, 2, 2]), (8, 10), 0)
    used = Counter()
    for b, n in zip(bins.tolist(), [8, 5, 4, 3, 2, 2]):
        used[b] += n
    assert sum({b: s for b, s in zip(bins.tolist(), size.tolist())}.values()) <= 26 and max(used.values()) <= 10
    # open rooms of 2 and 5: a 2 belongs into the 2
    bins, at, _ = packing.best_fit(np.array([8, 5, 2]), (10,), 0)
    assert bins.tolist() == [0, 1, 0] and at.tolist() == [0, 0, 8]


def test_packing_edge_cases(spark):
    d = docs(spark, [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "a b"), (4, "w " * 20_000)])
    rows = packing.pack(d, sizes=(16, 1000)).collect()
    assert sum(r.length for r in rows) == 20_004 and sum(r.bin_id is None for r in rows) == 2
    assert sum(r.doc_id == 4 for r in rows) == 20 and packing.pack(d.limit(0)).count() == 0
    assert packing.pack(d, length=F.lit(3).cast("int")).where("length = 3").count() == 6


# ---------------------------------------------------------------- URL verdicts

PAGES = "page_id long, url string, html string, host string, verdict string, seed int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", 1) for i, (u, h) in enumerate(rows)], PAGES)


def test_url_rules(spark):
    urls = ["https://A.Example.ORG/es/1?q#f", "http://example.org/en/12", "http://example.org/EN/1", "http://notexample.org/es/", "https://b.com/fr/x",
            "com/fr/x", "x://com/de/#t", "http://example.org", None, "http://h.net?a/b", "http://com:80/fr/1", "http://a.com/de"]
    got = [(r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages(spark, [(u, None) for u in urls])).orderBy("page_id").collect()]
    assert got == [("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
                   ("example.org", "/EN/1", "org/", "allow"), ("notexample.org", "/es/", "org/", "allow"), ("b.com", "/fr/x", "com/fr/", "allow"),
                   ("", "", None, "allow"), ("com", "/de/", "com/de/", "block"), ("example.org", "", None, "allow"), ("", "", None, "allow"),
                   ("h.net", "", None, "allow"), ("com:80", "/fr/1", None, "allow"), ("a.com", "/de", None, "allow")]


def plain_rank(edges, seeds, rounds):
    total = Counter()
    for (s, _), w in edges.items():
        total[s] += w
    rank = {h: 0.15 * x for h, x in seeds.items()}
    for _ in range(rounds):
        new = Counter({h: 0.15 * x for h, x in seeds.items()})
        for (s, d), w in edges.items():
            new[d] += 0.85 * rank.get(s, 0) * w / total[s]
        rank = new
    return rank


def test_url_link_graph(spark):
    a = lambda *hosts: "".join(f'<A class="x" HREF="https://{h}/p">l</A><a href="/own">o</a>' for h in hosts)
    rows = [("http://good.org/1", a("fine.net", "fine.net", "mid.net")), ("http://bad.com/de/1", a("good.org")), ("http://farm.net/1", a("BAD.com", "bad.com")),
            ("http://mid.net/1", a("bad.com", "fine.net")), ("http://fine.net/1", a("good.org")), ("http://lone.net/", None), ("http://far.net/", a("farm.net"))]
    got = {r.host: r for r in url_filter.judge(pages(spark, rows)).collect()}
    edges = Counter()
    for u, h in rows:
        src = re.match("http://([^/]*)", u)[1]
        for dst in re.findall(r'(?i)href="https://([^/]*)', h or ""):
            edges[src, dst.lower()] += 1
    trust = plain_rank(edges, {"good.org": 1.0}, url_filter.ROUNDS)
    distrust = plain_rank({(d, s): w for (s, d), w in edges.items()}, {"bad.com": 1.0}, url_filter.ROUNDS)
    for h, r in got.items():
        assert (r.trust or 0) == pytest.approx(trust.get(h, 0)) and (r.distrust or 0) == pytest.approx(distrust.get(h, 0))
    assert {h: r.verdict for h, r in got.items()} == {"good.org": "allow", "bad.com": "block", "farm.net": "block", "far.net": "block",
                                                     "mid.net": "block" if distrust["mid.net"] > trust["mid.net"] else "allow",
                                                     "fine.net": "allow", "lone.net": "allow"}
    plan = url_filter.judge(pages(spark, rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
    assert url_filter.judge(pages(spark, rows).limit(0)).count() == 0


# ---------------------------------------------------------------- archive records

def test_warc_round_trip(spark, tmp_path):
    source = warc.responses(table(spark, "pages"))
    records = warc.derive(source)
    warc.write_records(records, str(tmp_path / "w"), compression="gzip")
    back = warc.read_records(spark, str(tmp_path / "w")).collect()
    want = {r.record_id: r for r in records.collect()}
    assert len(back) == len(want) == 2 * source.count()
    for r in back:
        w = want[r.record_id]
        assert r.intact and (r.record_type, r.refers_to, r.target_uri, r.block, r.header, r.content_length) == (
            w.record_type, w.refers_to, w.target_uri, w.block, w.header, w.content_length)
        assert w.block_digest == "sha256:" + hashlib.sha256(w.block.encode()).hexdigest()
    sources = {r.record_id: r for r in source.collect()}
    for r in want.values():
        assert want[r.related_id].refers_to == r.refers_to and sources[r.refers_to].payload_digest == r.source_digest


def test_warc_edge_cases(spark):
    rows = [(1, "u", "HTTP/1.1 404 Not Found\r\nX-A: b\r\nContent-Type: TEXT/HTML", "<title>a\n b</title><p>x&amp;y<br>z</p><script>1</script>"),
            (2, "v", "HTTP/1.1 200 OK\r\nContent-Type: image/png", "bytes"), (3, "w", "HTTP/1.1 200 OK\r\ncontent-type: text/plain", "")]
    src = spark.createDataFrame(rows, "source_id long, target_uri string, http string, payload string").selectExpr(
        "*", "'2024' AS date", "concat('r', source_id) AS record_id", "'d' AS payload_digest", "1 AS block")
    got = {(r.source_id, r.record_type): r for r in warc.derive(src).collect()}
    assert set(got) == {(1, "metadata"), (1, "conversion"), (2, "metadata"), (3, "metadata"), (3, "conversion")}
    assert got[1, "conversion"].block == "a b\nx&y\nz" and got[2, "metadata"].related_id is None and got[3, "conversion"].block == ""
    meta = got[1, "metadata"].block.split("\r\n")
    assert meta[:3] == ["status: 404", "title: a b", "outlinks: 0"] and meta[3:] == ["http-X-A: b", "http-Content-Type: TEXT/HTML"]
    nested = [("a<script>'<!--'</script>b", "a b"), ("a<style><script></style>b", "a b"), ("a<!-- <script> -->b", "a b"), ("a<TEMPLATE>x</template >b<noscript>c", "a b"),
              ("&amp;lt; &nbsp;&&copy;&copy &quot;&#39;&", "&lt; &©&copy \"'&")]
    text = [r.block for r in warc.derive(warc.responses(pages(spark, [("u", h) for h, _ in nested]))).where("record_type = 'conversion'").orderBy("source_id").collect()]
    assert text == [t for _, t in nested]
    empty = pages(spark, [(None, None), (None, None)])
    assert warc.derive(warc.responses(empty)).count() == 4 and warc.derive(warc.responses(empty.limit(0))).count() == 0


# ---------------------------------------------------------------- tool calls

def call(body):
    return f"<tool_call>{body}</tool_call>"


TOOLS = (tool_calls.Tool("add", {"x": ("integer", True), "y": ("number", False), "tags": ("array", False), "o": ("object", False), "b": ("boolean", False)}),
         tool_calls.Tool("say", {"t": ("string", True)}))


def test_tool_calls(spark):
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "first " + call('{"name":"add","id":"a","arguments":{"y":1.5,"x":1,"tags":[],"o":{},"b":true}}') + call('{"id":"b","name":"say","arguments":{"t":"é\\n"},"after":["a"]}')),
        (1, 2, "tool", '{"content":{"z":1,"a":[2]},"tool_call_id":"a"}'),
        (1, 3, "tool", '{"tool_call_id":"zz","content":"?"}'),
        (1, 4, "assistant", call('{"id":"c","name":"add","arguments":{"x":"1","q":0},"after":["b","a","nope"]}') + call('{"id":"a","name":"say","arguments":{}}')),
        (1, 5, "tool", "not json"),
        (2, 0, "assistant", call('{"id":"p","name":"say","arguments":{"t":"x"},"after":["q"]}') + call('{"id":"q","name":"say","arguments":{"t":"x"},"after":["p"]}')
         + call('{"id":"r","name":"none","arguments":[1],"after":["q"]}') + call("{bad") + call('{"name":"say","arguments":{"t":"x"}}')),
        (2, 1, "user", None), (None, 0, None, "x"),
    ]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, part int, level string")
    got = {(r.conv_id, r.turn, r.part, r.kind): r for r in tool_calls.link(df, TOOLS).collect()}
    assert len(got) == 6 + 9 + 3
    a, b, c, again = got[1, 1, 1, "call"], got[1, 1, 2, "call"], got[1, 4, 1, "call"], got[1, 4, 2, "call"]
    assert a.json == '{"arguments":{"b":true,"o":{},"tags":[],"x":1,"y":1.5},"id":"a","name":"add"}' and a.valid and a.linked and a.level == 0
    assert b.json == '{"arguments":{"t":"é\\n"},"id":"b","name":"say"}' and b.level == 1 and b.valid and not b.linked
    assert c.errors == "type x;unknown dependency;unknown q" and c.level == 2
    assert again.errors == "duplicate id;missing t" and not again.linked
    assert got[1, 2, 0, "result"].json == '{"content":{"a":[2],"z":1},"role":"tool","tool_call_id":"a"}' and got[1, 2, 0, "result"].linked
    assert got[1, 3, 0, "result"].errors == "no call" and got[1, 5, 0, "result"].errors == "json"
    assert [got[2, 0, i, "call"].errors for i in range(1, 6)] == ["cycle", "cycle", "arguments;cycle", "json", "no id"]
    assert got[2, 0, 1, "call"].level is None and got[2, 0, 4, "call"].call_id is None
    assert got[1, 1, 0, "message"].json == '{"content":"first","role":"assistant"}' and got[2, 1, 0, "message"].json == '{"content":"","role":"user"}'
    assert "Python" not in tool_calls.link(df, TOOLS)._jdf.queryExecution().toString()
    assert tool_calls.link(df.limit(0), TOOLS).count() == 0


def test_tool_calls_long_chain(spark):
    body = "".join(call(f'{{"id":"{i}","name":"say","arguments":{{"t":"{"x" * 2000}"}},"after":[{f"""\"{i - 1}\"""" if i else ""}]}}') for i in range(6))
    df = spark.createDataFrame([(1, 0, "assistant", body)] * 2, "conv_id long, turn long, role string, text string")
    got = tool_calls.link(df, TOOLS).where("kind = 'call'").collect()
    assert Counter((r.call_id, r.level) for r in got) == Counter({(str(i), i): 2 for i in range(6)})


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from cartwheel.llm import decontaminate, language
    d, steps = table(spark, "documents"), []
    for name, stage in p.STAGES:
        d = stage(spark, d, SMALL)
        d = spark.createDataFrame(d.collect(), d.schema)
        steps.append((name, d))
    start = table(spark, "documents")
    by = {n: x for n, x in steps}
    for n, x in steps[:-1]:
        assert x.columns == start.columns
    rows = lambda x: {r.doc_id: r.text for r in x.collect()}
    known = rows(by["language"])
    assert len(known) >= 0.97 * start.count()
    seen, want = set(), set()
    for i, t in sorted(known.items()):
        if low(t) not in seen:
            seen.add(low(t))
            want.add(i)
    assert set(rows(by["exact_copies"])) == want
    exact = rows(by["exact_copies"])
    assert set(rows(by["near_copies"])) == {i for i, (_, c) in plain_components(sorted(exact.items()), 5, 80).items() if i == c}
    near = by["near_copies"]
    dirty = {r.doc_id for r in decontaminate.scan(near, table(spark, "benchmark")).where("contaminated").collect()}
    clean = rows(by["benchmark_leaks"])
    assert set(clean) == set(rows(near)) - dirty
    lengths = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in clean.items()}
    check_packing(by["packing"].collect(), lengths, packing.SIZES)


def test_pipeline_stages_take_odd_tables(spark):
    import corpus_pipeline as p
    odd = docs(spark, [(1, None), (1, None), (None, "a"), (2, ""), (3, "the cat sat on the mat " * 5)])
    for d in (odd, odd.limit(0)):
        for _, stage in p.STAGES:
            out = stage(spark, d, SMALL)
            assert out.count() <= d.count() and (stage is p.packing or out.columns == d.columns)
