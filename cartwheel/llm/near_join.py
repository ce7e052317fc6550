"""Operator 4, n-gram Jaccard self-join by parity sketches.

Each document is the set of its distinct word k-shingles (64-bit hashes).  Two
sets link when ``den * intersection >= num * union``.

* Equal sets form one class (a 128-bit hash); only classes are compared.
* Sets whose sizes may link share a size band.  In a band the shingles are dealt
  by hash into blocks of 2^32 bits, and each shingle flips one bit of its block.
  The Hamming distance of two such sketches is at most the symmetric difference
  of the sets.  A link allows at most ``f(n) = n (den - num) / num`` differences
  for the smaller size n, and a difference spoils one block only.  So take the
  non-empty blocks fullest first (ties in block order): before the first block
  that is equal in both sets stand spoilt blocks only, hence one of the first
  f(n) + 1 is equal in both.  These are the join keys.
* Shingles of a large share of the documents are left out of the sketches.  That
  never raises the difference, so no link is lost, whichever are left out.  A
  set with too few blocks left is also keyed by its first f(n) + 1 single
  shingles, and a set with no more than f(n) shingles left by the blocks of the
  whole set; the same argument holds for both.
* Buckets with the same members are merged.  Links give components, and pairs
  inside one component can't change the result, so they are never formed.  In a
  round each member of a bucket with several components is compared with one
  member, another one each round; as soon as the pairs that remain are few for
  the rows (their number is known without forming them), all are compared.  Of
  large buckets only the pairs whose sketches allow a link become rows: their
  sets are dealt into tiles of bounded size, and each tile holds its sets
  against each other.
* A comparison first holds whole-set parity sketches (about a bit per shingle)
  against the allowed difference; what passes is recomputed from whole texts.

Defined cases: a null text, or one without words, is an empty set, linked with
nothing; fewer than k words are one shingle; ids may repeat (each row has the
component of its own text, and only near copies are dropped); a null id never names a component that has another id;
an empty table gives no rows; other columns are ignored and pass through
``drop_near_copies``.  Classes bear 64 bits of the 128-bit hash as their name."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import U64, bloom_hit, bloom_of, mix, space_words, spread, table, text_bytes, written
from cartwheel.llm.registry import query

HOT_SHARE = 1024  # a shingle of more than 1/1024 of the documents stays out of the sketches
REMAINDER = 8     # all pairs are compared once they are at most so many to a row of the buckets
ROUNDS = 2        # rounds after which they are compared in any case
LARGE = 16        # members above which a bucket's pairs are compared tile by tile
TILE = 512        # sets on either side of a tile
SPARE = 1.5       # blocks of a band to the number that must be equal or not


class Sets:
    """Shingle sets of texts."""

    def __init__(self, k: int):
        self.k, self.hasher = k, space_words()

    def of(self, text: bytes) -> np.ndarray:
        """Sorted distinct shingle hashes of the whole text."""
        buf = np.frombuffer(text.lower(), np.uint8)
        s, e = self.hasher.spans(buf)
        words = self.hasher.words(buf, s, e)
        return np.unique(self.hasher.runs(words, min(self.k, len(words)))) if len(words) else words

    @staticmethod
    def name(shingles: np.ndarray) -> int:
        return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(x: np.ndarray) -> bytes:
    """Parity bits of a whole set; a power of two of them, at least its size."""
    bits = 1 << max(7, int(len(x) - 1).bit_length())
    return np.packbits(np.bincount((x & U64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two sketches; the longer is folded to the other's length,
    which keeps it a parity sketch.  At most the sets' symmetric difference."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):
        a = np.bitwise_xor.reduce(np.frombuffer(a, np.uint8).reshape(-1, len(b)), axis=0).tobytes()
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


class Sketches:
    """Join keys of sets for links of ``num / den`` and more."""

    def __init__(self, num: int, den: int, hot: np.ndarray):
        self.num, self.den = num, den
        # a shingle counts as hot if its low bits do: the sets left out are the same for all documents
        self.hot = np.zeros(1 << 22, bool)
        self.hot[(hot & U64((1 << 22) - 1)).astype(np.int64)] = True
        self.edges = [1]  # band i holds sizes from edges[i] to below edges[i + 1]

    def differences(self, n: int) -> int:
        return n * (self.den - self.num) // self.num

    def _band(self, n: int) -> int:
        while self.edges[-1] <= n:
            e = self.edges[-1]
            self.edges.append(max(e + 1, e * self.den * self.den // (self.num * self.num) + 1))
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def _blocks(self, x: np.ndarray, count: int, salt: int) -> np.ndarray:
        """A key per non-empty block, fullest first; ``x`` is sorted, and so are its blocks."""
        if not len(x):
            return x
        block = ((x >> U64(32)) * U64(count)) >> U64(32)
        first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        # each shingle flips one bit of its block; a block has 2^32 bits, so it is held as
        # the xor of a random code per bit that is set
        parity = np.bitwise_xor.reduceat(mix((x & U64(0xFFFFFFFF)) + U64(1 << 40)), first)
        size = np.diff(np.append(first, len(x))).astype(U64)
        order = np.argsort(-size.astype(np.int64), kind="stable")
        return mix(parity ^ mix((block[first] << U64(20)) + size + U64(salt << 44)))[order]

    def keys(self, x: np.ndarray) -> np.ndarray:
        """All join keys of the set ``x``."""
        n = len(x)
        if n == 0:
            return x
        rare = x[~self.hot[(x & U64((1 << 22) - 1)).astype(np.int64)]]
        out = []
        for band in range(self._band(-(-n * self.num // self.den)), self._band(n) + 1):
            top = self.edges[band + 1] - 1
            d = min(self.differences(n), self.differences(top))
            if d == 0:
                continue  # only equal sets link
            count = int(SPARE * (self.differences(top) + 1)) + 1
            for salt, tokens in ((2, rare), (3, x)):
                blocks = self._blocks(tokens, count, band * 8 + salt)
                out.append(blocks[:d + 1])
                if len(blocks) > d:
                    break
                out.append(mix(tokens[:d + 1] ^ mix(np.full(1, (band * 8 + salt + 4) << 44, U64))))
                if len(tokens) > d:
                    break
        return np.concatenate(out) if out else x[:0]


def _profile(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, n, sid, sk) per row; sk, the sketch, only at the first copy of a
    batch.  Rows with ``hot`` set count frequent shingles instead."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        sets = Sets(k)
        for b in batches:
            found = [sets.of(t) for t in text_bytes(b.column(1))]
            n, sid = np.array([len(x) for x in found], np.int64), np.array([sets.name(x) for x in found], np.int64)
            # each text once, so that a large group of copies doesn't make its shingles frequent
            own = {s: i for i, s in reversed(list(enumerate(sid.tolist())))}
            sk = [sketch(x) if own[i] == j and len(x) else None for j, (i, x) in enumerate(zip(sid.tolist(), found))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(sid), pa.array(sk, pa.binary()), pa.nulls(len(n), pa.int64())], names)
            h, c = np.unique(np.concatenate([found[i] for i in own.values()]), return_counts=True) if own else (np.zeros(0, U64), np.zeros(0, int))
            often = c >= max(4, len(found) // (2 * HOT_SHARE))
            h, c = h[often], c[often]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(h), b.schema.field(0).type), pa.array(c.astype(np.int64)), pa.nulls(len(h), pa.int64()),
                                              pa.nulls(len(h), pa.binary()), pa.array(h.view(np.int64))], names)

    names = ["id", "n", "sid", "sk", "hot"]
    return rows.mapInArrow(run, f"id {kind}, n long, sid long, sk binary, hot long")


def _keys(docs: DataFrame, text_col: str, k: int, num: int, den: int, hot: np.ndarray) -> DataFrame:
    """(bkey, sid) for all sets; copies inside a batch once."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]):
        sets, sketches = Sets(k), Sketches(num, den, shared.value)
        for b in batches:
            done, keys, sids = set(), [], []
            for t in text_bytes(b.column(0)):
                x = sets.of(t)
                sid = sets.name(x)
                if sid not in done:
                    done.add(sid)
                    keys.append(sketches.keys(x))
                    sids.append(np.full(len(keys[-1]), sid, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sids))],
                                                 ["bkey", "sid"])

    return docs.select(F.col(text_col).alias("txt")).mapInArrow(run, "bkey long, sid long")


def _buckets(keys: DataFrame) -> DataFrame:
    """(bucket, sid, low, high, w): keys of two or more sets, those with the
    same members merged; w counts them."""
    over = "OVER (PARTITION BY bkey)"
    shared = (keys.selectExpr("sid", f"min(sid) {over} AS low", f"max(sid) {over} AS high",
                              f"count(1) {over} AS c", f"bit_xor(xxhash64(sid)) {over} AS members")
              .where("low <> high"))
    return (shared.groupBy(F.xxhash64("members", "c", "low", "high").alias("bucket"), "sid", "low", "high")
            .agg(F.count("*").alias("w")))


def _plausible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sketches allow a link."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            keep = [hamming(x, y) <= (n + m) * (den - num) // (den + num)
                    for x, y, n, m in zip(*(b.column(i).to_pylist() for i in range(2, 6)))]
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one, two = (sets.select(F.col("sid").alias(s), F.col("n").alias(f"n{s}"), F.col("sk").alias(f"s{s}")) for s in ("a", "b"))
    both = pairs.join(one, "a").join(two, "b").where(f"least(na, nb) * {den} >= greatest(na, nb) * {num}")
    return both.select("a", "b", "sa", "sb", "na", "nb").mapInArrow(run, "a long, b long")


def _verified(docs: DataFrame, text_col: str, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that link, compared over their whole texts."""
    both = pairs.select(F.col("a").alias("sid")).distinct().union(pairs.select("b").distinct()).distinct()
    shared = docs.sparkSession.sparkContext.broadcast(bloom_of(both, "sid"))

    def texts(batches: Iterator[pa.RecordBatch]):
        sets = Sets(k)
        for b in batches:
            own = {sets.name(sets.of(t)): t for t in text_bytes(b.column(0))}
            sids = np.fromiter(own, np.int64, len(own))
            keep = bloom_hit(shared.value, sids)
            yield pa.RecordBatch.from_arrays([pa.array(sids[keep]), pa.array([t for t, x in zip(own.values(), keep) if x], pa.binary())],
                                             ["sid", "txt"])

    def compare(batches: Iterator[pa.RecordBatch]):
        sets = Sets(k)
        for b in batches:
            links = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = sets.of(x), sets.of(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                links.append(den * common >= num * (len(x) + len(y) - common))
            yield b.select([0, 1]).filter(pa.array(links, pa.bool_()))

    found = docs.select(F.col(text_col).alias("txt")).mapInArrow(texts, "sid long, txt binary")
    found = written(found.dropDuplicates(["sid"]))
    one, two = (found.select(F.col("sid").alias(s), F.col("txt").alias(f"t{s}")) for s in ("a", "b"))
    return (pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb")
            .mapInArrow(compare, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the graph with ``edges`` (a, b): root is the smallest
    node of the component.  Every node points to its smallest neighbour,
    pointers are doubled until they end, and the graph shrinks to the roots,
    until no edge is left: a logarithmic number of rounds."""
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    total = None
    while not edges.isEmpty():
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = written(sides.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
        while True:
            up = to.select(F.col("node").alias("root"), F.col("root").alias("next"))
            to = written(to.select("node", "root").join(up, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
            if to.where("moved").isEmpty():
                break
        to = to.select("node", "root")
        if total is None:
            total = to
        else:
            up = to.select(F.col("node").alias("root"), F.col("root").alias("next"))
            total = written(total.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        a, b = to.toDF("a", "ra"), to.toDF("b", "rb")
        edges = written(edges.join(a, "a").join(b, "b").where("ra <> rb")
                        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    return edges.toDF("node", "root") if total is None else total


def _one_each(rows: DataFrame, turn: int) -> DataFrame:
    """(a, b): each set with one member of each of its buckets that lies in
    another component; for a set the four that it meets most often."""
    pivot = rows.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("sid", F.lit(turn)), "sid", "root")).alias("p"))
    met = (rows.join(pivot.select("bucket", F.col("p.sid").alias("end"), F.col("p.root").alias("end_root")), "bucket")
           .where("root <> end_root").groupBy("sid", "end").agg(F.sum("w").alias("w")))
    best = met.groupBy("sid").agg(F.slice(F.sort_array(F.collect_list(F.struct("w", "end")), False), 1, 4).alias("x"))
    best = best.select("sid", F.explode("x.end").alias("end"))
    return best.select(F.least("sid", "end").alias("a"), F.greatest("sid", "end").alias("b")).distinct()


def _all_across(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs of a bucket of at most LARGE members that lie in different
    components and whose sketches allow a link."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = set()
            for bucket in b.column(0).to_pylist():
                for i, x in enumerate(bucket):
                    for y in bucket[:i]:
                        n, m = x["n"], y["n"]
                        if x["root"] != y["root"] and den * min(n, m) >= num * max(n, m) \
                                and hamming(x["sk"], y["sk"]) <= (n + m) * (den - num) // (den + num):
                            found.add((min(x["sid"], y["sid"]), max(x["sid"], y["sid"])))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    full = rows.select("bucket", "sid", "root").join(sets.select("sid", "n", "sk"), "sid")
    return (full.groupBy("bucket").agg(F.collect_list(F.struct("sid", "root", "n", "sk")).alias("x")).select("x")
            .mapInArrow(run, "a long, b long"))


def _tiles(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs of a bucket in different components whose sketches allow a
    link.  Sets are dealt to c parts, and tile (i, j) holds parts i and j."""
    own = written(rows.groupBy("sid").agg(F.max("root").alias("root"), F.collect_set("bucket").alias("buckets"))
                  .join(sets.select("sid", "n", "sk"), "sid"))
    c = max(1, -(-own.count() // TILE))
    j = F.explode(F.sequence(F.lit(0), F.lit(c - 1)))
    dealt = own.withColumn("part", spread(c, "sid")).withColumn("j", j).withColumn(
        "tile", F.least("part", "j") * c + F.greatest("part", "j")).drop("j")

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        low, high = divmod(int(tile["tile"].iloc[0]), c)
        x, y = tile[tile["part"] == low], tile[tile["part"] == high]
        names = {v: i for i, v in enumerate(set(np.concatenate(tile["buckets"].to_list())))}

        def member(side):
            m = np.zeros((len(side), len(names)), np.float32)
            for i, own in enumerate(side["buckets"]):
                m[i, [names[v] for v in own]] = 1
            return m

        n, m = x["n"].to_numpy()[:, None], y["n"].to_numpy()[None, :]
        open_ = (member(x) @ member(y).T > 0) & (x["root"].to_numpy()[:, None] != y["root"].to_numpy()[None, :])
        open_ &= np.minimum(n, m) * den >= np.maximum(n, m) * num
        if low == high:
            open_ = np.triu(open_, 1)
        limit = (n + m) * (den - num) // (den + num)
        sx, sy, ix, iy = x["sk"].to_list(), y["sk"].to_list(), x["sid"].to_numpy(), y["sid"].to_numpy()
        found = [(ix[i], iy[k]) for i, k in zip(*np.nonzero(open_)) if hamming(sx[i], sy[k]) <= limit[i, k]]
        return pd.DataFrame({"a": np.array([min(f) for f in found], np.int64), "b": np.array([max(f) for f in found], np.int64)})

    return dealt.groupBy("tile").applyInPandas(compare, "a long, b long")


def _labels(docs: DataFrame, text_col: str, buckets: DataFrame, sets: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(node, root) of the sets that have links."""
    labels, rows = None, buckets.withColumn("root", F.col("sid"))
    for turn in range(ROUNDS + 1):
        counts = rows.groupBy("bucket", "root").agg(F.count("*").alias("c"))
        mixed = counts.groupBy("bucket").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("q"), F.count("*").alias("roots")).where("roots > 1")
        mixed = written(mixed.select("bucket", ((F.col("c") * F.col("c") - F.col("q")) / 2).alias("left"), "c"))
        size = mixed.agg(F.sum("left").alias("left"), F.sum("c").alias("c")).first()
        if not size.left:
            break
        rows = written(rows.join(mixed.select("bucket"), "bucket", "left_semi"))
        last = turn == ROUNDS or size.left <= REMAINDER * size.c
        if last:
            large = mixed.where(F.col("c") > LARGE).select("bucket")
            close = _all_across(rows.join(large, "bucket", "left_anti"), sets, num, den)
            close = written(close.unionByName(_tiles(rows.join(large, "bucket", "left_semi"), sets, num, den)).distinct())
        else:
            close = written(_plausible(written(_one_each(rows, turn)), sets, num, den))
        links = written(_verified(docs, text_col, close, k, num, den)) if not close.isEmpty() else close
        if not links.isEmpty():
            if labels is not None:  # links between the components found so far
                links = (links.join(labels.toDF("a", "ra"), "a", "left").join(labels.toDF("b", "rb"), "b", "left")
                         .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
            joined = components(links)
            if labels is None:
                labels = joined
            else:
                old = labels.join(joined.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
                labels = written(old.unionByName(joined.join(labels, "node", "left_anti")))
        if last:
            break
        if not links.isEmpty():
            rows = (rows.withColumnRenamed("root", "old").join(joined.toDF("old", "next"), "old", "left")
                    .withColumn("root", F.coalesce("next", "old")).drop("old", "next"))
    return buckets.selectExpr("sid AS node", "sid AS root").limit(0) if labels is None else labels


def _named(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(id, sid, n, component_id), one row per row of ``docs``."""
    profile = written(_profile(docs, id_col, text_col, k))
    rows = profile.where("hot is null")
    often = profile.where("hot is not null").groupBy("hot").agg(F.sum("n").alias("c"))
    # at most HOT_SHARE times the mean set size of them can exist
    hot = often.where(F.col("c") * HOT_SHARE > rows.count()).select("hot").toPandas()["hot"].to_numpy(np.int64).view(U64)
    sets = written(rows.where("n > 0").groupBy("sid").agg(F.min("id").alias("first"), F.max("n").alias("n"), F.max("sk").alias("sk")))
    buckets = written(_buckets(_keys(docs, text_col, k, num, den, hot)).drop("low", "high"))
    labels = _labels(docs, text_col, buckets, sets, k, num, den)
    sets = written(sets.join(labels.toDF("sid", "root"), "sid", "left").select("sid", F.coalesce("root", "sid").alias("root"), "first"))
    smallest = written(sets.groupBy("root").agg(F.min("first").alias("component_id")))
    named = written(sets.join(smallest, "root").select("sid", "component_id"))
    return (rows.join(named, "sid", "left")
            .select("id", "sid", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))


def link_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id
    reachable by links of similarity ``num / den`` and more, its own included)."""
    return _named(docs, k, num, den, id_col, text_col).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` with the smallest id of each component; columns unchanged.
    Rows with a null id stay.  Of a repeated id only the near copies go."""
    found = _named(docs, k, num, den, id_col, text_col).where("id is not null")
    copy = F.col("component_id") != F.col("id")
    lost = written(found.groupBy(F.col("id").alias("_lost")).agg(F.bool_and(copy).alias("_whole"), F.collect_set(F.when(copy, F.col("sid"))).alias("_sets"))
                   .where(F.size("_sets") > 0))
    kept = docs.join(lost, docs[id_col] == F.col("_lost"), "left_anti")
    mixed = lost.where(~F.col("_whole"))
    if mixed.isEmpty():
        return kept

    # ids that have a near copy and another text: by the set of each row
    both = docs.join(mixed, docs[id_col] == F.col("_lost")).drop("_lost", "_whole")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]):
        sets = Sets(k)
        for b in batches:
            stays = [sets.name(sets.of(t)) not in own for t, own in zip(text_bytes(b.column(at)), b.column(b.num_columns - 1).to_pylist())]
            yield b.select(range(b.num_columns - 1)).filter(pa.array(stays, pa.bool_()))

    return kept.unionByName(both.mapInArrow(run, docs.schema))


@query("op4_near_join")
def op4(spark, sf_dir):
    """Components of all documents: 4-word shingles, similarity 0.85."""
    return link_components(table(spark, sf_dir, "documents"), k=4, num=85)
