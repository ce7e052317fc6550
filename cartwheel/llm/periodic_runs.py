"""Operator 13, periodic runs: online dyadic square catching over the words of
a text.

A run is a longest stretch of words with smallest period ``q`` (words ``q``
apart are equal) that is at least ``max(min_length, 2 * q)`` words long.

``SquareCatcher`` reads words in pieces of any size.  Every completed block of
``2^k`` words that starts at a multiple of ``2^k`` becomes a catcher for the
periods from ``2 * 2^k`` to ``4 * 2^k - 1`` (the least level also has the
shorter ones): each appended word completes one suffix of ``2^k`` words, which
is compared with the two blocks that lie in this distance.  A suffix that
equals a block is a stretch that repeats at their distance; adjacent stretches
of one distance are joined, grown to both sides by halving steps, and reported
as a square once they are long enough.  Squares of one stretch merge into its
run; the smallest distance is its period.  A stretch of a run's least length
holds a whole block, so none is missed.  Comparisons use hashes of words' runs
from prefix sums; every run is compared word by word before it is returned,
and a distance at which that fails is searched word by word.

Time is O(n log n) and memory O(n) for a text of n words; texts are
independent, so nothing is shuffled.

Defined cases: a null or empty text has no words, no runs and an empty
collapsed text; a null id passes through; repeated rows are treated alike; an
empty table gives no rows; other columns, whatever their names, are ignored."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import U64, mix, table, text_bytes
from cartwheel.llm.registry import query

MIN_LENGTH = 12
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BASE = 0x9E3779B97F4A7C15
RUN = T.StructType([T.StructField(f, T.LongType()) for f in ("start", "length", "period")])


class Powers:
    """Powers of the hash base and of its inverse, grown when a longer text comes."""

    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def room(self, n: int):
        if n >= len(self.up):
            for name, factor in (("up", BASE), ("down", self.INVERSE)):
                steps = np.full(2 * n + 1, factor, U64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


POWERS = Powers()


class SquareCatcher:
    """Periodic runs of a growing sequence of numbered words."""

    def __init__(self, min_length: int = MIN_LENGTH):
        self.min_length = max(2, min_length)
        # the shortest stretch to catch has half the least length; a block of b lies in any 2b - 1 words
        self.least = ((self.min_length + 1) // 2 + 1).bit_length() - 2
        self.n = 0
        self.ids, self.sums = np.zeros(0, np.int64), np.zeros(1, U64)
        self.caught: dict[int, list[tuple[int, int]]] = {}  # distance -> stretches that are long enough or still grow

    def _room(self, n: int):
        if n > len(self.ids):
            size = n if not self.n else 2 * n
            self.ids = np.concatenate((self.ids[:self.n], np.zeros(size - self.n, np.int64)))
            self.sums = np.concatenate((self.sums[:self.n + 1], np.zeros(size - self.n, U64)))
        POWERS.room(n)

    def _hash(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each place."""
        return (self.sums[at + size] - self.sums[at]) * POWERS.down[at]

    def append(self, words: np.ndarray):
        """Read more words (as numbers; equal words have equal numbers)."""
        if not len(words):
            return
        old, n = self.n, self.n + len(words)
        self._room(n)
        self.ids[old:n] = words
        value = mix((words.astype(np.int64).view(U64) + U64(1)) * U64(BASE)) * POWERS.up[old:n]
        value[:1] += self.sums[old:old + 1]
        np.cumsum(value, out=self.sums[old + 1:n + 1])
        self.n = n
        level = self.least
        while (1 << level) < n and (level == self.least or 2 << level <= n // 2):
            self._advance(level, old)
            level += 1

    def _advance(self, level: int, old: int):
        """Compare the suffixes of ``2^level`` words completed since ``old`` with their catchers."""
        size, n = 1 << level, self.n
        low = 1 if level == self.least else 2 * size
        first, end = max(low, old - size + 1), n - size + 1
        if first >= end:
            return
        suffix = (self.sums[first + size:end + size] - self.sums[first:end]) * POWERS.down[first:end]
        at = np.arange(first, end)
        own = at >> level
        lowest = max(0, int(own[0]) - 3)
        block = self._hash(np.arange(lowest, int(own[-1]) + 1) << level, size)
        starts, distances = [], []
        for back in range(0 if low == 1 else 2, 4):
            b = own - back
            hit = np.flatnonzero((block[np.maximum(b - lowest, 0)] == suffix) & (b >= 0))
            if len(hit):
                s = b[hit] << level
                d = at[hit] - s
                starts.append(s[d >= low])
                distances.append(d[d >= low])
        if starts:
            self._join(np.concatenate(starts), np.concatenate(distances), size, old)

    def _join(self, s: np.ndarray, d: np.ndarray, size: int, old: int):
        """Join caught blocks of one distance, grow them to both sides, and keep the stretches."""
        if not len(s):
            return
        order = np.lexsort((s, d))
        s, d = s[order], d[order]
        new = np.ones(len(s), bool)
        new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1] + size)
        first = np.flatnonzero(new)
        left, dist = s[first], d[first]
        right = s[np.append(first[1:], len(s)) - 1] + size
        # within one piece a stretch ends before its next block; one that began in an earlier piece may be of any length
        top = (size if old == 0 else self.n).bit_length() - (old == 0)
        for step in (1 << j for j in range(top - 1, -1, -1)):
            ok = left >= step
            at = np.where(ok, left - step, 0)
            ok &= self._hash(at, step) == self._hash(np.where(ok, at + dist, 0), step)
            left = np.where(ok, left - step, left)
            ok = right + dist + step <= self.n
            at = np.where(ok, right, 0)
            ok &= self._hash(at, step) == self._hash(np.where(ok, at + dist, 0), step)
            right = np.where(ok, right + step, right)
        keep = (right - left >= np.maximum(dist, self.min_length - dist)) | (right + dist == self.n)
        for k in np.flatnonzero(keep).tolist():
            self.caught.setdefault(int(dist[k]), []).append((int(left[k]), int(right[k])))

    def runs(self) -> np.ndarray:
        """(start, length, period) of the runs of all words read, by start, then period."""
        found = self._merged({d: self._grown(v, d) for d, v in self.caught.items()})
        ids = self.ids
        if not all(np.array_equal(ids[a:a + n - d], ids[a + d:a + n]) for (a, n), d in found.items()):
            found = self._merged({d: self._plain(d) for d in self.caught})  # two words' runs with one hash
        return np.array(sorted((a, d, n) for (a, n), d in found.items()), np.int64).reshape(-1, 3)[:, [0, 2, 1]]

    def _merged(self, stretches: dict[int, list[tuple[int, int]]]) -> dict[tuple[int, int], int]:
        """(start, length) of each run with its smallest distance: multiples of a
        period repeat in exactly its run."""
        found: dict[tuple[int, int], int] = {}
        for d in sorted(stretches):
            for a, z in stretches[d]:
                if z - a >= max(d, self.min_length - d):
                    found.setdefault((a, z + d - a), d)
        return found

    def _grown(self, stretches: list[tuple[int, int]], d: int) -> list[tuple[int, int]]:
        """Stretches caught before later words came, up to their present ends, joined."""
        joined: list[tuple[int, int]] = []
        for a, z in sorted(stretches):
            if joined and a <= joined[-1][1]:
                a = joined[-1][0]
                z = max(z, joined.pop()[1])
            while z + d < self.n and self.ids[z] == self.ids[z + d]:
                z += 1
            joined.append((a, z))
        return joined

    def _plain(self, d: int) -> list[tuple[int, int]]:
        """All stretches of one distance, word by word."""
        same = np.concatenate(([0], (self.ids[:self.n - d] == self.ids[d:self.n]).view(np.int8), [0]))
        edge = np.flatnonzero(np.diff(same))
        return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def runs_of(words: list[bytes], min_length: int = MIN_LENGTH) -> np.ndarray:
    """(start, length, period) of the runs of one text's words."""
    if len(words) < min_length:
        return np.zeros((0, 3), np.int64)
    catcher = SquareCatcher(min_length)
    catcher.append(numbered(words))
    return catcher.runs()


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: all but those of a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per row of ``docs``: id, n_words, runs (start, length, period in
    words, by start, then period), collapsed (the kept words, one space between)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("txt"))
    schema = T.StructType([rows.schema["id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            counts, offsets, flat, left = [], [0], [], []
            for text in text_bytes(b.column(1)):
                words = WORD.findall(text)
                found = runs_of(words, min_length)
                counts.append(len(words))
                offsets.append(offsets[-1] + len(found))
                if len(found):
                    flat.append(found)
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), found))]
                left.append(b" ".join(words).decode("utf-8", "replace"))
            every = np.concatenate(flat) if flat else np.zeros((0, 3), np.int64)
            parts = pa.StructArray.from_arrays([pa.array(every[:, i].copy()) for i in range(3)], names=RUN.names)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts), pa.array(left, pa.string())],
                ["id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_col)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``; in a tenth of the rows, chosen by crc32 of
    the id, the words from one place on repeat with a period."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def rewrite(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = b.column(1).to_pylist() if b.num_rows else []
            for i, key in enumerate(b.column(0).to_pylist()):
                h = 1 if key is None else zlib.crc32(str(key).encode())
                words = WORD.findall((texts[i] or "").encode()) if h % 10 == 0 else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[i] = b" ".join(words[:a] + [words[a + (j - a) % p] for j in range(a, n)]).decode()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, b.column(1).type)], ["doc_id", "text"])

    return rows.mapInArrow(rewrite, rows.schema)


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    """Runs of all documents, with repeats planted by rule, as digests."""
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    first = lambda a, r: (a.isNull() | (r["length"] > a["length"]))  # noqa: E731  by start, then period, so that ties keep the first
    none = F.lit(None).cast(RUN)
    best = F.aggregate("runs", none, lambda a, r: F.when(first(a, r), r).otherwise(a))
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
