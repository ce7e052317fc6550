"""Operator 1, language identification with language-bitmask n-gram filters.

Training counts the letter n-grams of labelled texts per language.  An n-gram
belongs to every language in which its rate is at least ``dominance`` times the
highest rate of any language.  The languages' Bloom filters are stored bit by
bit next to each other: slot ``p`` holds one mask with a bit per language, so
``slot[p1] & slot[p2] & slot[p3]`` answers for all languages of a table at once.
Languages share a table when they need about as many slots; a table has enough
of them, by the counted n-grams of the sample, to stay at most half full.

A text's n-grams are looked up, the set bits are counted per language, and each
count is corrected by the language's false-positive rate (its share of set
slots to the power of the number of hashes).  The largest count decides; ties
go to the language that sorts first.

Defined cases: a null text, or one without letters, gives ``und`` and score 0;
a text with letters but no known n-gram gives the language with most training
n-grams and score 0; with no training rows at all every text gives ``und``.
Rows with a null label or id aren't learned from.  Other columns are ignored by
``identify`` and pass through ``keep_known``."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import U64, mix, table
from cartwheel.llm.registry import query

SIZES = (3, 4)          # n-gram lengths in characters
SLOTS = 1 << 20         # least slots of a table
HASHES = 3
ROOM = 4.4              # slots for each n-gram: 1 - exp(-3 / 4.4) is just below one half
TRAIN_CHARS = 60_000_000  # bound of the training sample, in characters
DOMINANCE = 0.2
PER_TABLE = 32          # languages to a mask
COUNTED_GRAMS = 1 << 21  # n-grams that a task holds before it counts them
CHUNK = 1 << 12         # bits of a table that are filled together


def letter_table() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all other characters."""
    low = np.zeros(0x110000, np.uint32)
    for c in range(0x40000):  # all scripts lie in the first planes
        if chr(c).isalpha():
            low[c] = ord(chr(c).lower()[0])
    return low


def grams(text: str | None, letters: np.ndarray, sizes: tuple[int, ...] = SIZES) -> tuple[np.ndarray, bool]:
    """Hashes of the n-grams inside words (one blank on either side counts),
    and whether the text has a letter at all."""
    if not text:
        return np.zeros(0, U64), False
    code = letters[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    code = np.concatenate((np.zeros(1, np.uint32), code, np.zeros(1, np.uint32)))
    gap = code == 0
    if gap.all():
        return np.zeros(0, U64), False
    code = code[~(gap & np.concatenate(([False], gap[:-1])))].astype(U64)
    gap = code == 0
    out = []
    for n in sizes:
        m = len(code) - n + 1
        if m <= 0:
            continue
        h, inner = np.zeros(m, U64), np.zeros(m, bool)
        for j in range(n):
            h = h * U64(0x100000001B3) + code[j:j + m]
            if 0 < j < n - 1:
                inner |= gap[j:j + m]
        out.append(mix(h[~inner] + U64(n << 56)))
    return np.concatenate(out) if out else np.zeros(0, U64), True


@dataclass
class SlotTable:
    """``slots`` masks of ``width`` bits, packed; bit ``b`` is language ``own[b]``."""

    own: list[int]
    slots: int
    width: int
    packed: np.ndarray

    def fill(self, b: int) -> float:
        """Share of the slots in which language ``own[b]`` is set."""
        bits = sum(1 << x for x in range(b % 8, 8, min(8, self.width)))
        return int(np.bitwise_count(self.packed[b // 8::max(1, self.width // 8)] & np.uint8(bits)).sum()) / self.slots

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash, the mask of the languages that hold it."""
        m = np.full(len(hashes), (1 << self.width) - 1, U64)
        for j in range(HASHES):
            at = ((hashes & U64(0xFFFFFFFF)) + U64(j) * (hashes >> U64(32) | U64(1))) % U64(self.slots)
            if self.width < 8:
                bit = at * U64(self.width)
                m &= self.packed[(bit >> U64(3)).astype(np.int64)] >> (bit & U64(7))
            else:
                m &= self.packed.view(f"<u{self.width // 8}")[at.astype(np.int64)]
        return m


def slot_tables(distinct: list[int]) -> list[SlotTable]:
    """Empty tables for languages with so many distinct n-grams."""
    by: dict[int, list[int]] = {}
    for i, n in enumerate(distinct):
        by.setdefault(max(0, int(np.ceil(np.log2(max(1, n) * ROOM / SLOTS)))), []).append(i)
    out = []
    for alike in by.values():
        for own in (alike[x:x + PER_TABLE] for x in range(0, len(alike), PER_TABLE)):
            slots = -(-max(SLOTS, int(max(distinct[i] for i in own) * ROOM)) // 8) * 8
            width = 1 << (len(own) - 1).bit_length()
            out.append(SlotTable(own, slots, width, np.zeros(slots * width // 8, np.uint8)))
    return out


@dataclass
class LanguageFilter:
    """Bit-sliced filters of ``langs`` in ``tables``."""

    langs: list[str]
    tables: list[SlotTable]
    false_rate: np.ndarray
    fallback: str
    letters: np.ndarray

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Per language, the n-grams that its filter holds, corrected."""
        hits = np.zeros(len(self.langs))
        for t in self.tables:
            m = t.masks(hashes)
            for b, i in enumerate(t.own):
                hits[i] = int(((m >> U64(b)) & U64(1)).sum())
        return np.maximum(0, (hits - len(hashes) * self.false_rate) / (1 - self.false_rate))

    def decide(self, text: str | None) -> tuple[str, float, float]:
        """Language, share of the counted evidence, share of the text's n-grams."""
        hashes, any_letter = grams(text, self.letters)
        if not any_letter or not self.langs:
            return "und", 0.0, 0.0
        c = self.counts(hashes)
        if not c.any():
            return self.fallback, 0.0, 0.0
        best = int(c.argmax())
        return self.langs[best], float(c[best] / c.sum()), float(min(1.0, c[best] / len(hashes)))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", train_chars: int = TRAIN_CHARS,
          dominance: float = DOMINANCE) -> LanguageFilter:
    """Filters learned from a bounded sample (``train_chars`` characters,
    drawn by a hash of the text; all of it when there is less)."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("txt")).where("lang is not null and txt is not null")
    total = rows.agg(F.sum(F.length("txt"))).first()[0] or 0
    if total > train_chars:
        rows = rows.where(F.pmod(F.xxhash64("txt"), F.lit(1 << 30)) < int((1 << 30) * train_chars / total))

    letters = letter_table()
    shared = docs.sparkSession.sparkContext.broadcast(letters)

    def counted(by: dict[str, list[np.ndarray]]):
        for lang, parts in by.items():
            h, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(n)],
                                             ["lang", "h", "n"])

    def count(batches: Iterator[pa.RecordBatch]):
        by: dict[str, list[np.ndarray]] = {}
        held = 0
        for b in batches:
            for lang, text in zip(b.column(0), b.column(1)):
                found = grams(text.as_py(), shared.value)[0]
                by.setdefault(lang.as_py(), []).append(found)
                held += len(found)
                if held > COUNTED_GRAMS:
                    yield from counted(by)
                    by, held = {}, 0
        yield from counted(by)

    seen = rows.mapInArrow(count, "lang string, h long, n long").groupBy("h", "lang").agg(F.sum("n").alias("n")).persist()
    found = {r.lang: r for r in seen.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).collect()}
    totals = {x: r.n for x, r in found.items()}
    langs = sorted(totals)
    tables = slot_tables([found[x].distinct for x in langs])
    false_rate = np.zeros(len(langs))
    if langs:
        place = {i: (k, b) for k, t in enumerate(tables) for b, i in enumerate(t.own)}
        scale = docs.sparkSession.createDataFrame(
            [(x, *place[i], tables[place[i][0]].slots, tables[place[i][0]].width, totals[x]) for i, x in enumerate(langs)],
            "lang string, k int, b int, slots long, width int, total long")
        rate = seen.join(F.broadcast(scale), "lang").withColumn("rate", F.col("n") / F.col("total"))
        top = rate.groupBy("h").agg(F.max("rate").alias("top"), F.collect_list(F.struct("k", "b", "slots", "width", "rate")).alias("by"))
        member = top.select("h", "top", F.explode("by").alias("x")).where(F.col("x.rate") >= dominance * F.col("top")).select("h", "x.*")
        at = F.explode(F.array(*[F.expr(f"((h & 4294967295L) + {j}L * (shiftrightunsigned(h, 32) | 1L)) % slots * width + b")
                                 for j in range(HASHES)]))
        bits = member.select("k", at.alias("at")).select("k", F.expr(f"at div {CHUNK}").alias("chunk"), (F.col("at") % CHUNK).cast("int").alias("bit"))

        def pack(batches: Iterator[pa.RecordBatch]):
            chunks: dict[int, np.ndarray] = {}
            for b in batches:
                name = b.column(0).to_numpy().astype(np.int64) << 40 | b.column(1).to_numpy()
                bit, order = b.column(2).to_numpy(), np.argsort(name, kind="stable")
                names, first = np.unique(name[order], return_index=True)
                for v, own in zip(names.tolist(), np.split(bit[order], first[1:])):
                    into = chunks.setdefault(v, np.zeros(CHUNK // 8, np.uint8))
                    np.bitwise_or.at(into, own >> 3, (1 << (own & 7)).astype(np.uint8))
            if chunks:
                yield pa.RecordBatch.from_arrays([pa.array([v >> 40 for v in chunks], pa.int32()), pa.array([v & (1 << 40) - 1 for v in chunks], pa.int64()),
                                                  pa.array([x.tobytes() for x in chunks.values()], pa.binary())], ["k", "chunk", "part"])

        for r in bits.repartition("k", "chunk").mapInArrow(pack, "k int, chunk long, part binary").toLocalIterator():
            into = tables[r.k].packed[r.chunk * CHUNK // 8:][:CHUNK // 8]
            into[:] = np.frombuffer(r.part, np.uint8)[:len(into)]
        for t in tables:
            for b, i in enumerate(t.own):
                false_rate[i] = t.fill(b) ** HASHES
    seen.unpersist()
    return LanguageFilter(langs, tables, false_rate, max(langs, key=lambda x: (totals[x], x), default="und"), letters)


def identify(docs: DataFrame, model: LanguageFilter, text_col: str = "text", into: str = "") -> DataFrame:
    """``docs`` with lang_pred, score and coverage of every whole text added."""
    shared, at = docs.sparkSession.sparkContext.broadcast(vars(model)), docs.columns.index(text_col)
    added = [T.StructField(f"{into}lang_pred", T.StringType()), T.StructField(f"{into}score", T.DoubleType()),
             T.StructField(f"{into}coverage", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]):
        model = LanguageFilter(**shared.value)
        for b in batches:
            got = [model.decide(t) for t in b.column(at).to_pylist()]
            cols = [pa.array([g[i] for g in got], k) for i, k in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Documents that training never sees: crc32(id) mod 4 is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               min_coverage: float = 0.2) -> DataFrame:
    """``docs`` without texts that have no letter, or of whose n-grams no
    language holds ``min_coverage``.  Columns are unchanged.

    A text never vouches for itself: ids are dealt to two halves by crc32, and
    each half is judged by filters that were learned from the other (held-out
    rows and null ids are in no training).  Copies under another id do count."""
    half = F.coalesce(F.pmod(F.shiftrightunsigned(F.crc32(F.col(id_col).cast("string").cast("binary")), 2), F.lit(2)), F.lit(0)).cast("int")
    learn = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
    models = [vars(train(learn.where(half != k), text_col, lang_col)) for k in (0, 1)]
    models[1]["letters"] = models[0]["letters"]  # sent once
    names = docs.columns
    shared, at = docs.sparkSession.sparkContext.broadcast(models), names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]):
        models = [LanguageFilter(**m) for m in shared.value]
        for b in batches:
            got = [models[k].decide(t) for t, k in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist())]
            kept = b.filter(pa.array([g[0] != "und" and g[2] >= min_coverage for g in got], pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], names=names)

    return docs.select("*", half.alias("half of " + id_col)).mapInArrow(run, docs.schema)


@query("op1_language")
def op1(spark, sf_dir):
    """Language of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "coverage")
