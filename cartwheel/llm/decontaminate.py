"""Operator 7, benchmark decontamination: a broadcast hash set of normalised
test n-grams; training windows are scanned against it, hits are verified word
by word, and documents or spans are removed.

Words are runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z.  A
window is ``n`` consecutive words of an item; a shorter item is one window.
The set is broadcast in slices of at most ``slice_windows`` windows (a proven
bound); a benchmark beyond one slice takes one scan per slice, whose hits are
merged per document.

Defined cases: a null or empty text or item has no words and no hits; repeated
items count by distinct item id; a null item id counts its windows as hits but
isn't listed; an empty benchmark leaves all documents clean; other columns,
whatever their names, pass through ``remove``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import alnum_words, table, text_bytes
from cartwheel.llm.registry import query

SLICE_WINDOWS = 1_000_000


class WindowSet:
    """Hashes and words of the windows of some benchmark items."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int):
        hasher = alnum_words()
        by_len: dict[int, list[tuple[int, int, bytes]]] = {}
        self.ids = [i for i, _ in items]
        for k, (_, text) in enumerate(items):
            buf = np.frombuffer(text, np.uint8)
            s, e = hasher.spans(buf)
            size = min(n, len(s))
            if not size:
                continue
            for j, h in enumerate(hasher.runs(hasher.words(buf, s, e), size)):
                words = b" ".join(text[s[i]:e[i]] for i in range(j, j + size))
                by_len.setdefault(size, []).append((int(h), k, words))
        self.sets = {}
        for size, rows in by_len.items():
            known: dict[int, dict[bytes, set[int]]] = {}
            for h, k, words in rows:
                known.setdefault(h, {}).setdefault(words, set()).add(k)
            flags = np.zeros(1 << 20, bool)
            hashes = np.array(sorted(known), np.uint64)
            flags[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.sets[size] = (flags, known)


class Scanner:
    """Finds the windows of a set in texts."""

    def __init__(self, windows: WindowSet):
        self.windows, self.hasher = windows, alnum_words()

    def scan(self, text: bytes):
        """(word starts, word ends, hit flag per word, items that occur); byte offsets."""
        buf = np.frombuffer(text, np.uint8)
        s, e = self.hasher.spans(buf)
        hit, items = np.zeros(len(s), bool), set()
        if len(s) and self.windows.sets:
            words = self.hasher.words(buf, s, e)
            for size, (flags, known) in self.windows.sets.items():
                runs = self.hasher.runs(words, size)
                for j in np.flatnonzero(flags[(runs & np.uint64((1 << 20) - 1)).astype(np.int64)]):
                    texts = known.get(int(runs[j]))
                    found = texts and texts.get(b" ".join(text[s[i]:e[i]] for i in range(j, j + size)))
                    if found:
                        hit[j:j + size] = True
                        items |= found
        return s, e, hit, items


def _intervals(hit: np.ndarray) -> list[list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [[int(a), int(b)] for a, b in zip(edge[::2], edge[1::2])]


def _slices(benchmark: DataFrame, item_col: str, text_col: str, n: int, slice_windows: int) -> list[list[tuple]]:
    """The items, read in slices of bounded size.  A text has fewer windows
    than characters, so the characters bound the slice before anything is
    collected; one item larger than a slice is a slice of its own."""
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    k = max(1, -(-total // (8 * slice_windows)))
    return [[(r.i, r.t.encode().lower()) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(k)) == j).collect()]
            for j in range(k)]


SCAN = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("items", T.ArrayType(T.StringType()))])


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items (item ids
    sorted as strings), hits (word intervals, end exclusive), contaminated."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", kind), *SCAN.fields[1:]])

    def scanned(items):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]):
            scanner = Scanner(WindowSet(shared.value, n))
            ids = scanner.windows.ids
            for b in batches:
                words, hits, found = [], [], []
                for text in text_bytes(b.column(2)):
                    s, _, hit, items = scanner.scan(text.lower())
                    words.append(len(s))
                    hits.append(_intervals(hit) if items else [])
                    found.append(sorted({ids[i] for i in items if ids[i] is not None}))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(words, pa.int64()), pa.array(hits, pa.list_(pa.list_(pa.int64()))),
                     pa.array(found, pa.list_(pa.string()))], ["row", "id", "n_words", "hits", "items"])

        return rows.mapInArrow(run, schema)

    parts = [scanned(items) for items in _slices(benchmark, item_col, item_text, n, slice_windows)]
    if len(parts) == 1:
        out = parts[0]
    else:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("row").agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # intervals may overlap between slices: count each word once
    covered = F.aggregate("hits", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
                          lambda a, h: F.struct((a.n + F.greatest(F.lit(0).cast("long"), h[1] - F.greatest(h[0], a.end))).alias("n"),
                                                F.greatest(a.end, h[1]).alias("end")), lambda a: a.n)
    return out.select(F.col("id").alias(id_col), "n_words", covered.alias("n_hit"),
                      F.size("items").cast("long").alias("n_items"), "items", "hits", (F.size("hits") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "document", n: int = 10, text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """``docs`` without contaminated documents, or (``what="span"``) with the
    hit words cut out of their texts.  All columns pass through."""
    out, at = docs, docs.columns.index(text_col)
    for items in _slices(benchmark, item_col, item_text, n, slice_windows):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared):
            scanner = Scanner(WindowSet(shared.value, n))
            for b in batches:
                texts, keep = [], []
                for i, text in enumerate(text_bytes(b.column(at))):
                    s, e, hit, _ = scanner.scan(text.lower())
                    keep.append(what == "span" or not hit.any())
                    if what == "span" and hit.any():
                        cuts, last, kept = _intervals(hit), 0, []
                        for a, z in cuts:
                            kept.append(text[last:s[a]])
                            last = e[z - 1]
                        texts.append(b"".join([*kept, text[last:]]).decode())
                    else:
                        texts.append(None)
                if what == "span":
                    old = b.column(at)
                    new = pa.array([o if t is None else t for o, t in zip(old.to_pylist(), texts)], old.type)
                    b = b.set_column(at, b.schema.field(at), new)
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out


@query("op7_decontaminate")
def op7(spark, sf_dir):
    """Benchmark windows in all documents."""
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
