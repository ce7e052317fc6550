"""Operator 12, alignment of two tokenizers' tokens, as an Arrow pipeline.

Both tokenizers encode every whole text.  Their token lists are flattened with
parent indices; cumulative sums of token bytes, less each document's first sum,
give byte ends.  A token of one side and a token of the other are linked when
their byte ranges end together: an Acero hash join on the (document, end) key.
The common ends cut both token lists into groups.  ``Table.group_by`` counts the
id pairs of a batch and Spark merges the counts of all batches.

Tokens that end together cover the same last bytes, so one's bytes end with the
other's.  The pairs that can ever be counted are therefore bounded by the two
vocabularies (``pair_bound``; 324,297 for the given ones), whatever the corpus,
and the merged counts are collected and broadcast.  Texts are tokenised once,
a distinct segment between blanks once a task (``Segments``): the links, as
pair numbers, are written between the two passes.  The vocabulary
files are read by the driver and broadcast, so executors need no copy.

Defined cases: a text that is null, empty, or not rebuilt byte by byte by both
tokenizers (such as one with characters that one of them replaces) has no
tokens, zeros and an empty digest; a null id passes through; repeated rows
count again; an empty table gives no rows; other columns, whatever their names,
are ignored.  Ties for the highest count of an id all count as best."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import table, text_bytes, written
from cartwheel.llm.registry import query

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE_BYTES = 1 << 18   # texts aligned at a time, at least one
SLICE_LINKS = 1 << 19   # links counted or scored at a time, at least those of a text
CACHE_SEGMENTS = 1 << 18  # distinct segments whose tokens a task remembers
SEGMENT = re.compile(r"(?<=[^\s▁])(?= (?s:.))")  # a lone last blank stays with its word


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _by_id(entries: dict[int, bytes]) -> pa.Array:
    return pa.array([entries.get(i, b"") for i in range(max(entries) + 1)], pa.binary())


class ByteTokens:
    """A byte-level vocabulary file; encodes a blank and the text."""

    def __init__(self, file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_str(file.decode())
        self.model.encode_special_tokens = True
        alphabet = byte_alphabet()
        special = {t["content"] for t in json.loads(file).get("added_tokens") or ()}
        self.bytes = _by_id({i: t.encode() if t in special else bytes(alphabet[c] for c in t)
                             for t, i in self.model.get_vocab(with_added_tokens=True).items()})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a blank and each text."""
        return [e.ids for e in self.model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def splits(self) -> bool:
        """Whether no token crosses from another character to a blank: the
        splitting pattern of byte-level models starts a new part there."""
        model = json.loads(self.model.to_str())
        split = model.get("pre_tokenizer") or {}
        return not model.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex", True)


class PieceTokens:
    """A vocabulary of pieces with byte fallback; it puts the blank itself."""

    def __init__(self, file: bytes):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_proto=file)
        pieces = {i: self.model.id_to_piece(i) for i in range(self.model.get_piece_size())}
        byte = {i: re.fullmatch("<0x([0-9A-F]{2})>", p) for i, p in pieces.items()}
        self.bytes = _by_id({i: bytes([int(byte[i][1], 16)]) if byte[i] else p.replace("▁", " ").encode()
                             for i, p in pieces.items()})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def splits(self) -> bool:
        return not any(re.search("[^▁]▁", self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))


def pair_bound(a: pa.Array, b: pa.Array) -> int:
    """How many pairs of entries can end together: one's bytes end with the other's."""
    from collections import Counter
    left, right = Counter(a.to_pylist()), Counter(b.to_pylist())
    return (sum(k * right[x[i:]] for x, k in left.items() for i in range(len(x)))
            + sum(k * left[x[i:]] for x, k in right.items() for i in range(1, len(x))))


def _ends(lists: pa.Array, entry_bytes: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, list[bytes]]:
    """Flat ids, their documents, their byte ends inside the document, and each document's joined bytes."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    own = entry_bytes.take(flat)
    total = pc.cumulative_sum(pc.cast(pc.binary_length(own), pa.int64()))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total])
    base = before.take(lists.offsets[:-1])
    joined = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, own), b"").to_pylist()
    return flat, parent, pc.subtract(total, base.take(parent)), joined


def _only(lists: pa.Array, keep: list[bool]) -> pa.Array:
    """The lists, those not kept emptied."""
    return pc.if_else(pa.array(keep), lists, pa.array([[]] * len(lists), lists.type))


class Numbers(dict):
    """Numbers keys in the order in which they come."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Segments:
    """Tokens of segments of text, remembered by segment.

    A text is cut before each blank that follows a character that is not white
    space (or the mark that piece vocabularies write for a blank).  Neither tokenizer has a token across such a place (``splits``), so a
    text's tokens are those of its segments in order, and most segments are
    words that come again.  New segments are encoded in one piece and cut by
    their byte ends; if their bytes do not come back, one by one."""

    def __init__(self, *sides):
        self.sides, self.cut = sides, all(s.splits() for s in sides)
        self.clear()

    def clear(self):
        self.known = Numbers()
        self.lists = [pa.array([], pa.list_(pa.int32())) for _ in self.sides]

    def tokens(self, texts: list[str]) -> list[pa.Array]:
        """For each side, the token ids of a blank and each text (of empty texts, none)."""
        if len(self.known) > CACHE_SEGMENTS:
            self.clear()
        parts = [(SEGMENT.split(" " + t) if self.cut else [" " + t]) if t else [] for t in texts]
        first = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
        old = len(self.known)
        at = list(map(self.known.__getitem__, chain.from_iterable(parts)))
        if len(self.known) > old:
            new = list(islice(self.known, old, None))
            ragged = [s[-1].isspace() or s[-1] == "▁" for s in new]  # ends of texts: what follows would join them
            order = np.argsort(ragged, kind="stable")
            joined, rest = [s for s, r in zip(new, ragged) if not r], [s for s, r in zip(new, ragged) if r]
            for k, side in enumerate(self.sides):
                self.lists[k] = pa.concat_arrays([self.lists[k], self._encode(side, joined, rest).take(pa.array(np.argsort(order)))])
        out = []
        for lists in self.lists:
            lists = lists.take(pa.array(at, pa.int64()))
            out.append(pa.ListArray.from_arrays(lists.offsets.take(pa.array(first)), lists.values) if len(lists)
                       else pa.array([[]] * len(texts), pa.list_(pa.int32())))
        return out

    def _encode(self, side, joined: list[str], rest: list[str]) -> pa.Array:
        kind = pa.list_(pa.int32())
        if len(joined) > 1:
            text = "".join(joined)
            ids = pa.array(side.encode([text[1:]])[0], pa.int32())
            own = side.bytes.take(ids)
            ends = np.cumsum(pc.binary_length(own).to_numpy())
            want = np.cumsum(pc.binary_length(pa.array(joined)).to_numpy())
            at = np.searchsorted(ends, want)
            if pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), b"")[0].as_py() == text.encode() and (ends[at] == want).all():
                whole = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], at + 1)), pa.int32()), ids)
                return pa.concat_arrays([whole, pa.array(side.encode([s[1:] for s in rest]), kind)])
        return pa.array(side.encode([s[1:] for s in joined + rest]), kind)


class Aligner:
    def __init__(self, a, b):
        self.a, self.b, self.segments = a, b, Segments(a, b)
        self.width = len(b.bytes)
        self.pair_type = pa.int32() if len(a.bytes) * self.width < 1 << 31 else pa.int64()

    def align(self, texts: list[bytes], with_groups: bool = False) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, groups (or null), groups_sha256, pairs of each text."""
        a_list, b_list = self.segments.tokens([t.decode("utf-8", "replace") for t in texts])
        a, b = _ends(a_list, self.a.bytes), _ends(b_list, self.b.bytes)
        keep = [not t or x == y == b" " + t for x, y, t in zip(a[3], b[3], texts)]
        if not all(keep):
            a_list, b_list = (_only(x, keep) for x in (a_list, b_list))
            a, b = _ends(a_list, self.a.bytes), _ends(b_list, self.b.bytes)

        stride = max(map(len, texts), default=0) + 2
        key_a, key_b = (pc.add(pc.multiply(pc.cast(x[1], pa.int64()), stride), x[2]) for x in (a, b))
        links = pa.table({"doc_end": key_a, "a": a[0], "at_a": np.arange(len(key_a))}).join(
            pa.table({"doc_end": key_b, "b": b[0], "at_b": np.arange(len(key_b))}), "doc_end", join_type="inner", use_threads=False)
        links = links.sort_by([("at_a", "ascending"), ("at_b", "ascending")]).combine_chunks()
        link_key = links["doc_end"].to_numpy()
        docs = np.arange(len(texts) + 1) * stride
        pairs = pc.add(pc.multiply(pc.cast(links["a"], pa.int64()), self.width), links["b"]).cast(self.pair_type).combine_chunks()
        pairs = pa.ListArray.from_arrays(_offsets(link_key, docs), pairs)

        cuts = link_key[np.diff(link_key, prepend=-1) != 0]  # in order, as the tokens are
        sides = [pc.binary_join(pa.ListArray.from_arrays(_offsets(key.to_numpy(), cuts, "right", True), pc.cast(ids, pa.string())), ",")
                 for key, ids in ((key_a, a[0]), (key_b, b[0]))]
        of_doc = _offsets(cuts, docs)
        groups = pc.binary_join(pa.ListArray.from_arrays(of_doc, pc.binary_join_element_wise(*sides, "|")), ";")
        digest = ["" if not g else hashlib.sha256(g.encode()).hexdigest() for g in groups.to_pylist()]
        count = lambda x: pc.cast(pc.list_value_length(x), pa.int64())
        return [count(a_list), count(b_list), pa.array(np.diff(of_doc.to_numpy()).astype(np.int64)), count(pairs),
                groups if with_groups else pa.nulls(len(texts), pa.string()), pa.array(digest, pa.string()), pairs]


def _offsets(keys: np.ndarray, cuts: np.ndarray, side: str = "left", first: bool = False) -> pa.Array:
    at = np.searchsorted(keys, cuts, side)
    return pa.array(np.concatenate(([0], at)) if first else at, pa.int32())


def _slices(sizes: pa.Array, most: int) -> Iterator[slice]:
    """Rows of no more than ``most`` in all, at least one."""
    first, size = 0, 0
    for i, n in enumerate(pc.fill_null(sizes, 0).to_pylist()):
        if i > first and size + n > most:
            yield slice(first, i)
            first, size = i, 0
        size += n
    yield slice(first, len(sizes))


def count_pairs(lists: pa.Array) -> Iterator[pa.Table]:
    """(pair, n) of the lists, a slice at a time."""
    for part in _slices(pc.list_value_length(lists), SLICE_LINKS):
        t = pa.table({"pair": pc.list_flatten(lists[part])}).group_by("pair", use_threads=False).aggregate([("pair", "count")])
        yield pa.table({"pair": pc.cast(t["pair"], pa.int64()), "n": t["pair_count"]})


def score_pairs(lists: pa.Array, pair: np.ndarray, n: np.ndarray, best: np.ndarray) -> list[pa.Array]:
    """n_best and count_sum of each list, a slice at a time, from the sorted pairs of the corpus."""
    sums = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    for part in _slices(pc.list_value_length(lists), SLICE_LINKS):
        at = np.searchsorted(pair, pc.list_flatten(lists[part]).to_numpy())
        first = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists[part]), 0).to_numpy())))
        for out, x in zip(sums, (best, n)):
            out.append(np.diff(np.concatenate(([0], np.cumsum(x[at], dtype=np.int64)))[first]))
    return [pa.array(np.concatenate(x)) for x in sums]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "pairs"]


def align_tokens(docs: DataFrame, a_file: str = f"{FOLDER}/{A_FILE}", b_file: str = f"{FOLDER}/{B_FILE}",
                 id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False, with_pairs: bool = True,
                 a_kind=ByteTokens, b_kind=PieceTokens) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, groups
    (``a1,a2|b1;...`` in ids; null unless ``with_groups``), groups_sha256,
    pairs (a number for each link, a id times the second vocabulary's size plus
    b id; no such column unless ``with_pairs``), n_best (links whose pair is the commonest of its b id), count_sum
    (links of the corpus that hold the same pair, summed over the links)."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((Path(a_file).read_bytes(), Path(b_file).read_bytes()))
    aligner = Aligner(a_kind(files.value[0]), b_kind(files.value[1]))
    width, wide = aligner.width, pa.types.is_int64(aligner.pair_type)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("txt"))
    counted = [T.StructField(n, T.LongType()) for n in NAMES[:4]]
    schema = T.StructType([rows.schema["id"], *counted, T.StructField("groups", T.StringType()), T.StructField("groups_sha256", T.StringType()),
                           T.StructField("pairs", T.ArrayType(T.LongType() if wide else T.IntegerType()))])

    def align(batches: Iterator[pa.RecordBatch]):
        aligner = Aligner(a_kind(files.value[0]), b_kind(files.value[1]))
        for b in batches:
            for part in _slices(pc.binary_length(b.column(1)), SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([b.column(0)[part], *aligner.align(text_bytes(b.column(1)[part]), with_groups)], ["id", *NAMES])
        del aligner
        pa.default_memory_pool().release_unused()  # the worker lives on for the next pass

    def count(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for t in count_pairs(b.column(0)):
                yield from t.to_batches()

    aligned = written(rows.mapInArrow(align, schema))
    counts = (aligned.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
              .toPandas().sort_values("pair"))  # at most pair_bound rows
    pair, n = counts["pair"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    most = np.zeros(width, np.int64)
    np.maximum.at(most, pair % width, n)
    known = spark.sparkContext.broadcast((pair, n, n == most[pair % width]))

    def score(batches: Iterator[pa.RecordBatch]):
        pair, n, best = known.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], *score_pairs(b.column(len(schema) - 1), pair, n, best)], [*schema.names[:len(kept)], "n_best", "count_sum"])

    kept = schema.fields if with_pairs else schema.fields[:-1]
    scored = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return aligned.mapInArrow(score, scored).withColumnRenamed("id", id_col)


@query("op12_token_align")
def op12(spark, sf_dir):
    """Tokens of all documents in two vocabularies, aligned by their byte ends."""
    found = align_tokens(table(spark, sf_dir, "documents"), with_pairs=False)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
