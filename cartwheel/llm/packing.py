"""Operator 3, variable-capacity best-fit packing of documents into sequences.

Several sequence lengths are permitted.  Documents longer than the largest are
cut into consecutive pieces.  Pieces are dealt evenly into groups of bounded
size, and each group is packed on its own, longest piece first: a piece goes
into the open bin, of whatever size, with the least room that still holds it;
if there is none, the size with the least cost per token that can still be
filled is opened.  Finally each bin shrinks to the smallest size that holds its
contents.

Defined cases: a text without words gives one row with length 0 and no bin;
repeated rows are packed each on its own; ties go by id and piece; an empty
table gives no rows; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import spread, table, written
from cartwheel.llm.registry import query

SIZES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 32        # cost of a sequence besides its tokens
GROUP_PIECES = 5_000  # pieces that one task packs at a time


def best_fit(lengths: np.ndarray, sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD):
    """Bin, offset and final bin size of each piece; ``lengths`` must not rise."""
    sizes = sorted(sizes)
    rest = int(lengths.sum())
    room_of: list[int] = []
    used: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a bin with room r is open
    bins, at = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, n in enumerate(map(int, lengths)):
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            # all that is left is no longer than this piece: it can fill a bin as far as it goes
            size = min((s for s in sizes if s >= n), key=lambda s: ((s + overhead) / min(s, rest), s))
            b, room = len(used), size
            used.append(0)
            room_of.append(size)
        bins[i], at[i] = b, used[b]
        used[b] += n
        room -= n
        rest -= n
        by_room.setdefault(room, []).append(b)
        rooms |= 1 << room
    final = np.array([min(s for s in sizes if s >= u) for u in used], np.int64)
    return bins, at, final[bins] if len(bins) else final


def pieces(docs: DataFrame, length, sizes: tuple[int, ...], id_col: str) -> DataFrame:
    """One row per piece: id, piece, start, length."""
    top = max(sizes)
    rows = docs.select(F.col(id_col).alias("id"), length.alias("n"), F.monotonically_increasing_id().alias("row"))
    last = F.greatest(F.lit(0), F.floor((F.col("n") - 1) / top))
    rows = rows.select("id", "n", "row", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece"))
    start = F.col("piece") * top
    return rows.select("id", "row", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(top)).cast("long").alias("length"))


def word_count(text_col: str = "text"):
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0))


def pack(docs: DataFrame, length=None, sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD,
         group_pieces: int = GROUP_PIECES, id_col: str = "doc_id") -> DataFrame:
    """One row per piece: id, piece, start and length in tokens, bin_id, offset
    in the bin, bin_size.  ``length`` is a column of tokens per document
    (default: words of ``text``)."""
    cut = written(pieces(docs, word_count() if length is None else length, sizes, id_col))
    groups = max(1, -(-cut.where("length > 0").count() // group_pieces))
    kind = cut.schema["id"].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "id", "piece", "row"], ascending=[False, True, True, True], kind="stable")
        bins, at, size = best_fit(group["length"].to_numpy(), sizes, overhead)
        return pd.DataFrame({"id": group["id"], "piece": group["piece"], "start": group["start"], "length": group["length"],
                             "bin_id": group["grp"].astype(str) + "-" + pd.Series(bins, index=group.index).astype(str),
                             "offset": pd.Series(at, index=group.index), "bin_size": pd.Series(size, index=group.index)})

    schema = f"id {kind}, piece long, start long, length long, bin_id string, offset long, bin_size long"
    full = cut.where("length > 0").withColumn("grp", spread(groups, "row", "piece"))
    packed = full.groupBy("grp").applyInPandas(run, schema)
    empty = cut.where("length <= 0").select("id", "piece", "start", F.lit(0).cast("long").alias("length"), F.lit(None).cast("string").alias("bin_id"),
                                            F.lit(None).cast("long").alias("offset"), F.lit(None).cast("long").alias("bin_size"))
    return packed.unionByName(empty).withColumnRenamed("id", id_col)


@query("op3_packing")
def op3(spark, sf_dir):
    """All documents packed into sequences."""
    return pack(table(spark, sf_dir, "documents"))
