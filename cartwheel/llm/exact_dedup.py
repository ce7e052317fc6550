"""Operator 9, exact duplicates: group by a 128-bit content hash, keep one
stable id, and compare the bytes inside groups to exclude collisions.

A first pass hashes every normalised text; only hashes, never texts, are
grouped.  A second pass sends the texts of groups with two or more members,
each distinct text once per batch, and a distinct over (hash, text) compares
their bytes.  A hash that covers several texts is split by text.

Defined cases: a null text counts as empty; ids may repeat (each row counts in
``group_size``, and every row that bears ``keep_id`` is marked kept by
``exact_groups``, while ``drop_copies`` returns one row of them); a null id is
never kept while the group has another id; an empty table gives no rows; other
columns are ignored by ``exact_groups`` and pass through ``drop_copies``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import bloom_hit, bloom_of, table, text_bytes, written
from cartwheel.llm.registry import query


def content_hash(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(text)


def _halves(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    pair = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())


def _hashed(docs: DataFrame, id_col: str, text_col: str, digest: Callable) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, h1 long, h2 long, sha string"

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = [t.lower() for t in text_bytes(b.column(1))]
            h1, h2 = _halves([digest(t) for t in texts])
            sha = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), h1, h2, sha], ["id", "h1", "h2", "sha"])

    return rows.mapInArrow(run, schema)


def _texts_of(docs: DataFrame, text_col: str, digest: Callable, wanted: np.ndarray) -> DataFrame:
    """Distinct (hash, sha, text) of each batch whose hash may be wanted."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = list({t.lower() for t in text_bytes(b.column(0))})
            h1, h2 = _halves([digest(t) for t in texts])
            keep = np.flatnonzero(bloom_hit(shared.value, h1.to_numpy()))
            texts = [texts[i] for i in keep]
            yield pa.RecordBatch.from_arrays(
                [h1.take(pa.array(keep)), h2.take(pa.array(keep)),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                 pa.array(texts, pa.binary())], ["h1", "h2", "sha", "norm"])

    return docs.select(F.col(text_col).alias("txt")).mapInArrow(run, "h1 long, h2 long, sha string, norm binary")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                 digest: Callable[[bytes], bytes] = content_hash) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z.  ``keep`` names the id
    that stays, ``min`` or ``max``; ``digest`` gives 16 bytes."""
    hashed = written(_hashed(docs, id_col, text_col, digest))
    best = {"min": F.min, "max": F.max}[keep]
    several = hashed.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    texts = _texts_of(docs, text_col, digest, bloom_of(several, "h1"))
    versions = texts.distinct()  # compares bytes; a hash with two texts is a collision
    clash = versions.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    clash = written(clash)
    if clash.isEmpty():
        keyed = hashed.withColumn("part", F.lit(0))
    else:
        by_text = Window.partitionBy("h1", "h2").orderBy("norm")
        parts = (versions.join(clash, ["h1", "h2"], "left_semi")
                 .select("h1", "h2", "sha", F.row_number().over(by_text).alias("part")))
        keyed = hashed.join(parts, ["h1", "h2", "sha"], "left").fillna(0, ["part"])
    key = ["h1", "h2", "part"]
    # written, so that the join below has a shuffle on either side and can split a hot group
    groups = written(keyed.groupBy(*key).agg(best("id").alias("keep_id"), F.count("*").alias("group_size")))
    return (keyed.join(groups, key)
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """``docs`` with one row of each group of equal texts; columns unchanged."""
    groups = written(exact_groups(docs, id_col, text_col, keep).select(F.col(id_col).alias("_id"), "kept", F.col("text_sha256").alias("_sha")))
    lost = groups.where("not kept").select("_id", "_sha").distinct()
    if groups.groupBy("_id").count().where("count > 1").isEmpty():  # ids are unique: no text is needed
        return docs.join(lost, docs[id_col].eqNullSafe(F.col("_id")), "left_anti")
    sha = F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                             "abcdefghijklmnopqrstuvwxyz"), 256)
    marked = docs.withColumn("__sha", sha)
    same = marked[id_col].eqNullSafe(F.col("_id")) & (F.col("__sha") == F.col("_sha"))
    marked = marked.join(lost, same, "left_anti")
    twice = groups.where("kept").groupBy("_id", "_sha").count().where("count > 1").select("_id", "_sha")
    once = marked.join(twice, same, "left_semi").dropDuplicates([id_col, "__sha"])
    return marked.join(twice, same, "left_anti").unionByName(once).drop("__sha")


@query("op9_exact_dedup", """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM t JOIN g USING (text_sha256)""")
def op9(spark, sf_dir):
    """Groups of equal texts in all documents; the largest id stays."""
    return exact_groups(table(spark, sf_dir, "documents"), keep="max")
