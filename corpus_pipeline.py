"""The corpus pipeline: language, exact copies, near copies, benchmark
passages, packing.  Each stage takes (spark, docs, sf_dir), works on all that
the one before kept, and returns a DataFrame; ``run`` writes each result as
Parquet in the shared folder and reads it again.  All stages but the last
return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm.common import table, written
from cartwheel.llm.decontaminate import remove
from cartwheel.llm.exact_dedup import drop_copies
from cartwheel.llm.language import keep_known
from cartwheel.llm.near_join import drop_near_copies
from cartwheel.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language (trained on the documents that aren't held out)."""
    return keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, 0.8): the smallest id."""
    return drop_near_copies(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return remove(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of several lengths."""
    return pack(docs)


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies),
          ("benchmark_leaks", benchmark_leaks), ("packing", packing)]

ORACLE_SQL = None  # language and best-fit packing aren't expressible; tests/llm holds the brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
