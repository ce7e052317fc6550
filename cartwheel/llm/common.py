"""Helpers shared by the operators: reading tables, cutting lineage, a
fixed-size Bloom filter that tasks use to drop rows before a shuffle, and
vectorised word hashing."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import shared_path

U64 = np.uint64
ASCII_SPACE = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read again,
    so that a lost executor re-reads files instead of recomputing."""
    path = shared_path(df.sparkSession, f"llm-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------ Bloom filter

BLOOM_BITS = 1 << 25  # 4 MB, whatever the data; when it fills up it only stops saving work


def bloom_of(df: DataFrame, value: str, bits: int = BLOOM_BITS) -> np.ndarray:
    """Bit array over the well-mixed longs of column ``value``, or-ed together
    in Spark.  At most ``bits / 64`` rows reach the driver."""
    pos = F.explode(F.array(F.expr(f"{value} & {bits - 1}L"),
                            F.expr(f"shiftrightunsigned({value}, 32) & {bits - 1}L")))
    rows = (df.where(F.col(value).isNotNull()).select(pos.alias("p"))
            .groupBy(F.expr("shiftright(p, 6)").alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("m")).toPandas())
    words = np.zeros(bits // 64, U64)
    words[rows["w"].to_numpy(np.int64)] = rows["m"].to_numpy(np.int64).view(U64)
    return words


def bloom_hit(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the longs ``values`` may be in the filter."""
    v = values.astype(np.int64).view(U64)
    mask = U64(len(words) * 64 - 1)
    hit = np.ones(len(v), bool)
    for p in (v & mask, (v >> U64(32)) & mask):
        hit &= (words[(p >> U64(6)).astype(np.int64)] >> (p & U64(63))) & U64(1) == 1
    return hit


# ------------------------------------------------------------ word hashing

def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class WordHasher:
    """64-bit hashes of the words of a byte string and of runs of words.

    A word's hash is a polynomial over random byte values modulo 2^64, taken
    from prefix sums, so a whole text costs a few numpy passes."""

    BASE, RUN = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

    def __init__(self, word_bytes: np.ndarray):
        self.word = word_bytes
        self.value = mix(np.arange(1, 257, dtype=U64) * U64(self.BASE))
        self.inverse = U64(pow(self.BASE, -1, 1 << 64))
        self._grow(1 << 12)

    def _grow(self, n: int):
        ones = np.ones(n + 1, U64)
        ones[0] = 1
        up, down = ones.copy(), ones.copy()
        up[1:], down[1:] = U64(self.BASE), self.inverse
        self.up, self.down = np.cumprod(up), np.cumprod(down)

    def spans(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = np.zeros(len(buf) + 2, np.int8)
        inside[1:-1] = self.word[buf]
        edge = np.flatnonzero(np.diff(inside))
        return edge[::2], edge[1::2]

    def words(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(starts) == 0:
            return np.zeros(0, U64)
        if len(buf) >= len(self.up):
            self._grow(2 * len(buf))
        sums = np.zeros(len(buf) + 1, U64)
        np.cumsum(self.value[buf] * self.up[:len(buf)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(U64))

    def runs(self, words: np.ndarray, k: int) -> np.ndarray:
        """Hash of each run of ``k`` words."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, U64)
        out, factor = np.zeros(n, U64), 1
        for j in range(k):
            out += words[j:j + n] * U64(factor)
            factor = factor * self.RUN % (1 << 64)
        return mix(out + U64(k))


def space_words() -> WordHasher:
    """Words are runs without ASCII white space."""
    word = np.ones(256, bool)
    word[ASCII_SPACE] = False
    return WordHasher(word)


def alnum_words() -> WordHasher:
    """Words are runs of 0-9, a-z and all bytes of non-ASCII characters."""
    word = np.zeros(256, bool)
    word[0x30:0x3A] = word[0x61:0x7B] = word[0x80:] = True
    return WordHasher(word)


def text_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null as empty."""
    import pyarrow as pa
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(binary).to_pylist()]


def spread(n: int, *cols: str) -> Column:
    """An even bucket number from 0 to n-1 for the values of ``cols``."""
    return F.pmod(F.xxhash64(*cols), F.lit(n))
