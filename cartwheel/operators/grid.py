"""Grid arithmetic (G1-G8) on the cell relation (frame, channel, y, x, v).

Images become rows; per-pixel arithmetic is a projection, a second image is
an equi-join on (y, x).  A convolution gathers square tiles with the margin
that the kernel reaches into, one row a tile, and weighs their cells in Arrow
batches, so a cell is sent to its own tile and those near it, not once for every
kernel weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TILE = 32                # side of a tile of the convolution
RASTER_CELLS = 1 << 20   # of tiles that a task weighs at a time


def saturate(x: Column) -> Column:
    """Clip to 0..255 and truncate to an integer (uint8 cast after clipping)."""
    return F.least(F.greatest(x, F.lit(0)), F.lit(255)).cast("int")


# G1
def sat_add(cells: DataFrame, s) -> DataFrame:
    return cells.withColumn("v", saturate(F.col("v") + s))


def sat_sub(cells: DataFrame, s) -> DataFrame:
    return cells.withColumn("v", saturate(F.col("v") - s))


def sat_rsub(cells: DataFrame, s) -> DataFrame:
    return cells.withColumn("v", saturate(s - F.col("v")))


def sat_mul(cells: DataFrame, s) -> DataFrame:
    return cells.withColumn("v", saturate(F.col("v") * s))


def with_grid(a: DataFrame, b: DataFrame, op: str) -> DataFrame:
    """Cell-wise a (op) b for two grids of the same shape (join on y, x, channel)."""
    bb = b.select("y", "x", "channel", F.col("v").alias("_w"))
    j = a.join(bb, ["y", "x", "channel"])
    expr = {"add": F.col("v") + F.col("_w"), "sub": F.col("v") - F.col("_w"),
            "rsub": F.col("_w") - F.col("v"), "mul": F.col("v") * F.col("_w")}[op]
    return j.withColumn("v", saturate(expr)).drop("_w")


def pair_frames(cells: DataFrame, lag: int, op: str) -> DataFrame:
    """Cell-wise op of every frame with frame+lag (same channel and position)."""
    b = cells.select((F.col("frame") - lag).alias("frame"), "channel", "y", "x", F.col("v").alias("_w"))
    j = cells.join(b, ["frame", "channel", "y", "x"])
    expr = {"add": F.col("v") + F.col("_w"), "sub": F.col("v") - F.col("_w"),
            "rsub": F.col("_w") - F.col("v"), "mul": F.col("v") * F.col("_w")}[op]
    return j.select("frame", "channel", "y", "x", saturate(expr).alias("v"))


# G2
def negative(cells: DataFrame) -> DataFrame:
    return cells.withColumn("v", (255 - F.col("v")).cast("int"))


# G3 — fixed values: ITU-R 601 luma weights
LUMA = {0: 0.299, 1: 0.587, 2: 0.114}


def to_gray(rgb: DataFrame, image: str = "image") -> DataFrame:
    """0.299 R + 0.587 G + 0.114 B per (image, y, x), truncated to int."""
    g = rgb.groupBy(image, "y", "x").agg(*[F.max(F.when(F.col("channel") == c, F.col("v"))).alias(f"_c{c}") for c in (0, 1, 2)])
    # fixed evaluation order R, G, B (floating-point sums are order sensitive)
    gray = LUMA[0] * F.col("_c0") + LUMA[1] * F.col("_c1") + LUMA[2] * F.col("_c2")
    return g.select(image, "y", "x", saturate(gray).alias("v"))


# G4
CHANNELS = {"r": 0, "g": 1, "b": 2}


def channel(rgb: DataFrame, name: str) -> DataFrame:
    """Keep one channel ('r', 'g' or 'b', any case); the other two become 0."""
    key = name.lower()
    if key not in CHANNELS:
        raise ValueError(f"channel must be one of 'r', 'g', 'b', got {name!r}")
    return rgb.withColumn("v", F.when(F.col("channel") == CHANNELS[key], F.col("v")).otherwise(F.lit(0)))


# G5
def contrast(cells: DataFrame, c: float) -> DataFrame:
    """F = 259(C+255) / (255(259−C)); v' = F(v − 128) + 128, saturated."""
    f = 259.0 * (c + 255.0) / (255.0 * (259.0 - c))
    return cells.withColumn("v", saturate(F.lit(f) * (F.col("v") - 128) + 128))


# G7 — fixed values: the kernel set
def kernels() -> dict[str, tuple[list[list[float]], float]]:
    """name → (matrix, offset added, with saturation, to the saturated convolution)."""
    binom = [1, 6, 15, 20, 15, 6, 1]
    return {
        "box7": ([[1.0 / 49] * 7 for _ in range(7)], 0.0),
        "binomial7": ([[a * b / 4096.0 for b in binom] for a in binom], 0.0),
        "sharpen": ([[-1, -1, -1], [-1, 9, -1], [-1, -1, -1]], 0.0),
        "laplacian": ([[-1.5, -1.5, -1.5], [-1.5, 12.0, -1.5], [-1.5, -1.5, -1.5]], 0.0),
        "emboss": ([[-2, -1, 0], [-1, 1, 1], [0, 1, 2]], 128.0),
    }


def _mirror(i: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Symmetric border: -1 → 0, -2 → 1, n → n-1, n+1 → n-2."""
    return np.where(i < 0, -i - 1, np.where(i >= n, 2 * n - i - 1, i))


def _weigh(row, y, x, v, n_rows, ty, tx, h, w, kernel: np.ndarray, r: int):
    """(row, y, x, weighted sum) of the cells that lie in their row's own tile.
    Cells that come twice count twice, on both sides; missing ones count nothing."""
    ly, lx = y - ty[row] * TILE + r, x - tx[row] * TILE + r
    sy, sx = int(ly.max()) + 1, int(lx.max()) + 1
    at = (row * sy + ly) * sx + lx
    held = np.bincount(at, v, n_rows * sy * sx)
    times = np.bincount(at, minlength=n_rows * sy * sx)
    out = np.flatnonzero(times)
    row, ly, lx = out // (sy * sx), out // sx % sy, out % sx
    own = (ly >= r) & (ly < TILE + r) & (lx >= r) & (lx < TILE + r)
    out, row, ly, lx = out[own], row[own], ly[own], lx[own]
    y, x = ly + ty[row] * TILE - r, lx + tx[row] * TILE - r
    total = np.zeros(len(out))
    kh, kw = kernel.shape
    across = [_mirror(x + (kw - 1) // 2 - j, w[row]) - tx[row] * TILE + r for j in range(kw)]
    for i in range(kh):
        b = _mirror(y + (kh - 1) // 2 - i, h[row]) - ty[row] * TILE + r
        for j, a in enumerate(across):
            met = (b >= 0) & (b < sy) & (a >= 0) & (a < sx)
            total += kernel[i, j] * np.where(met, held[np.where(met, (row * sy + b) * sx + a, 0)], 0.0)
    return row, y, x, total * times[out]


# G6
def convolve(cells: DataFrame, name: str, keys=("frame", "channel")) -> DataFrame:
    """Same-size 2-D convolution (kernel flipped), symmetric border, saturated.
    out(y, x) = Σ K[i, j] · in(mirror(y + ch − i), mirror(x + cw − j)).
    Coordinates count from 0."""
    m, off = kernels()[name]
    kernel = np.array(m, float)
    r = max(kernel.shape) // 2
    keys = list(keys)
    cells = cells.where(F.col("y").isNotNull() & F.col("x").isNotNull())
    size = cells.groupBy(*keys).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))
    tiles = lambda c: F.explode(F.sequence(F.floor(F.greatest(F.col(c) - r, F.lit(0)) / TILE).cast("int"), F.floor((F.col(c) + r) / TILE).cast("int")))
    placed = cells.select(*keys, "y", "x", "v").join(size, keys).withColumn("_ty", tiles("y")).withColumn("_tx", tiles("x"))
    tile = placed.groupBy(*keys, "_ty", "_tx", "_h", "_w").agg(F.collect_list(F.struct(
        F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.coalesce(F.col("v").cast("double"), F.lit(0.0)).alias("v"))).alias("_l"))
    kinds = {f.name: f.dataType for f in cells.schema}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in [*keys, "y", "x"]] + [T.StructField("_s", T.DoubleType())])
    coords = [{T.ByteType(): pa.int8(), T.ShortType(): pa.int16(), T.LongType(): pa.int64()}.get(kinds[c], pa.int32()) for c in ("y", "x")]

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            n = max(1, RASTER_CELLS // (TILE + 2 * r) ** 2)
            for lo in range(0, whole.num_rows, n):
                b = whole.slice(lo, n)
                lists = b.column("_l")
                flat = pc.list_flatten(lists)
                row = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
                y, x, v = (flat.field(f).to_numpy() for f in range(3))
                at = [b.column(c).to_numpy().astype(np.int64) for c in ("_ty", "_tx", "_h", "_w")]
                row, y, x, s = _weigh(row, y.astype(np.int64), x.astype(np.int64), v, b.num_rows, *at, kernel, r)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([*[b.column(c).take(take) for c in keys], pa.array(y).cast(coords[0]),
                                                  pa.array(x).cast(coords[1]), pa.array(s)], schema.names)

    g = tile.mapInArrow(run, schema)
    # round away summation-order noise before truncating to uint8
    return g.select(*keys, "y", "x", saturate(saturate(F.round(F.col("_s"), 9)) + off).alias("v"))


# G8
def grid_info(cells: DataFrame, key: str = "frame") -> DataFrame:
    return cells.groupBy(key).agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"),
                                  F.count_distinct("channel").alias("channels"), F.count(F.lit(1)).alias("cells"))
