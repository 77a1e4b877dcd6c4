"""Voxel tables: decoded chunks as rows, chunk keys, dense windows and majority-vote downsampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamellar.functions.bits import unsigned_order
from lamellar.functions.geometry import AXES, Scale, check_stride, clip, div


def explode_voxels(decoded: DataFrame, scale: Scale, z_compress: int = 0, keep_background: bool = False) -> DataFrame:
    """(x, y, z, label) of decoded chunks, z decimated inside the chunk and voxels outside the volume cut.

    Chunks must keep chunk_x, chunk_y, chunk_z; x, y, z are output voxels.
    """
    stride = check_stride(z_compress, scale.chunk[2])
    cx, cy, cz = scale.chunk
    plane = cz // stride

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for kx, ky, kz, voxels in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if voxels is None:
                    continue
                own = np.frombuffer(voxels, "<i8").reshape(cz, cy, cx)[::stride]
                z, y, x = np.indices(own.shape) if keep_background else (None, None, None)
                if not keep_background:
                    z, y, x = np.nonzero(own)
                    label = own[z, y, x]
                else:
                    label = own
                arrays = [kx * cx + x.ravel(), ky * cy + y.ravel(), kz * plane + z.ravel(), label.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], names=["x", "y", "z", "label"])

    from lamellar.session import ship

    ship(decoded.sparkSession)
    rows = decoded.select("chunk_x", "chunk_y", "chunk_z", "voxels").mapInArrow(run, "x long, y long, z long, label long")
    return clip(rows, scale)


def chunk_key(scale: Scale) -> list[Column]:
    return [div(F.col(a), c).alias(f"c{a}") for a, c in zip(AXES, scale.chunk, strict=True)]


def downsample(voxels: DataFrame, size: tuple[int, int, int], factors: tuple[int, int, int] = (2, 2, 2), keys: tuple[str, ...] = ()) -> DataFrame:
    """Majority vote of each cell, background included: (keys, x, y, z, label), background cells left out.

    ``voxels`` is sparse (label 0 may be absent): voxels of a cell without a row vote 0, and cells at the volume's
    border are as large as what lies inside.  Among equal counts the smallest unsigned label wins.  Two
    aggregations, both with map-side partial sums; the second reuses the first's partitioning.
    """
    cell = [div(F.col(a), f).alias(a) for a, f in zip(AXES, factors, strict=True)]
    votes = voxels.groupBy(*keys, *cell, "label").agg(F.count(F.lit(1)).alias("n"))
    room = F.lit(1)
    for a, f, s in zip(AXES, factors, size, strict=True):
        room = room * F.least(F.lit(f), F.lit(s) - F.col(a) * f)
    rank = lambda n, label: F.struct(n.alias("n"), (-unsigned_order(label) - 1).alias("k"))
    solid = F.col("label") != 0
    best = votes.groupBy(*keys, *AXES).agg(
        F.sum(F.when(solid, F.col("n")).otherwise(0)).alias("filled"),
        F.max(F.when(solid, rank(F.col("n"), F.col("label")))).alias("best"),
        F.max_by("label", F.when(solid, rank(F.col("n"), F.col("label")))).alias("label"),
    )
    # Zero has the smallest unsigned value, so it wins ties.
    return best.where(F.col("best.n") > room - F.col("filled")).select(*keys, *AXES, "label")


def majority(voxels: DataFrame, cell: list[Column], label: str = "label") -> DataFrame:
    """Majority vote over present rows only; the smallest label wins ties."""
    votes = voxels.groupBy(*cell, label).agg(F.count(F.lit(1)).alias("n"))
    names = [c for c in votes.columns if c not in (label, "n")]
    return votes.groupBy(*names).agg(F.max_by(label, F.struct(F.col("n"), -F.col(label))).alias(label), F.sum("n").alias("voxels"))


def region_slice(voxels: DataFrame, axis: str, position: int, low: tuple[int, int, int], high: tuple[int, int, int]) -> DataFrame:
    """The labels of one plane inside a box [low, high): the other two axes and label.

    The plane's chunk range is part of the filter, so files partitioned by chunk prune on it.
    """
    others = [a for a in AXES if a != axis]
    inside = F.col(axis) == position
    for a, lo, hi in zip(AXES, low, high, strict=True):
        if a != axis:
            inside = inside & (F.col(a) >= lo) & (F.col(a) < hi)
    return voxels.where(inside).select(*others, "label")


def boxes_on_plane(boxes: DataFrame, axis: str, position: int) -> DataFrame:
    """Boxes (ox.. origin, ex.. extent) that a plane cuts."""
    return boxes.where((F.col(f"o{axis}") <= position) & (F.col(f"o{axis}") + F.col(f"e{axis}") > position))
