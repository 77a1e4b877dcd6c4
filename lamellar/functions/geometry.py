"""Chunk, shard and voxel geometry as Spark columns.

A scale's chunk grid is numbered by a *compressed Morton code*: bits of the three coordinates interleaved from
the lowest on, x first, leaving out coordinates that have no bits left.  A code splits, from its lowest bits,
into preshift, minishard and shard bits.  Everything here is a closed expression that code generation compiles;
the per-scale bit plan is worked out on the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
CHUNK = 64


@dataclass(frozen=True)
class Scale:
    """One scale of a multiscale volume."""

    key: str
    size: tuple[int, int, int]
    chunk: tuple[int, int, int] = (CHUNK, CHUNK, CHUNK)
    preshift: int = 0
    minishard: int = 0
    shard: int = 0

    @cached_property
    def grid(self) -> tuple[int, int, int]:
        return tuple(-(-s // c) for s, c in zip(self.size, self.chunk, strict=True))

    @cached_property
    def bits(self) -> tuple[int, int, int]:
        """Bits that each grid coordinate needs."""
        return tuple(max(0, g - 1).bit_length() for g in self.grid)

    @cached_property
    def plan(self) -> list[tuple[int, int]]:
        """(axis, bit) of every Morton bit, lowest first."""
        return [(axis, level) for level in range(max(self.bits)) for axis in range(3) if level < self.bits[axis]]

    @property
    def low(self) -> int:
        """Morton bits below the shard number."""
        return self.preshift + self.minishard

    def _cell(self, count: int) -> tuple[int, int, int]:
        return tuple(1 << sum(a == axis for a, _ in self.plan[:count]) for axis in range(3))

    @cached_property
    def shard_shape(self) -> tuple[int, int, int]:
        """Chunks of a full shard along each axis."""
        if len(self.plan) > self.low + self.shard:
            raise ValueError(f"{self.key}: {len(self.plan)} bits of chunk coordinates exceed the sharding's {self.low + self.shard}")
        return self._cell(self.low)

    @cached_property
    def minishard_shape(self) -> tuple[int, int, int]:
        return self._cell(self.preshift)

    @property
    def shard_numbers(self) -> int:
        """Shard numbers that the coordinate bits can reach."""
        return 1 << max(0, len(self.plan) - self.low)


def div(value: Column, by: int) -> Column:
    """Whole-number division of coordinates, exact for every long (floors for those of at least 0)."""
    return value.cast("long") if by == 1 else F.call_function("div", value.cast("long"), F.lit(by).cast("long"))


def grid_bits(size: Column, chunk: Column) -> Column:
    """Bits of a grid coordinate from the volume's and the chunk's extent."""
    top = F.greatest(F.lit(0), F.ceil(size / chunk) - 1).cast("long")
    return F.when(top == 0, 0).otherwise(F.length(F.bin(top)))


def morton(scale: Scale, x: Column, y: Column, z: Column) -> Column:
    """Compressed Morton code of chunk coordinates."""
    at = (x.cast("long"), y.cast("long"), z.cast("long"))
    parts = [F.shiftleft(F.shiftright(at[axis], level).bitwiseAND(F.lit(1)), place) for place, (axis, level) in enumerate(scale.plan)]
    return reduce(Column.bitwiseOR, parts, F.lit(0).cast("long"))


def shifted(code: Column, by: int) -> Column:
    """Unsigned right shift; shifts of 64 and more give 0 (the JVM would take them modulo 64)."""
    return F.lit(0).cast("long") if by >= 64 else F.shiftrightunsigned(code, by)


def masked(code: Column, bits: int) -> Column:
    return code if bits >= 64 else code.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def shard_number(scale: Scale, code: Column) -> Column:
    return masked(shifted(code, scale.low), scale.shard)


def minishard_number(scale: Scale, code: Column) -> Column:
    return masked(shifted(code, scale.preshift), scale.minishard)


def shard_filename(number: Column, bits: int) -> Column:
    """Lower-case hex, padded to the digits that ``bits`` need (one at least), and ".shard"."""
    width = max(1, -(-bits // 4))
    digits = F.lower(F.hex(number.cast("long")))
    return F.concat(F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits), F.lit(".shard"))


def rough_shard(scale: Column, preshift: Column, minishard: Column) -> dict[str, Column]:
    """Size of a full shard from its bits alone: side in voxels, chunks at most, and megabytes at a scale's usual block size."""
    side = F.call_function("shiftleft", F.lit(1).cast("long"), div(18 + preshift + minishard, 3).cast("int"))
    across = div(side, CHUNK)
    chunks = across * across * across
    block_kb = F.when(scale == 0, F.lit(5.0)).otherwise(F.least(F.lit(50.0), 5 * F.pow(F.lit(2.0), scale)))
    return {"side": side, "max_chunks": chunks, "max_mb": chunks * block_kb / 1024}


def filename_number(name: Column) -> Column:
    """Shard number of a file name."""
    return F.conv(F.regexp_extract(name, r"([0-9a-f]+)\.shard$", 1), 16, 10).cast("long")


def shard_origin(scale: Scale, number: Column) -> list[Column]:
    """Chunk coordinates of a shard's first chunk."""
    out = []
    for axis in range(3):
        parts = [F.shiftleft(F.shiftright(number, place - scale.low).bitwiseAND(F.lit(1).cast("long")), level) for place, (a, level) in enumerate(scale.plan) if a == axis and place >= scale.low]
        out.append(reduce(Column.bitwiseOR, parts, F.lit(0).cast("long")))
    return out


def _extent(scale: Scale, number: Column) -> list[Column]:
    """Chunks along each axis, cut at the grid; 0 outside and for numbers that no shard has."""
    valid = (number >= 0) & (number < scale.shard_numbers)
    cells = zip(shard_origin(scale, number), scale.grid, scale.shard_shape, strict=True)
    return [F.when(valid, F.greatest(F.lit(0), F.least(F.lit(g) - o, F.lit(s)))).otherwise(0).cast("long") for o, g, s in cells]


def chunks_per_shard(scale: Scale, number: Column) -> Column:
    x, y, z = _extent(scale, number)
    return x * y * z


def shard_box(scale: Scale, number: Column) -> tuple[list[Column], list[Column]]:
    """Voxel origin and extent of a shard, cut at the volume."""
    origin = [o * c for o, c in zip(shard_origin(scale, number), scale.chunk, strict=True)]
    extent = [F.greatest(F.lit(0), F.least(F.lit(n * c), F.lit(s) - o)).cast("long") for o, n, c, s in zip(origin, scale.shard_shape, scale.chunk, scale.size, strict=True)]
    return origin, extent


def name_origin(name: Column) -> list[Column]:
    """Voxel origin in a source shard's name "x_y_z"; null for other names."""
    own = F.when(name.rlike(r"^\d+_\d+_\d+$"), F.split(name, "_"))
    return [own[k].cast("long") for k in range(3)]


def shard_of_voxel(scale: Scale, x: Column, y: Column, z: Column) -> Column:
    chunk = [div(v, c) for v, c in zip((x, y, z), scale.chunk, strict=True)]
    return shard_number(scale, morton(scale, *chunk))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` names it: a lambda variable isn't copied."""
    return F.transform(F.array(value), body)[0]


def shard_of_name(scale: Scale, name: Column, z_compress: int = 0) -> Column:
    """Output shard of a source shard's name; z is divided by the decimation first."""
    parts = F.when(name.rlike(r"^\d+_\d+_\d+$"), F.transform(F.split(name, "_"), lambda s: s.cast("long")))
    return once(parts, lambda p: shard_of_voxel(scale, p[0], p[1], div(p[2], z_compress + 1)))


def source_z(z: Column, z_compress: int) -> Column:
    """Source plane of an output plane."""
    return z * (z_compress + 1)


def check_stride(z_compress: int, chunk: int = CHUNK) -> int:
    stride = z_compress + 1
    if stride < 1 or chunk % stride:
        raise ValueError(f"a stride of {stride} does not divide chunks of {chunk}")
    return stride


def decimate_z(voxels: DataFrame, z_compress: int, z: str = "z") -> DataFrame:
    """Every (z_compress + 1)-th plane, renumbered."""
    stride = check_stride(z_compress)
    return voxels if stride == 1 else voxels.where(F.col(z) % stride == 0).withColumn(z, div(F.col(z), stride))


def clip(voxels: DataFrame, scale: Scale) -> DataFrame:
    """Voxels inside the volume."""
    return voxels.where(reduce(Column.__and__, ((F.col(a) >= 0) & (F.col(a) < s) for a, s in zip(AXES, scale.size, strict=True))))


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that later expressions refer to instead of repeating.

    Catalyst would copy a projected expression into each of its uses; long bit expressions used a few times over
    then grow past what compiles well.  A generator of one row is a boundary that they do not cross.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


def shard_table(scale: Scale, numbers: DataFrame) -> DataFrame:
    """Origin, extent, chunks and volume of shard numbers (column shard); empty ones dropped."""
    origin, extent = shard_box(scale, F.col("shard"))
    boxes = {f"o{a}": o for a, o in zip(AXES, origin, strict=True)} | {f"e{a}": e for a, e in zip(AXES, extent, strict=True)}
    out = settled(numbers.select("shard"), **boxes, chunks=chunks_per_shard(scale, F.col("shard")))
    return out.withColumn("volume", F.col("ex") * F.col("ey") * F.col("ez")).where("volume > 0")


def all_shards(scale: Scale, spark) -> DataFrame:
    """Numbers of the shards that hold a chunk, from the number range alone."""
    return nonempty_shards(scale, spark.range(scale.shard_numbers).select(F.col("id").alias("shard")))


def nonempty_shards(scale: Scale, numbers: DataFrame) -> DataFrame:
    """Those of the numbers (shard) whose shards hold a chunk of the grid."""
    return numbers.where(chunks_per_shard(scale, F.col("shard")) > 0)


def chunk_coordinates(scale: Scale, shards: DataFrame) -> DataFrame:
    """(shard, cx, cy, cz) of every chunk of the shards, cut at the grid."""
    origin, extent = shard_origin(scale, F.col("shard")), _extent(scale, F.col("shard"))
    boxes = {f"o{a}": o for a, o in zip(AXES, origin, strict=True)} | {f"e{a}": e for a, e in zip(AXES, extent, strict=True)}
    out = settled(shards.select("shard"), **boxes).where("ex > 0 and ey > 0 and ez > 0")
    for a in "zyx":
        out = out.withColumn(f"c{a}", F.explode(F.sequence(F.col(f"o{a}"), F.col(f"o{a}") + F.col(f"e{a}") - 1)))
    return out.select("shard", "cx", "cy", "cz")


def axis_factors(parent: Scale, child: Scale) -> tuple[int, int, int]:
    """How much each axis shrinks from one scale to the next: 2 where sizes halve, 1 where they stay."""
    return tuple(2 if -(-p // 2) <= c <= p // 2 + 1 and p != c else 1 if p == c else max(1, round(p / c)) for p, c in zip(parent.size, child.size, strict=True))


def child_shards(parent: Scale, child: Scale, shards: DataFrame) -> DataFrame:
    """Distinct child shards that the chunks of parent shards reach.

    A parent shard's chunks along an axis cover child chunks lo..hi there; stepping lo..hi by the child shard's
    length, from its own boundary, meets each overlapping child shard once.
    """
    origin, extent, factor = shard_origin(parent, F.col("shard")), _extent(parent, F.col("shard")), axis_factors(parent, child)
    boxes = {f"o{a}": o for a, o in zip(AXES, origin, strict=True)} | {f"e{a}": e for a, e in zip(AXES, extent, strict=True)}
    out = settled(shards.select("shard"), **boxes).where("ex > 0 and ey > 0 and ez > 0")
    for k, a in enumerate(AXES):
        n, f = child.shard_shape[k], factor[k]
        low = div(F.col(f"o{a}"), f)
        high = F.least(div(F.col(f"o{a}") + F.col(f"e{a}") - 1, f), F.lit(child.grid[k] - 1).cast("long"))
        first = div(low, n) * n
        out = out.withColumn(f"c{a}", F.explode(F.when(first <= high, F.sequence(first, high, F.lit(n).cast("long"))).otherwise(F.array().cast("array<bigint>"))))
    return out.select(shard_number(child, morton(child, F.col("cx"), F.col("cy"), F.col("cz"))).alias("shard")).distinct()
