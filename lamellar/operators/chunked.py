"""Whole chunks as rows: z decimation, majority-vote downsampling and assembly without a row per voxel.

A chunk is one row with its voxels as bytes (uint64, z, y, x).  Cells of a downsampling never cross a chunk, so
each parent chunk is voted on where it lies and only the eighth that remains is exchanged; a child chunk is put
together from at most eight pieces.  Absent chunks are background, and chunks that are all background are not made.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale, axis_factors, check_stride
from lamellar.session import ship

from . import codecs, palette

ROWS = "chunk_x int, chunk_y int, chunk_z int, voxels binary"
_NONE = np.uint64((1 << 64) - 1)


def vote(volume: np.ndarray, inside: tuple[int, int, int], factors: tuple[int, int, int]) -> np.ndarray:
    """Most frequent label of each cell of uint64[z, y, x]; the smallest wins ties.

    ``inside``: planes, rows and columns that lie in the volume; only they vote.  Cells without any are 0.
    """
    shape = [n // f for n, f in zip(volume.shape, factors, strict=True)]
    split = [n for pair in zip(shape, factors, strict=True) for n in pair]
    k = int(np.prod(factors))
    cells = lambda a: a.reshape(split).transpose(0, 2, 4, 1, 3, 5).reshape(-1, k)
    v = cells(volume)
    valid = np.zeros(volume.shape, bool)
    valid[tuple(slice(max(0, n)) for n in inside)] = True
    ok = cells(valid)
    votes = np.zeros(v.shape, np.int8)
    for j in range(k):
        votes += (v == v[:, j : j + 1]) & ok[:, j : j + 1]
    votes[~ok] = -1
    best = np.where((votes == votes.max(1, keepdims=True)) & ok, v, _NONE).min(1)
    best[~ok.any(1)] = 0
    return best.reshape(shape)


def _put_together(pieces: DataFrame, chunk: tuple[int, int, int]) -> DataFrame:
    """Chunks from pieces at offsets inside them; at most eight (or the stride's) pieces meet in a group."""
    cx, cy, cz = chunk

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        out = np.zeros((cz, cy, cx), "<u8")
        for r in rows.to_pylist():
            side = [r["nz"], r["ny"], r["nx"]]
            out[r["oz"] : r["oz"] + side[0], r["oy"] : r["oy"] + side[1], r["ox"] : r["ox"] + side[2]] = np.frombuffer(r["voxels"], "<u8").reshape(side)
        names = ("chunk_x", "chunk_y", "chunk_z")
        return pa.table({**{n: pa.array([k.as_py()], pa.int32()) for n, k in zip(names, key, strict=True)}, "voxels": pa.array([out.tobytes()], pa.binary())})

    return pieces.groupBy("chunk_x", "chunk_y", "chunk_z").applyInArrow(build, ROWS)


def _pieces(chunks: DataFrame, work, schema: str) -> DataFrame:
    """``work(x, y, z, voxels)`` of every chunk; None leaves it out."""
    ship(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y, z, voxels in zip(*(b.column(k) for k in range(4)), strict=True):
                if not voxels.is_valid:
                    continue
                got = work(x.as_py(), y.as_py(), z.as_py(), voxels.as_buffer())
                if got is not None:
                    at, data = got
                    names = ["chunk_x", "chunk_y", "chunk_z", "ox", "oy", "oz", "nx", "ny", "nz"]
                    yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int32()) for v in at), pa.array([data], pa.binary())], names=[*names, "voxels"])

    return chunks.select("chunk_x", "chunk_y", "chunk_z", "voxels").mapInArrow(run, schema)


_SIDED = "chunk_x int, chunk_y int, chunk_z int, ox int, oy int, oz int, nx int, ny int, nz int, voxels binary"


def downsample(chunks: DataFrame, parent: Scale, child: Scale) -> DataFrame:
    """Chunks of the next scale.  Axes whose size stays are not downsampled; both scales have one chunk size."""
    if parent.chunk != child.chunk:
        raise ValueError("parent and child chunks differ in size")
    fx, fy, fz = axis_factors(parent, child)
    cx, cy, cz = parent.chunk
    sx, sy, sz = parent.size

    def work(x: int, y: int, z: int, data):
        volume = np.frombuffer(data, "<u8").reshape(cz, cy, cx)
        out = vote(volume, (min(cz, sz - z * cz), min(cy, sy - y * cy), min(cx, sx - x * cx)), (fz, fy, fx))
        if not out.any():
            return None
        nz, ny, nx = out.shape
        return (x // fx, y // fy, z // fz, x % fx * nx, y % fy * ny, z % fz * nz, nx, ny, nz), out.astype("<u8").tobytes()

    return _put_together(_pieces(chunks, work, _SIDED), child.chunk)


def decimate(chunks: DataFrame, scale: Scale, z_compress: int) -> DataFrame:
    """Every (z_compress + 1)-th plane, neighbours' planes put together into full chunks of ``scale``."""
    stride = check_stride(z_compress, scale.chunk[2])
    if stride == 1:
        return chunks.select("chunk_x", "chunk_y", "chunk_z", "voxels").where("voxels is not null")
    cx, cy, cz = scale.chunk

    def work(x: int, y: int, z: int, data):
        out = np.frombuffer(data, "<u8").reshape(cz, cy, cx)[::stride]
        return ((x, y, z // stride, 0, 0, z % stride * len(out), cx, cy, len(out)), out.tobytes()) if out.any() else None

    return _put_together(_pieces(chunks, work, _SIDED), scale.chunk)


def clip(chunks: DataFrame, scale: Scale) -> DataFrame:
    """Chunks inside the grid, voxels beyond the volume set to background, empty chunks left out."""
    cx, cy, cz = scale.chunk
    sx, sy, sz = scale.size

    def work(x: int, y: int, z: int, data):
        out = np.frombuffer(data, "<u8").reshape(cz, cy, cx)
        if (z + 1) * cz > sz or (y + 1) * cy > sy or (x + 1) * cx > sx:
            out = out.copy()
            out[max(0, sz - z * cz) :], out[:, max(0, sy - y * cy) :], out[:, :, max(0, sx - x * cx) :] = 0, 0, 0
        return ((x, y, z, 0, 0, 0, cx, cy, cz), out.tobytes()) if out.any() else None

    inside = (F.col("chunk_x") < scale.grid[0]) & (F.col("chunk_y") < scale.grid[1]) & (F.col("chunk_z") < scale.grid[2])
    return _pieces(chunks.where(inside), work, _SIDED).select("chunk_x", "chunk_y", "chunk_z", "voxels")


def encode(chunks: DataFrame, scale: Scale, gzipped: bool = True) -> DataFrame:
    """chunk_x.., encoded: chunks in the segmentation format."""
    ship(chunks.sparkSession)
    cx, cy, cz = scale.chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [codecs.encode_segmentation(np.frombuffer(v.as_buffer(), "<u8").reshape(cz, cy, cx)) for v in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([gzip.compress(d, mtime=0) if gzipped else d for d in data], pa.binary())], names=["chunk_x", "chunk_y", "chunk_z", "encoded"])

    return chunks.select("chunk_x", "chunk_y", "chunk_z", "voxels").mapInArrow(run, "chunk_x int, chunk_y int, chunk_z int, encoded binary")


# --- encoded chunks: what is exchanged and stored ------------------------------------------------------------

AT = ("chunk_x", "chunk_y", "chunk_z")
_BOX = ("ox", "oy", "oz", "nx", "ny", "nz")
_PIECE = ", ".join(f"{c} int" for c in (*AT, *_BOX)) + ", encoded binary"


def inside(scale: Scale, x: int, y: int, z: int) -> tuple[int, int, int]:
    """Planes, rows and columns of a chunk that lie in the volume; none beyond the grid."""
    return tuple(max(0, min(c, s - k * c)) for c, s, k in zip(scale.chunk[::-1], scale.size[::-1], (z, y, x), strict=True))


def packed(volume: np.ndarray) -> bytes | None:
    """A gzipped segmentation; null for background only, which is not stored."""
    return gzip.compress(codecs.encode_segmentation(volume), mtime=0) if volume.any() else None


def plain(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def unpacked(data: bytes, shape: tuple[int, int, int]) -> np.ndarray:
    return codecs.decode_segmentation(plain(data), shape)


def from_voxels(voxels: DataFrame, scale: Scale) -> DataFrame:
    """Stored chunks (chunk_x.., encoded) of labelled voxels (x, y, z, label), one label a voxel; others are background.

    A group is a chunk, so at most a chunk's voxels meet; voxels outside the volume and null labels are left out.
    """
    ship(voxels.sparkSession)
    inside_ = " and ".join(f"{a} >= 0 and {a} < {n}" for a, n in zip("xyz", scale.size, strict=True))
    at = [F.expr(f"cast({a} div {c} as int)").alias(k) for a, c, k in zip("xyz", scale.chunk, AT, strict=True)]
    own = [F.expr(f"cast({a} % {c} as int)").alias(a) for a, c in zip("xyz", scale.chunk, strict=True)]

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        out = np.zeros(inside(scale, *(k.as_py() for k in key)), np.uint64)
        x, y, z, label = (rows.column(c).to_numpy() for c in ("x", "y", "z", "label"))
        out[z, y, x] = label.view(np.uint64)
        return pa.table({**{n: pa.array([k.as_py()], pa.int32()) for n, k in zip(AT, key, strict=True)}, "encoded": pa.array([packed(out)], pa.binary())})

    rows = voxels.where(inside_ + " and label is not null").select(*at, *own, F.col("label").cast("long").alias("label"))
    return rows.groupBy(*AT).applyInArrow(build, "chunk_x int, chunk_y int, chunk_z int, encoded binary").where("encoded is not null")


def encode_source(rows: DataFrame, scale: Scale, label_type: str = codecs.LABELS, z_compress: int = 0) -> DataFrame:
    """Source chunks as encoded pieces of output chunks, all steps in one stage and no voxels beyond it.

    shard, chunk_x, chunk_y, chunk_z (of the source), encoded, error.  With decimation a piece is the planes that stay of one
    source chunk; without, it is a whole output chunk, cut at the volume's end.  Background and chunks outside the grid have
    no piece and no error.
    """
    stride = check_stride(z_compress, scale.chunk[2])

    def work(block, labels, supervoxels, x: int, y: int, z: int):
        nz, ny, nx = inside(scale, x, y, z // stride)
        cube = codecs._stored(block, labels, supervoxels, scale.chunk[::-1])[::stride]
        left = max(0, nz - z % stride * len(cube))
        return (packed(cube[:left, :ny, :nx]),)

    return codecs._mapped(rows, ("shard", *AT), [codecs.T.StructField("encoded", codecs.T.BinaryType())], label_type, work, at=True)


def pieces_of(encoded: DataFrame, scale: Scale, z_compress: int) -> DataFrame:
    """Decimated source chunks as pieces at their places in output chunks."""
    stride = check_stride(z_compress, scale.chunk[2])
    (cx, cy, cz), (sx, sy, sz) = scale.chunk, scale.size
    deep = cz // stride
    z = F.expr(f"chunk_z div {stride}").cast("int")
    oz = (F.col("chunk_z") % stride * deep).cast("int")
    left = lambda size, chunk, at: F.least(F.lit(chunk), F.lit(size) - at * chunk).cast("int")
    nz = F.least(F.lit(deep), left(sz, cz, z) - oz).cast("int")
    zero = F.lit(0)
    return encoded.where("encoded is not null").select("chunk_x", "chunk_y", z.alias("chunk_z"), zero.alias("ox"), zero.alias("oy"), oz.alias("oz"), left(sx, cx, F.col("chunk_x")).alias("nx"), left(sy, cy, F.col("chunk_y")).alias("ny"), nz.alias("nz"), "encoded")


def _voted(data: bytes, shape: tuple[int, int, int], factors: tuple[int, int, int]) -> tuple[bytes | None, list[int]]:
    """A stored chunk voted down, gzipped, and its size; by its tables where cells keep to blocks, else by its voxels."""
    small = [-(-n // f) for n, f in zip(shape, factors, strict=True)]
    if palette.fits(factors):
        out = palette.voted(plain(data), shape, factors)
        return (gzip.compress(out, mtime=0) if out else None), small
    cube = np.zeros([n * f for n, f in zip(small, factors, strict=True)], np.uint64)
    cube[: shape[0], : shape[1], : shape[2]] = unpacked(data, shape)
    return packed(vote(cube, shape, factors)), small


def _piece(x: int, y: int, z: int, data: bytes, parent: Scale, child: Scale) -> tuple | None:
    """A stored chunk voted down: the chunk of the next scale, the place and size of the piece there, its bytes; None for background."""
    fx, fy, fz = axis_factors(parent, child)
    piece, small = _voted(data, inside(parent, x, y, z), (fz, fy, fx))
    side = [c // f for c, f in zip(parent.chunk, (fx, fy, fz), strict=True)]
    return (x // fx, y // fy, z // fz, x % fx * side[0], y % fy * side[1], z % fz * side[2], *small[::-1], piece) if piece else None


def _same_chunks(parent: Scale, child: Scale) -> None:
    if parent.chunk != child.chunk:
        raise ValueError("parent and child chunks differ in size")


def halved(encoded: DataFrame, parent: Scale, child: Scale) -> DataFrame:
    """Each stored chunk voted down where it lies, by its tables and indices (:mod:`.palette`): an encoded piece of a chunk of the next scale, none for background."""
    _same_chunks(parent, child)
    ship(encoded.sparkSession)
    names = [*AT, *_BOX, "encoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [p for p in (_piece(*row, parent, child) for row in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)) if p]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == 9 else pa.int32()) for k, c in enumerate(zip(*found, strict=True))], names=names)

    return encoded.select(*AT, "encoded").mapInArrow(run, _PIECE)


def downsampled(encoded: DataFrame, parent: Scale, child: Scale, home: str) -> DataFrame:
    """Stored chunks of the next scale (``home``, chunk_x.., encoded), voted and joined in one group function.

    ``home`` is a number that parents of one chunk share: rows that are partitioned by it are not exchanged.  A group is a
    chunk's parents, eight at most, encoded.  The results are those of :func:`halved` and :func:`put_together`.
    """
    _same_chunks(parent, child)
    ship(encoded.sparkSession)
    above = [f"_{a}" for a in AT]
    up = [F.expr(f"cast({a} div {f} as int)").alias(n) for a, f, n in zip(AT, axis_factors(parent, child), above, strict=True)]

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        at = [k.as_py() for k in key]
        pieces = [_piece(*row, parent, child) for row in zip(*(rows.column(c).to_pylist() for c in (*AT, "encoded")), strict=True)]
        found = [(p[5:2:-1], p[8:5:-1], p[9]) for p in pieces if p]
        whole = _whole(found, inside(child, *at[1:])) if found else None
        return pa.table([pa.array([at[0]], pa.int64()), *(pa.array([k], pa.int32()) for k in at[1:]), pa.array([whole], pa.binary())], names=[home, *AT, "encoded"])

    rows = encoded.select(home, *up, *AT, "encoded")
    return rows.groupBy(home, *above).applyInArrow(build, f"{home} long, chunk_x int, chunk_y int, chunk_z int, encoded binary").where("encoded is not null")


def _whole(found: list[tuple], shape: tuple[int, int, int]) -> bytes | None:
    """A stored chunk from encoded pieces (offset, size, data), block by block where they are whole blocks, else through their voxels."""
    if palette.aligned([(o, n) for o, n, _ in found], shape):
        return gzip.compress(palette.joined([(o, n, plain(d)) for o, n, d in found], shape), mtime=0)
    out = np.zeros(shape, np.uint64)
    for (oz, oy, ox), n, d in found:
        part = out[oz : oz + n[0], oy : oy + n[1], ox : ox + n[2]]
        part[:] = unpacked(d, n)[: part.shape[0], : part.shape[1], : part.shape[2]]
    return packed(out)


def put_together(pieces: DataFrame, scale: Scale) -> DataFrame:
    """Stored chunks (chunk_x.., encoded) from encoded pieces; eight, or a stride's, meet in a group, and only encoded bytes are exchanged.

    Pieces of whole blocks are joined block by block, others through their voxels.  Pieces of background only are not made, so
    neither is a chunk of it.
    """
    ship(pieces.sparkSession)

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        x, y, z = (k.as_py() for k in key)
        shape = inside(scale, x, y, z)
        found = [((r["oz"], r["oy"], r["ox"]), (r["nz"], r["ny"], r["nx"]), r["encoded"]) for r in rows.to_pylist()]
        whole = _whole(found, shape)
        return pa.table({**{n: pa.array([k.as_py()], pa.int32()) for n, k in zip(AT, key, strict=True)}, "encoded": pa.array([whole], pa.binary())})

    return pieces.groupBy(*AT).applyInArrow(build, "chunk_x int, chunk_y int, chunk_z int, encoded binary").where("encoded is not null")


def decoded(encoded: DataFrame, scale: Scale, keep: tuple[str, ...] = AT) -> DataFrame:
    """Stored chunks with ``voxels``, filled up with background beyond the volume."""
    ship(encoded.sparkSession)
    names = list(dict.fromkeys([*keep, *AT]))
    fields = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = [names.index(a) for a in AT]
        for b in batches:
            voxels = []
            for x, y, z, data in zip(*(b.column(k).to_pylist() for k in at), b.column(len(names)), strict=True):
                shape = inside(scale, x, y, z)
                out = np.zeros(scale.chunk[::-1], "<u8")
                out[: shape[0], : shape[1], : shape[2]] = unpacked(data.as_py(), shape)
                voxels.append(out.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(voxels, pa.binary())], names=[*names, "voxels"])

    return encoded.select(*names, "encoded").mapInArrow(run, f"{fields}, voxels binary")


def label_profile(chunks: DataFrame) -> DataFrame:
    """x, y, z and distinct labels, background left out, of every chunk."""
    ship(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = [int((np.unique(np.frombuffer(v.as_buffer(), "<u8")) != 0).sum()) for v in b.column(3)]
            at = [b.column(k).cast(pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*at, pa.array(counts, pa.int64())], names=["x", "y", "z", "unique_labels"])

    return chunks.select("chunk_x", "chunk_y", "chunk_z", "voxels").mapInArrow(run, "x long, y long, z long, unique_labels long")
