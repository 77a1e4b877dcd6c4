"""Block and segmentation codecs: numpy kernels and the Arrow stages that run them.

A compressed block holds a palette of 64-bit labels for a grid of 8x8x8 sub-blocks, each with its own short
palette and bit-packed voxels.  Kernels work on all sub-blocks of one bit width at once.  The stages take and
return int64 bit patterns (Spark has no unsigned types) and put a failing row's reason in an ``error`` column.
"""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SUB = 8
VOXELS = SUB**3
MAX_BLOCK = 16 << 20
LABELS, SUPERVOXELS = "labels", "supervoxels"


class CodecError(ValueError):
    """A block that can't be decoded or encoded."""


def inflate(data: bytes) -> bytes:
    """Zstandard content, 16 MiB at most; frames need not state their size."""
    import zstandard

    try:
        return zstandard.ZstdDecompressor().decompress(data, max_output_size=MAX_BLOCK)
    except zstandard.ZstdError as e:
        raise CodecError(f"zstd: {e}") from e


def bits_for(n: int) -> int:
    return max(0, n - 1).bit_length()


def packed_value(data: bytes, at: int, bits: int) -> int:
    """``bits`` bits from bit ``at`` on, most significant first."""
    first, last = at // 8, (at + bits + 7) // 8
    word = int.from_bytes(data[first:last], "big")
    return word >> (last * 8 - at - bits) & ((1 << bits) - 1)


def mapping(palette: np.ndarray, labels: np.ndarray | None, supervoxels: np.ndarray | None) -> np.ndarray:
    """Palette supervoxels as labels: unlisted ones stay, of repeated ones the last counts, extra ones are ignored."""
    if labels is None or supervoxels is None or not len(supervoxels):
        return palette
    n = min(len(labels), len(supervoxels))
    keys, last = np.unique(supervoxels[:n][::-1], return_index=True)
    values = labels[:n][::-1][last]
    at = np.minimum(np.searchsorted(keys, palette), len(keys) - 1)
    return np.where(keys[at] == palette, values[at], palette)


def decode_block(data: bytes, labels: np.ndarray | None = None, supervoxels: np.ndarray | None = None, shape: tuple[int, int, int] = (64, 64, 64)) -> np.ndarray:
    """uint64[z, y, x] of an uncompressed block; labels and supervoxels map the palette before any voxel is made."""
    if len(data) < 16:
        raise CodecError("no header")
    gx, gy, gz, n = struct.unpack_from("<4I", data)
    if (gz * SUB, gy * SUB, gx * SUB) != tuple(shape):
        raise CodecError(f"shape is {(gz * SUB, gy * SUB, gx * SUB)}, not {tuple(shape)}")
    if n == 0:
        raise CodecError("no labels")
    at = 16 + 8 * n
    if at > len(data):
        raise CodecError("labels are cut off")
    palette = mapping(np.frombuffer(data, "<u8", n, 16), labels, supervoxels)
    if n == 1:
        return np.full(shape, palette[0], np.uint64)
    blocks = gx * gy * gz
    if at + 2 * blocks > len(data):
        raise CodecError("sub-block sizes are cut off")
    sizes = np.frombuffer(data, "<u2", blocks, at).astype(np.int64)
    at += 2 * blocks
    total = int(sizes.sum())
    if at + 4 * total > len(data):
        raise CodecError("sub-block palettes are cut off")
    index = np.frombuffer(data, "<u4", total, at)
    if total and index.max() >= n:
        raise CodecError("a sub-block palette names a label that is not there")
    # Positions in the palette are put in place first and become labels once, at the end.
    index = index.astype(np.uint16 if n <= 1 << 16 else np.uint32)
    values = np.frombuffer(data, np.uint8, offset=at + 4 * total)
    start = np.cumsum(sizes) - sizes
    bits = np.where(sizes > 1, np.ceil(np.log2(np.maximum(sizes, 1))), 0).astype(np.int64)
    # 512 voxels of b bits fill 64 * b bytes, so every sub-block begins at a byte.
    begin = np.cumsum(64 * bits) - 64 * bits
    if 64 * int(bits.sum()) > len(values):
        raise CodecError("voxels are cut off")
    out = np.full((blocks, VOXELS), n, index.dtype if n < 1 << 16 else np.uint32)
    one = np.flatnonzero(sizes == 1)
    out[one] = index[start[one]][:, None]
    for b in np.unique(bits[sizes > 1]):
        which = np.flatnonzero((bits == b) & (sizes > 1))
        local = _opened(values[begin[which][:, None] + np.arange(64 * b)], int(b))
        if (local.max(1) >= sizes[which]).any():
            raise CodecError("a voxel lies beyond its sub-block's palette")
        out[which] = index.take(start[which].astype(np.int32)[:, None] + local)
    placed = out.reshape(gz, gy, gx, SUB, SUB, SUB).transpose(0, 3, 1, 4, 2, 5).reshape(shape)
    return np.append(palette, np.uint64(0)).take(placed)


def _opened(raw: np.ndarray, bits: int) -> np.ndarray:
    """Values of ``bits`` bits, most significant first, of rows of bytes: eight values are ``bits`` bytes, taken as one number."""
    if bits > 8:
        return np.unpackbits(raw, axis=1).reshape(len(raw), -1, bits) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int32))
    if bits == 1:
        return np.unpackbits(raw, axis=1)
    if bits == 8:
        return raw
    kind = np.uint8 if bits in (2, 4) else np.uint32 if bits == 3 else np.uint64
    step = 1 if bits in (2, 4) else bits
    groups = raw.reshape(len(raw), -1, step)
    word = groups[:, :, 0].astype(kind)
    for k in range(1, step):
        word = word << kind(8) | groups[:, :, k]
    out = np.empty((*word.shape, 8 * step // bits), np.uint8)
    for j in range(out.shape[2]):
        out[:, :, j] = word >> kind(8 * step - bits * (j + 1)) & kind((1 << bits) - 1)
    return out.reshape(len(raw), -1)


def encode_block(volume: np.ndarray) -> bytes:
    """The uncompressed block of a volume; inverse of :func:`decode_block`."""
    gz, gy, gx = (s // SUB for s in volume.shape)
    palette, index = np.unique(volume, return_inverse=True)
    head = struct.pack("<4I", gx, gy, gz, len(palette)) + palette.astype("<u8").tobytes()
    if len(palette) == 1:
        return head
    cells = index.reshape(gz, SUB, gy, SUB, gx, SUB).transpose(0, 2, 4, 1, 3, 5).reshape(-1, VOXELS)
    sizes, own, packed = [], [], []
    for cell in cells:
        local, where = np.unique(cell, return_inverse=True)
        sizes.append(len(local))
        own.append(local)
        if b := bits_for(len(local)):
            packed.append(np.packbits(where.reshape(-1, 1) >> np.arange(b - 1, -1, -1) & 1).tobytes())
    return head + np.array(sizes, "<u2").tobytes() + np.concatenate(own).astype("<u4").tobytes() + b"".join(packed)


def block_info(data: bytes | None) -> dict:
    """Kind (empty, zstd_error, invalid, solid, compressed, error) and header fields of a stored block."""
    if not data:
        return {"type": "empty"}
    try:
        return _block_info(data)
    except CodecError as e:
        return {"type": "zstd_error", "error": str(e), "compressed_bytes": len(data)}
    except Exception as e:  # noqa: BLE001  a probe tells what is wrong with a row and goes on
        return {"type": "error", "error": str(e)}


def _block_info(data: bytes) -> dict:
    plain = inflate(data)
    if len(plain) < 16:
        return {"type": "invalid", "compressed_bytes": len(data), "uncompressed_bytes": len(plain)}
    gx, gy, gz, n = struct.unpack_from("<4I", plain)
    return {"type": "solid" if n <= 1 else "compressed", "sub_blocks": gx * gy * gz, "label_count": n, "compressed_bytes": len(data), "uncompressed_bytes": len(plain)}


def encoding_bits(n: int) -> int:
    """Bits per voxel for a table of n labels."""
    if n > 1 << 16:
        raise CodecError(f"{n} labels in a block exceed 16 bits a voxel")
    return next(b for b in (0, 1, 2, 4, 8, 16) if n <= 1 << b)


def encode_segmentation(volume: np.ndarray, block: tuple[int, int, int] = (8, 8, 8)) -> bytes:
    """One channel of the block-table segmentation format, for uint64[z, y, x].

    Blocks go x fastest; each has its sorted label table, written once per distinct table, and voxel indices
    packed from the low bits of 32-bit words; places outside the volume have index 0.
    """
    return encode_cells(cells_of(volume, block))


def cells_of(volume: np.ndarray, block: tuple[int, int, int]) -> np.ndarray:
    """A row of voxels per block; places outside the volume hold their block's smallest."""
    grid = [-(-n // b) for n, b in zip(volume.shape, block, strict=True)]
    full = [g * b for g, b in zip(grid, block, strict=True)]
    pairs = [n for pair in zip(grid, block, strict=True) for n in pair]
    rows = lambda a: a.reshape(pairs).transpose(0, 2, 4, 1, 3, 5).reshape(-1, int(np.prod(block)))
    if tuple(full) == volume.shape:
        return rows(volume)
    own = tuple(slice(n) for n in volume.shape)
    padded, outside = np.full(full, np.iinfo(volume.dtype).max, volume.dtype), np.ones(full, bool)
    padded[own], outside[own] = volume, False
    cells = rows(padded)
    return np.where(rows(outside), cells.min(1, keepdims=True), cells)


def encode_cells(cells: np.ndarray, palette: np.ndarray | None = None) -> bytes:
    """The encoded channel of blocks, a row each: labels or, with a sorted ``palette``, positions in it.

    Tables of up to 16 labels are made for all blocks at once, a pass for each next smallest label; only blocks of more are sorted.
    """
    label = (lambda v: v) if palette is None else palette.__getitem__
    top, few = np.iinfo(cells.dtype).max, 16
    index, sizes = np.zeros(cells.shape, np.uint8), np.ones(len(cells), np.int64)
    tables = np.zeros((len(cells), few), cells.dtype)
    tables[:, 0] = now = cells.min(1)
    left, own = np.arange(len(cells)), cells
    for k in range(1, few + 1):
        above = own > now[:, None]
        some = above.any(1)
        left, own, above = left[some], own[some], above[some]
        if not len(left) or k == few:
            break
        index[left] += above
        sizes[left] += 1
        tables[left, k] = now = np.where(above, own, top).min(1)
    sizes[left] = few + 1
    keys, words = label(tables).astype("<u8"), {0: {}}
    bits = np.array([0, *(encoding_bits(n) for n in range(1, few + 1)), -1])[sizes]
    for width in (1, 2, 4):
        which, per = np.flatnonzero(bits == width), 8 // width
        padded = np.pad(index[which], ((0, 0), (0, -cells.shape[1] % (32 // width))))
        padded = padded.reshape(len(which), padded.shape[1] // per, per)
        words[width] = dict(zip(which.tolist(), (padded << (width * np.arange(per, dtype=np.uint8))).sum(2, dtype=np.uint8), strict=True))
    parts = []
    for k, (n, width) in enumerate(zip(sizes.tolist(), bits.tolist(), strict=True)):
        if n <= few:
            parts.append((keys[k, :n].tobytes(), width, words[width][k].tobytes() if width else b""))
        else:
            found, where = np.unique(cells[k], return_inverse=True)
            width = encoding_bits(len(found))
            parts.append((label(found).astype("<u8").tobytes(), width, _packed(where.ravel().astype(np.uint64), width)))
    return laid_out(parts)


def laid_out(parts: list[tuple[bytes, int, bytes]]) -> bytes:
    """A channel from its blocks' tables, bits and index words, in order."""
    head = np.zeros((len(parts), 2), "<u4")
    body: list[bytes] = []
    tables: dict[bytes, int] = {}
    at = 2 * len(head)  # in words from the channel's start
    for k, (key, width, words) in enumerate(parts):
        start, at = at, at + len(words) // 4
        body.append(words)
        if key not in tables:
            tables[key] = at
            body.append(key)
            at += len(key) // 4
        if tables[key] >> 24:
            raise CodecError("a label table begins beyond the format's 24 bits")
        head[k] = tables[key] | width << 24, start
    return struct.pack("<I", 1) + head.tobytes() + b"".join(body)


def _packed(index: np.ndarray, bits: int) -> bytes:
    if not bits:
        return b""
    per = 32 // bits
    padded = np.zeros(-(-len(index) // per) * per, np.uint64)
    padded[: len(index)] = index
    return (padded.reshape(-1, per) << (bits * np.arange(per, dtype=np.uint64))).sum(1).astype("<u4").tobytes()


def decode_segmentation(data: bytes, shape: tuple[int, int, int], block: tuple[int, int, int] = (8, 8, 8)) -> np.ndarray:
    """Inverse of :func:`encode_segmentation`; all blocks of one bit width at once."""
    words = np.frombuffer(data, "<u4")[1:]
    grid = [-(-n // b) for n, b in zip(shape, block, strict=True)]
    blocks, n = int(np.prod(grid)), int(np.prod(block))
    if len(words) < 2 * blocks:
        raise CodecError("block headers are cut off")
    heads = words[: 2 * blocks].reshape(blocks, 2).astype(np.int64)
    tables, widths, values = heads[:, 0] & 0xFFFFFF, heads[:, 0] >> 24, heads[:, 1]
    out = np.zeros((blocks, n), np.uint64)
    for bits in np.unique(widths).tolist():
        which = np.flatnonzero(widths == bits)
        index = np.zeros((len(which), 1), np.int64)
        if bits:
            per = 32 // bits
            at = values[which][:, None] + np.arange(-(-n // per))
            if at.size and at.max() >= len(words):
                raise CodecError("voxels are cut off")
            index = (words[at][:, :, None] >> (bits * np.arange(per, dtype=np.uint32)) & np.uint32((1 << bits) - 1)).reshape(len(which), -1)[:, :n].astype(np.int64)
        at = tables[which][:, None] + 2 * index
        if at.size and at.max() + 1 >= len(words):
            raise CodecError("a label table is cut off")
        out[which] = words[at].astype(np.uint64) | words[at + 1].astype(np.uint64) << np.uint64(32)
    whole = out.reshape(*grid, *block).transpose(0, 3, 1, 4, 2, 5).reshape([g * b for g, b in zip(grid, block, strict=True)])
    return whole[: shape[0], : shape[1], : shape[2]]


def encoded_bound(shape: tuple[int, int, int], block: tuple[int, int, int] = (8, 8, 8)) -> int:
    blocks = int(np.prod([-(-n // b) for n, b in zip(shape, block, strict=True)]))
    n = int(np.prod(block))
    return 4 + 8 * blocks + blocks * 4 * ((16 * n + 31) // 32 + 2 * n)


def transcode(data: bytes | None, labels: np.ndarray | None = None, supervoxels: np.ndarray | None = None, compressed: bool = True, gzipped: bool = True, shape: tuple[int, int, int] = (64, 64, 64)) -> bytes:
    """A stored block as an encoded segmentation, in one go: inflate, map, decode, encode, gzip."""
    if labels is not None and supervoxels is not None and len(labels) != len(supervoxels):
        raise CodecError("labels and supervoxels differ in length")
    if not data:
        volume = np.zeros(shape, np.uint64)
    else:
        volume = decode_block(inflate(data) if compressed else data, labels, supervoxels, shape)
    out = encode_segmentation(volume)
    return gzip.compress(out, mtime=0) if gzipped else out


# --- Arrow stages -----------------------------------------------------------------------------------------

KEYS = ("chunk_x", "chunk_y", "chunk_z")


def _lists(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x.values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64) if x.is_valid else np.empty(0, np.uint64) for x in column]


def _mapped(chunks: DataFrame, keep: tuple[str, ...], fields: list[T.StructField], label_type: str, work, at: bool = False) -> DataFrame:
    """Run ``work(block, labels or None, supervoxels or None)`` over chunk rows; failures become ``error``.

    ``at``: the last three kept columns, the chunk's coordinates, are more arguments.
    """
    if label_type not in (LABELS, SUPERVOXELS):
        raise ValueError(f"label_type is {LABELS} or {SUPERVOXELS}")
    schema = T.StructType([*(chunks.schema[k] for k in keep), *fields, T.StructField("error", T.StringType())])
    types = [pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.list_(pa.int64()) if isinstance(f.dataType, T.ArrayType) else pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in fields]
    use_map, n = label_type == LABELS, len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in fields]
            errors: list[str | None] = []
            where = zip(*(b.column(k).to_pylist() for k in range(n - 3, n)), strict=True) if at else [()] * len(b)
            for block, own, sv, more in zip(b.column(n), _lists(b.column(n + 1)), _lists(b.column(n + 2)), where, strict=True):
                try:
                    got = work(block.as_py(), own if use_map else None, sv if use_map else None, *more)
                    errors.append(None)
                except CodecError as e:
                    got = (None,) * len(fields)
                    errors.append(str(e))
                for x, y in zip(out, got, strict=True):
                    x.append(y)
            arrays = [*b.columns[:n], *(pa.array(x, t) for x, t in zip(out, types, strict=True)), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    from lamellar.session import ship

    ship(chunks.sparkSession)
    return chunks.select(*keep, "block", "labels", "supervoxels").mapInArrow(run, schema)


def _stored(block: bytes | None, labels, supervoxels, shape) -> np.ndarray:
    return np.zeros(shape, np.uint64) if not block else decode_block(inflate(block), labels, supervoxels, shape)


def decode(chunks: DataFrame, label_type: str = LABELS, shape: tuple[int, int, int] = (64, 64, 64), keep: tuple[str, ...] = KEYS) -> DataFrame:
    """Chunks with ``voxels``, the volume's little-endian bytes in z, y, x order."""
    return _mapped(chunks, keep, [T.StructField("voxels", T.BinaryType())], label_type, lambda b, l, s: (_stored(b, l, s, shape).astype("<u8").tobytes(),))


def decoded_labels(chunks: DataFrame, label_type: str = LABELS, shape: tuple[int, int, int] = (64, 64, 64), keep: tuple[str, ...] = KEYS) -> DataFrame:
    """Distinct labels of decoded chunks and their voxel counts, without sending voxels back."""

    def work(b, l, s):
        values, counts = np.unique(_stored(b, l, s, shape), return_counts=True)
        return values.view(np.int64).tolist(), counts.tolist()

    array = T.ArrayType(T.LongType())
    return _mapped(chunks, keep, [T.StructField("values", array), T.StructField("counts", array)], label_type, work)


def to_segmentation(chunks: DataFrame, label_type: str = LABELS, gzipped: bool = True, shape: tuple[int, int, int] = (64, 64, 64), keep: tuple[str, ...] = KEYS) -> DataFrame:
    """Chunks transcoded to the segmentation format, all steps in one stage."""
    return _mapped(chunks, keep, [T.StructField("encoded", T.BinaryType())], label_type, lambda b, l, s: (transcode(b, l, s, gzipped=gzipped, shape=shape),))


def from_segmentation(encoded: DataFrame, shape: tuple[int, int, int] = (64, 64, 64), gzipped: bool = True, keep: tuple[str, ...] = KEYS) -> DataFrame:
    """Chunks with ``voxels`` from their ``encoded`` segmentation; null stays null."""
    from lamellar.session import ship

    ship(encoded.sparkSession)
    schema = T.StructType([*(encoded.schema[k] for k in keep), T.StructField("voxels", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            plain = [None if x is None else gzip.decompress(x) if gzipped else x for x in b.column(len(keep)).to_pylist()]
            voxels = [None if x is None else decode_segmentation(x, shape).astype("<u8").tobytes() for x in plain]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(voxels, pa.binary())], names=schema.names)

    return encoded.select(*keep, "encoded").mapInArrow(run, schema)


def info(chunks: DataFrame, keep: tuple[str, ...] = KEYS) -> DataFrame:
    """Kind and header fields of stored blocks."""
    fields = [T.StructField("type", T.StringType()), *(T.StructField(k, T.LongType()) for k in ("sub_blocks", "label_count", "compressed_bytes", "uncompressed_bytes"))]
    names = [f.name for f in fields]
    return _mapped(chunks, keep, fields, SUPERVOXELS, lambda b, l, s: tuple(map(block_info(b).get, names)))
