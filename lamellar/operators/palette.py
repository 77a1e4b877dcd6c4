"""Votes and joins on encoded chunks, by their blocks' tables and indices.

An encoded chunk is a grid of blocks, each a table of labels and an index per voxel.  Blocks of one label vote by their table
alone, blocks of two by counting ones, and of the others only those cells that are mixed compare their voxels.  Joining pieces
copies whole blocks.  Labels are never spread out to 8 bytes a voxel; results are the bytes that encoding the voxels would give.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .codecs import CodecError, cells_of, encode_cells, laid_out

Box = tuple[int, int, int]
BLOCK: Box = (8, 8, 8)


@dataclass
class Blocks:
    """A chunk's blocks: ``index`` by bit width is (which blocks, their voxels' indices); ``first`` is where a block's entries begin in ``labels``."""

    grid: list[int]
    widths: np.ndarray
    index: dict[int, tuple[np.ndarray, np.ndarray]]
    sizes: np.ndarray
    first: np.ndarray
    labels: np.ndarray
    words: np.ndarray
    values: np.ndarray


def parse(data: bytes, shape: Box, block: Box = BLOCK) -> Blocks:
    """Tables and indices of an encoded chunk; of a table only the entries up to the last one used are known and read."""
    words = np.frombuffer(data, "<u4")[1:]
    grid = [-(-n // b) for n, b in zip(shape, block, strict=True)]
    count, n = int(np.prod(grid)), int(np.prod(block))
    if len(words) < 2 * count:
        raise CodecError("block headers are cut off")
    heads = words[: 2 * count].reshape(count, 2).astype(np.int64)
    tables, widths, values = heads[:, 0] & 0xFFFFFF, heads[:, 0] >> 24, heads[:, 1]
    index, sizes = {}, np.ones(count, np.int64)
    for bits in np.unique(widths).tolist():
        which = np.flatnonzero(widths == bits)
        if not bits:
            index[0] = which, np.zeros((len(which), 1), np.uint8)
            continue
        per = 32 // bits
        at = values[which][:, None] + np.arange(-(-n // per))
        if at.max() >= len(words):
            raise CodecError("voxels are cut off")
        if bits < 8:
            raw = np.unpackbits(words[at].view(np.uint8), axis=1, bitorder="little").reshape(len(which), -1, bits)
            own = raw[:, :n, 0] if bits == 1 else (raw << np.arange(bits, dtype=np.uint8)).sum(2, dtype=np.uint8)[:, :n]
        else:
            own = words[at].view(np.uint8 if bits == 8 else "<u2")[:, :n]
        index[bits] = which, own
        sizes[which] = own.max(1).astype(np.int64) + 1
    first = np.cumsum(sizes) - sizes
    at = np.repeat(tables - 2 * first, sizes) + 2 * np.arange(int(sizes.sum()))
    if at.size and at.max() + 1 >= len(words):
        raise CodecError("a label table is cut off")
    labels = words[at].astype(np.uint64) | words[at + 1].astype(np.uint64) << np.uint64(32)
    return Blocks(grid, widths, index, sizes, first, labels, words, values)


def _split(a: np.ndarray, block: Box, factors: Box) -> np.ndarray:
    """(blocks, cells of a block, voxels of a cell) of a row of voxels per block."""
    sides = [n for b, f in zip(block, factors, strict=True) for n in (b // f, f)]
    return a.reshape(len(a), *sides).transpose(0, 1, 3, 5, 2, 4, 6).reshape(len(a), -1, int(np.prod(factors)))


def _most(v: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """The most frequent of each row's values where ``ok``, the smallest of equals; a row without any keeps its first value."""
    top = np.iinfo(v.dtype).max
    own = np.where(ok, v, top)
    out = own.min(1)
    none = ~ok.any(1)
    out[none] = v[none, 0]
    mixed = np.flatnonzero((np.where(ok, v, out[:, None]) != out[:, None]).any(1) & ~none)
    if len(mixed):
        some, right = own[mixed], ok[mixed]
        votes = np.zeros(some.shape, np.int16)
        for j in range(some.shape[1]):
            votes += (some == some[:, j : j + 1]) & right
        votes[~right] = -1
        out[mixed] = np.where(votes == votes.max(1, keepdims=True), some, top).min(1)
    return out


def fits(factors: Box, block: Box = BLOCK) -> bool:
    """Whether cells never cross a block, so that :func:`voted` can take them."""
    return all(b % f == 0 for b, f in zip(block, factors, strict=True))


def voted(data: bytes, shape: Box, factors: Box, block: Box = BLOCK) -> bytes | None:
    """A chunk of ``shape`` (all of it inside the volume) downsampled by majority, encoded; None where background is all that stays.

    The smallest label wins ties, background votes as 0, places beyond the shape don't vote.
    """
    b = parse(data, shape, block)
    palette, ranks = np.unique(b.labels, return_inverse=True)
    ranks = ranks.ravel().astype(np.int32)
    cells = int(np.prod(block)) // int(np.prod(factors))
    out = np.zeros((len(b.widths), cells), np.int32)
    full = [g * n for g, n in zip(b.grid, block, strict=True)]
    inside = None
    if tuple(full) != tuple(shape):
        inside = np.zeros(full, bool)
        inside[tuple(slice(n) for n in shape)] = True
        inside = _split(cells_of(inside.view(np.uint8), block), block, factors).astype(bool)
    for bits, (which, index) in b.index.items():
        first = b.first[which]
        if not bits:
            out[which] = ranks[first][:, None]
            continue
        split = _split(index, block, factors)
        ok = inside[which] if inside is not None else None
        if bits == 1 and (b.sizes[which] == 2).all():
            one = (split if ok is None else split * ok).sum(2, dtype=np.int32)
            zero = (split.shape[2] if ok is None else ok.sum(2, dtype=np.int32)) - one
            low, high = ranks[first][:, None], ranks[first + 1][:, None]
            out[which] = np.where((one > zero) | ((one == zero) & (high < low)), high, low)
            continue
        v = ranks[first[:, None, None] + split].reshape(-1, split.shape[2])
        out[which] = _most(v, np.ones(v.shape, bool) if ok is None else ok.reshape(v.shape)).reshape(len(which), cells)
    if not palette[out].any():
        return None
    small = [n // f for n, f in zip(block, factors, strict=True)]
    cube = out.reshape(*b.grid, *small).transpose(0, 3, 1, 4, 2, 5).reshape([g * n for g, n in zip(b.grid, small, strict=True)])
    cube = cube[tuple(slice(-(-n // f)) for n, f in zip(shape, factors, strict=True))]
    return encode_cells(cells_of(np.ascontiguousarray(cube), block), palette) if palette[cube].any() else None


def aligned(boxes: list[tuple[Box, Box]], shape: Box, block: Box = BLOCK) -> bool:
    """Whether pieces (offset, size) are whole blocks of a chunk, each once, but for the chunk's end."""
    ends = lambda o, n, s, b: o % b == 0 and o + n <= s and (n % b == 0 or o + n == s)
    return len({o for o, _ in boxes}) == len(boxes) and all(ends(*z) for o, n in boxes for z in zip(o, n, shape, block, strict=True))


def joined(pieces: list[tuple[Box, Box, bytes]], shape: Box, block: Box = BLOCK) -> bytes:
    """An encoded chunk from encoded pieces (offset, size, data) that are :func:`aligned` and don't overlap; the rest is background."""
    grid = [-(-n // b) for n, b in zip(shape, block, strict=True)]
    parts: list[tuple[bytes, int, bytes]] = [(bytes(8), 0, b"")] * int(np.prod(grid))
    n = int(np.prod(block))
    for offset, size, data in pieces:
        b = parse(data, size, block)
        corner = [o // k for o, k in zip(offset, block, strict=True)]
        labels = b.labels.astype("<u8")
        long = {w: -(-n // (32 // w)) if w else 0 for w in b.index}
        for k, (z, y, x) in enumerate(np.ndindex(*b.grid)):
            width, at, first = int(b.widths[k]), int(b.values[k]), int(b.first[k])
            place = ((corner[0] + z) * grid[1] + corner[1] + y) * grid[2] + corner[2] + x
            parts[place] = labels[first : first + int(b.sizes[k])].tobytes(), width, b.words[at : at + long[width]].tobytes()
    return laid_out(parts)
