"""Bit counts, size bounds and unsigned 64-bit numbers as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOP = -(1 << 63)


def bits_for(n: Column) -> Column:
    """Bits that index n values: ceil(log2 n), 0 below 2."""
    return F.when(n < 2, 0).otherwise(F.length(F.bin((n - 1).cast("long")))).cast("int")


def encoding_bits(n: Column) -> Column:
    """Bits per voxel of a table of n labels: the next of 0, 1, 2, 4, 8, 16, 32."""
    out = F.when(n <= 1, 0)
    for b in (1, 2, 4, 8, 16):
        out = out.when(n <= 1 << b, b)
    return out.otherwise(32).cast("int")


def encoded_bound(nz: Column, ny: Column, nx: Column, bz: int = 8, by: int = 8, bx: int = 8) -> Column:
    """Largest size in bytes of an encoded chunk: headers, 16-bit indices and a full table for every block."""
    blocks = F.ceil(nz / bz) * F.ceil(ny / by) * F.ceil(nx / bx)
    words = (16 * bz * by * bx + 31) // 32 + 2 * bz * by * bx
    return (4 + blocks * 8 + blocks * (words * 4)).cast("long")


def unsigned(v: Column) -> Column:
    """The unsigned value of a 64-bit pattern, as a decimal."""
    own = v.cast("decimal(20,0)")
    return F.when(v < 0, own + F.lit(str(1 << 64)).cast("decimal(20,0)")).otherwise(own).cast("decimal(20,0)")


def unsigned_order(v: Column) -> Column:
    """A signed key that sorts 64-bit patterns as unsigned."""
    return v.bitwiseXOR(F.lit(_TOP))
