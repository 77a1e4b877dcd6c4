"""Memory cost models, tiers and regression as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calibrated constants that results depend on.
BYTES_PER_CHUNK = {0: 13_932, 1: 27_919, 2: 44_482, 3: 78_376, 4: 130_244, 5: 199_396, 6: 258_999, 7: 170_713, 8: 159_269, 9: 129_385}
BYTES_PER_CHUNK_DEFAULT = 80_000
BYTES_PER_LABEL = {0: 394, 1: 341, 2: 153, 3: 55, 4: 23, 5: 13}
BYTES_PER_LABEL_DEFAULT = 13
KB_PER_CHUNK_OLD = {0: 150, 1: 200, 2: 280, 3: 400, 4: 530, 5: 630, 6: 750, 7: 530, 8: 570, 9: 430}
KB_PER_CHUNK_OLD_DEFAULT = 400
COMMIT_SPIKE_GIB = {1: 0.5, 2: 1.5, 3: 1.5, 4: 2.0}
COMMIT_SPIKE_DEFAULT_GIB = 2.0
SHARD_OVERHEAD_GIB = 2.0
SOURCE_CACHE_GIB, DEST_CACHE_GIB, RUNTIME_GIB, READBACK_GIB = 0.25, 0.25, 0.5, 0.5
READBACK_BYTES_PER_LABEL, READBACK_FROM_SCALE = 80, 4
SAFETY = 1.2
TIER_CPU = {4: 2, 8: 2, 16: 4, 24: 6, 32: 8}
PARALLEL_GIB = 40_000

GIB = float(1 << 30)


def per_scale(scale: Column, values: dict[int, float], default: float) -> Column:
    """A constant by scale: a CASE over literals, so no join."""
    out = None
    for k, v in values.items():
        out = F.when(scale == k, F.lit(float(v))) if out is None else out.when(scale == k, F.lit(float(v)))
    return out.otherwise(F.lit(float(default)))


def output_gib(chunks: Column, scale: Column) -> Column:
    return chunks * per_scale(scale, BYTES_PER_CHUNK, BYTES_PER_CHUNK_DEFAULT) / F.lit(GIB)


def export_gib(arrow_bytes: Column, chunks: Column, scale: Column) -> Column:
    """Memory to convert a source shard: the file, twice the output, fixed overhead."""
    return arrow_bytes / F.lit(GIB) + 2 * output_gib(chunks, scale) + F.lit(SHARD_OVERHEAD_GIB)


def pick_tier(gib: Column, least: int = 4) -> Column:
    """Smallest tier that holds the need and is at least ``least``; the largest if none does."""
    out = None
    for t in sorted(t for t in TIER_CPU if t >= least):
        out = F.when(gib <= t, F.lit(t)) if out is None else out.when(gib <= t, F.lit(t))
    top = F.lit(max(TIER_CPU))
    return (top if out is None else out.otherwise(top)).cast("int")


def tier_cpu(tier: Column) -> Column:
    return per_scale(tier, TIER_CPU, max(TIER_CPU.values())).cast("int")


def parallelism(tasks: Column, tier: Column) -> Column:
    """Tasks at once under the total memory cap."""
    return F.least(tasks.cast("long"), F.floor(F.lit(PARALLEL_GIB) / tier))


def downres(scale: Column, chunks: Column, labels: Column | None = None) -> dict[str, Column]:
    """Parts of the downsampling estimate; label-aware where ``labels`` is known, else by chunk count."""
    known = labels.isNotNull() if labels is not None else F.lit(False)
    count = labels if labels is not None else F.lit(None).cast("long")
    by_label = count * per_scale(scale, BYTES_PER_LABEL, BYTES_PER_LABEL_DEFAULT) / F.lit(GIB)
    out = F.when(known, by_label).otherwise(output_gib(chunks, scale))
    raw = F.greatest(F.lit(1.0), F.floor(F.pow(chunks.cast("double"), F.lit(2 / 3))).cast("double")) * 2 * float(1 << 20) / F.lit(GIB)
    dynamic = F.greatest(F.lit(READBACK_GIB), count * float(READBACK_BYTES_PER_LABEL) / F.lit(GIB))
    readback = F.when(known & (scale >= READBACK_FROM_SCALE), dynamic).otherwise(F.lit(READBACK_GIB))
    spike = per_scale(scale, COMMIT_SPIKE_GIB, COMMIT_SPIKE_DEFAULT_GIB)
    fixed = F.lit(SOURCE_CACHE_GIB + DEST_CACHE_GIB + RUNTIME_GIB)
    subtotal = raw + 2 * out + fixed + readback + spike
    return {
        "estimate_model": F.when(known, F.lit("label_aware")).otherwise(F.lit("chunk_count")), "output_gib": out, "raw_batch_gib": raw,
        "label_readback_gib": readback, "commit_spike_gib": spike, "overhead_gib": fixed + readback, "subtotal_gib": subtotal, "total_gib": subtotal * SAFETY,
    }


def old_gib(arrow_bytes: Column, chunks: Column, scale: Column) -> Column:
    """The former chunk-count formula."""
    size = chunks * per_scale(scale, KB_PER_CHUNK_OLD, KB_PER_CHUNK_OLD_DEFAULT) / F.lit(float(1 << 20))
    return (arrow_bytes / F.lit(GIB) + 1.3 * size + 1.5) * 1.3


def scaled_gib(arrow_bytes: Column, output_bytes: Column) -> Column:
    """The formula over a known or predicted output size."""
    return (arrow_bytes / F.lit(GIB) + output_bytes / F.lit(GIB) + 1.5) * 1.15


def cpus_for(gib: Column) -> Column:
    return F.when(gib <= 8, 2).when(gib <= 16, 4).when(gib <= 24, 6).otherwise(8).cast("int")
