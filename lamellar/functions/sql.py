"""Geometry and models as SQL functions, for queries written as text.

    register(spark); register_scale(spark, "s0", scale)
    spark.sql("SELECT s0_shard_file(s0_shard(s0_morton(cx, cy, cz))), count(*) FROM chunks GROUP BY 1")

They are SQL-bodied temporary functions: Catalyst inlines them, so they cost what the column functions cost.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import models
from .geometry import Scale


def _define(spark: SparkSession, name: str, arguments: str, kind: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")


def _by_scale(values: dict[int, float], default: float) -> str:
    return "CASE scale " + " ".join(f"WHEN {k} THEN {float(v)}D" for k, v in values.items()) + f" ELSE {float(default)}D END"


def register(spark: SparkSession) -> None:
    """bits_for, unsigned_label, error_class, export_gib, pick_tier."""
    _define(spark, "bits_for", "n BIGINT", "INT", "CASE WHEN n < 2 THEN 0 ELSE length(bin(n - 1)) END")
    _define(spark, "unsigned_label", "v BIGINT", "DECIMAL(20, 0)", "CAST(CASE WHEN v < 0 THEN CAST(v AS DECIMAL(20, 0)) + CAST('18446744073709551616' AS DECIMAL(20, 0)) ELSE CAST(v AS DECIMAL(20, 0)) END AS DECIMAL(20, 0))")
    rules = [("contains(lower(m), 'zstd')", "zstd_decompression"), ("contains(m, 'CURL error')", "curl_gcs"), ("contains(lower(m), 'not found')", "file_not_found"), ("contains(lower(m), 'timeout')", "timeout"), ("contains(lower(m), 'memory') OR contains(lower(m), 'oom')", "memory_pressure")]
    _define(spark, "error_class", "m STRING", "STRING", "CASE " + " ".join(f"WHEN {c} THEN '{k}'" for c, k in rules) + " ELSE 'other' END")
    gib = f"{models.GIB}D"
    size = f"chunks * ({_by_scale(models.BYTES_PER_CHUNK, models.BYTES_PER_CHUNK_DEFAULT)}) / {gib}"
    _define(spark, "export_gib", "arrow_bytes BIGINT, chunks BIGINT, scale INT", "DOUBLE", f"arrow_bytes / {gib} + 2 * ({size}) + {models.SHARD_OVERHEAD_GIB}D")
    tiers = sorted(models.TIER_CPU)
    _define(spark, "pick_tier", "gib DOUBLE", "INT", "CASE " + " ".join(f"WHEN gib <= {t} THEN {t}" for t in tiers) + f" ELSE {tiers[-1]} END")


def register_scale(spark: SparkSession, prefix: str, scale: Scale) -> None:
    """{prefix}_morton(x, y, z), {prefix}_shard(code), {prefix}_minishard(code), {prefix}_shard_file(number)."""
    bits = [f"shiftleft(shiftright({'xyz'[axis]}, {level}) & 1, {place})" for place, (axis, level) in enumerate(scale.plan)]
    _define(spark, f"{prefix}_morton", "x BIGINT, y BIGINT, z BIGINT", "BIGINT", " | ".join(bits) or "0")

    def field(low: int, width: int) -> str:
        if low >= 64:
            return "0"
        own = f"shiftrightunsigned(code, {low})"
        return own if width >= 64 else f"{own} & {(1 << width) - 1}L"

    _define(spark, f"{prefix}_shard", "code BIGINT", "BIGINT", field(scale.low, scale.shard))
    _define(spark, f"{prefix}_minishard", "code BIGINT", "BIGINT", field(scale.preshift, scale.minishard))
    width = max(1, -(-scale.shard // 4))
    _define(spark, f"{prefix}_shard_file", "n BIGINT", "STRING", f"concat(CASE WHEN length(hex(n)) < {width} THEN lpad(lower(hex(n)), {width}, '0') ELSE lower(hex(n)) END, '.shard')")
