"""Whole runs: which scales are exported or downsampled, in which order, and when a run stops.

A run goes scale by scale: plan, write, verify.  The first scale comes from source shards, each further one from the
scale before, read back from its files.  A scale that is not complete stops the run.  Tasks and tiers of a plan are
its report; Spark's scheduler does the work.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale, child_shards, shard_filename
from lamellar.operators import codecs, planning, telemetry, verification
from lamellar.session import materialize, remove
from lamellar.sources import volumes
from lamellar.sources.shards import index_entries, list_shards

from . import ledger, pipelines

EXPORT, PYRAMID, ALL, RETRY, RESUME = "export", "pyramid", "all", "retry", "resume"


class RunStopped(RuntimeError):
    """A scale that is not complete; ``results`` are those of the scales so far."""

    def __init__(self, message: str, results: list[ScaleResult]):
        super().__init__(message)
        self.results = results


@dataclass
class ScaleResult:
    """What a run planned and did for a scale."""

    level: int
    planned: dict[int, int] = field(default_factory=dict)  # shards by tier
    missing: int = 0
    orphaned: int = 0
    shards_failed: int = 0
    chunks_failed: int = 0
    seconds: float = 0.0


def source_table(spark: SparkSession, source: str, level: int) -> DataFrame:
    """Source shards with scale, bytes and chunks; chunks are counted from the indexes beside the files."""
    files = list_shards(spark, source).select("shard", "bytes")
    chunks = index_entries(spark, source).groupBy("shard").agg(F.count(F.lit(1)).alias("chunks"))
    return files.join(chunks, "shard", "left").select(F.lit(level).alias("scale"), "shard", "bytes", F.coalesce("chunks", F.lit(0)).alias("chunks"))


def _tiers(plan: DataFrame) -> dict[int, int]:
    return {r["tier_gib"]: r["count"] for r in plan.groupBy("tier_gib").count().collect()}


def run(
    spark: SparkSession, source: str, out: str, scales: list[Scale], mode: str = ALL, dry_run: bool = False, label_type: str = codecs.LABELS, z_compress: int = 0, max_tasks: int = 5000,
    limit_minutes: float | None = None,
) -> list[ScaleResult]:
    """Run a mode over ``scales`` (the first is the sources' own) and verify each scale; the scales' results.

    export: the first scale; pyramid: the others; all: both; retry: only source shards whose output is missing, then
    the others; resume: only source shards that are new or changed since the ledger has them, then the others.  ``dry_run`` plans and writes nothing.  No scale is begun after ``limit_minutes``.  Source shards that
    hold background only need no output.
    """
    if mode not in (EXPORT, PYRAMID, ALL, RETRY, RESUME):
        raise ValueError(f"mode is one of {EXPORT}, {PYRAMID}, {ALL}, {RETRY}, {RESUME}")
    began, results = time.monotonic(), []
    levels = ([0] if mode != PYRAMID else []) + (list(range(1, len(scales))) if mode != EXPORT else [])
    for level in levels:
        if limit_minutes is not None and time.monotonic() - began > 60 * limit_minutes:
            raise RunStopped(f"no time is left for scale {level}", results)
        start, result = time.monotonic(), ScaleResult(level)
        results.append(result)
        if level == 0:
            _first(spark, source, out, scales[0], mode, dry_run, label_type, z_compress, max_tasks, result)
        else:
            _next(spark, out, scales, level, dry_run, max_tasks, result)
        result.seconds = time.monotonic() - start
        if not dry_run and (result.missing or result.orphaned):
            raise RunStopped(f"scale {level}: {result.missing} outputs are missing, {result.orphaned} have no source", results)
        if dry_run and level == 0:
            break  # what the next scale would read is not there
    return results


def _first(spark, source: str, out: str, scale: Scale, mode: str, dry_run: bool, label_type: str, z_compress: int, max_tasks: int, result: ScaleResult) -> None:
    sources = source_table(spark, source, 0)
    there = pipelines.written_files(spark, out, 0) if mode == RETRY and volumes.scales_at(out) else None
    states = materialize(ledger.source_states(spark, source, scale, z_compress), "states")
    if mode == RESUME and volumes.scales_at(out):
        states = materialize(ledger.unfinished(spark, states, out, 0), "unfinished")
        sources = sources.join(states.select("shard"), "shard", "left_semi").select(sources.columns)
    plan = planning.export_plan(sources, scale, outputs=there, max_tasks=max_tasks, z_compress=z_compress)
    result.planned = _tiers(plan)
    if dry_run:
        return
    if result.planned:
        encoded = pipelines.encode_source(spark, source, scale, label_type, z_compress, only=plan if mode in (RETRY, RESUME) else None)
        pipelines.write_encoded(encoded, out, scale, 0, z_compress)
        totals = telemetry.outcome_totals(verification.shard_outcomes(encoded, scale, z_compress)).head()
        result.shards_failed, result.chunks_failed = totals["shards_failed"], totals["failed"]
        written = pipelines.written_files(spark, out, 0)
        broken = encoded.where("error is not null").select("shard").distinct()
        own = states.join(plan.select("shard").distinct(), "shard", "left_semi").join(broken, "shard", "left_anti").join(written, "file", "left_semi")
        ledger.record(own, out, 0)
        remove(encoded)
    compared = pipelines.compare(spark, source, out, scale, 0, z_compress)
    report = verification.report(compared, 0, scale.key).head()
    result.missing, result.orphaned = report["missing_count"], report["orphaned_count"]
    if result.missing:
        empty = pipelines.empty_of_report(spark, compared, source).select("shard")
        result.missing = verification.missing_sources(compared, 0).join(empty, "shard", "left_anti").select("file").distinct().count()


def _next(spark, out: str, scales: list[Scale], level: int, dry_run: bool, max_tasks: int, result: ScaleResult) -> None:
    parent, child = scales[level - 1], scales[level]
    parents = volumes.volume_files(spark, out, level - 1).select("shard")
    result.planned = _tiers(planning.downres_plan(parent, child, level, parents, max_tasks=max_tasks))
    if dry_run:
        return
    # Only children that keep a label need output: those that the votes, computed once, left a chunk in.
    made = pipelines.pyramid(spark, out, scales[: level + 1], level - 1)[level]
    expected = made.select(F.col("shard").cast("string").alias("shard"), shard_filename(F.col("shard"), child.shard).alias("file"))
    report = verification.report(verification.compare_outputs(expected, pipelines.written_files(spark, out, level)), level, child.key).head()
    stray = made.join(child_shards(parent, child, parents), "shard", "left_anti").count()
    result.missing, result.orphaned = report["missing_count"], report["orphaned_count"] + stray
