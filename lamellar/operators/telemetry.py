"""Run telemetry: errors, progress, completions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamellar.functions.text import error_class, percent
from lamellar.session import fresh


def normalized(events: DataFrame) -> DataFrame:
    """Shard and chunk counts under their usual names whatever the event calls them; absent counts get defaults."""
    has = lambda c, d: F.col(c) if c in events.columns else F.lit(None).cast(d)
    return events.withColumns({
        "shard": F.coalesce(has("shard", "string"), has("shard_number", "string").cast("string")), "chunks_written": F.coalesce(has("chunks_written", "long"), has("num_chunks", "long")),
        "chunks_failed": F.coalesce(has("chunks_failed", "long"), F.lit(0)), "batches": F.coalesce(has("batches", "long"), F.lit(1)),
    })


def error_counts(errors: DataFrame, keys: list[str]) -> DataFrame:
    """Errors per group, most first; ties by key.  Groups are few, so their order costs nothing."""
    return errors.groupBy(*keys).agg(F.count(F.lit(1)).alias("errors")).orderBy(F.desc("errors"), *keys)


def classified(errors: DataFrame, message: str = "error") -> DataFrame:
    return errors.withColumn("category", error_class(F.col(message)))


def top_errors(errors: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n groups with most errors; ties by key."""
    return error_counts(errors, [key]).limit(n)


def best_and_worst(rows: DataFrame, score: str, key: str, n: int = 5) -> DataFrame:
    """The n highest and n lowest rows by score, each once, with which end they are of.

    Both ends are plain top-n operators, so no task ranks everything.
    """
    top = rows.orderBy(F.desc(score), key).limit(n).withColumn("end", F.lit("top"))
    low = rows.orderBy(F.asc(score), F.desc(key)).limit(n).join(top.select(key), key, "left_anti").select(*rows.columns).withColumn("end", F.lit("bottom"))
    return top.unionByName(low)


def latest(events: DataFrame, keys: list[str], ts: str, tie: str) -> DataFrame:
    """The latest row of each key: an aggregation with map-side partial results, no sort of a key's rows."""
    own, place = fresh(events, "__row", "__at")
    rows = events.select(*keys, F.struct(*events.columns).alias(own), F.struct(F.col(ts), F.col(tie)).alias(place))
    return rows.groupBy(*keys).agg(F.max_by(own, place).alias(own)).select(f"{own}.*")


def latest_execution(entries: DataFrame, job: str, execution: str, ts: str) -> DataFrame:
    """Entries of each job's execution with the latest entry."""
    last = entries.groupBy(job).agg(F.max_by(execution, F.struct(F.col(ts), F.col(execution))).alias("__last"))
    return entries.join(last, job).where(F.col(execution) == F.col("__last")).drop("__last")


def in_flight(progress: DataFrame, done: DataFrame, keys: list[str], ts: str, tie: str) -> DataFrame:
    """Latest progress of shards without a completion."""
    return latest(progress.join(done.select(*keys), keys, "left_anti"), keys, ts, tie)


def incomplete(started: DataFrame, completed: DataFrame, failed: DataFrame, keys: list[str]) -> DataFrame:
    """Started shards neither completed nor failed."""
    ended = completed.select(*keys).unionByName(failed.select(*keys))
    return started.select(*keys).distinct().join(ended, keys, "left_anti")


def failed_shards(sources: DataFrame, completed: DataFrame, empty: DataFrame | None = None, keys: tuple[str, ...] = ("scale", "shard")) -> DataFrame:
    """Source shards without a completion; ``empty`` ones complete without one and may be left out."""
    out = sources.join(completed.select(*keys), list(keys), "left_anti")
    return out if empty is None else out.join(empty.select(*keys), list(keys), "left_anti")


def memory_summary(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Peaks, limits, batches, times and, where they are known, estimates and prediction errors."""
    aggs = [
        F.count(F.lit(1)).alias("shards_profiled"), F.avg(F.coalesce("peak_memory_gib", F.lit(0.0))).alias("peak_memory_avg"), F.max(F.coalesce("peak_memory_gib", F.lit(0.0))).alias("peak_memory_max"),
        F.max(F.coalesce("memory_limit_gib", F.lit(0.0))).alias("memory_limit"), F.sum(F.coalesce("batches", F.lit(1))).alias("total_batch_writes"), F.avg(F.coalesce("batches", F.lit(1))).alias("avg_batch_writes"),
        F.avg(F.coalesce("elapsed_s", F.lit(0.0))).alias("avg_elapsed_s"), F.max(F.coalesce("elapsed_s", F.lit(0.0))).alias("max_elapsed_s"),
    ]
    for c in ("estimated_memory_gib", "prediction_error_gib", "prediction_ratio"):
        aggs += [F.avg(c).alias(f"{c}_avg"), F.max(c).alias(f"{c}_max")]
    return events.groupBy(*(keys or [])).agg(*aggs)


def prediction(events: DataFrame) -> DataFrame:
    """Error and ratio of predicted memory; null where there is no estimate."""
    return events.withColumns({"prediction_error_gib": F.col("peak_memory_gib") - F.col("estimated_memory_gib"), "prediction_ratio": F.try_divide("peak_memory_gib", F.nullif("estimated_memory_gib", F.lit(0.0)))})


def progress_totals(completed: DataFrame, running: DataFrame) -> DataFrame:
    """Chunks written and failed over completed and running shards, and percent of the total."""
    both = completed.select("chunks_written", "chunks_failed", "total").unionByName(running.select("chunks_written", "chunks_failed", "total"))
    out = both.agg(F.coalesce(F.sum("chunks_written"), F.lit(0)).alias("written"), F.coalesce(F.sum("chunks_failed"), F.lit(0)).alias("failed"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"))
    return out.withColumn("percent", percent(F.col("written"), F.col("total")))


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """Shards that ended well and not, and their chunks, in one row; see :func:`verification.shard_outcomes`."""
    ok = F.col("ok")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return outcomes.agg(F.count(F.when(ok, 1)).alias("shards_ok"), F.count(F.when(~ok, 1)).alias("shards_failed"), zero("written").alias("written"), zero("failed").alias("failed"), zero("outside").alias("outside"))


def pressure(events: DataFrame) -> DataFrame:
    """Memory pressure of each row: critical over 0.9 of the limit, high over 0.75."""
    share = F.try_divide("memory_gib", "memory_limit_gib")
    return events.withColumn("pressure", F.when(share > 0.9, "critical").when(share > 0.75, "high").otherwise("ok"))


def merge_partial(frames: list[DataFrame]) -> DataFrame:
    """Rows of several jobs together, by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
