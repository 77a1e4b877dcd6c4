"""Live telemetry with Structured Streaming: parsed events, progress per shard, completions and windows.

The stream functions are the batch operators on unbounded input: the same events give the same rows.  Windows and
repeats, silent shards and starts without an end are forgotten behind the watermark; the latest state of shards is a row per shard and stays, as shards are
metadata of a fixed number.  Sinks that need a table write a new version of it per micro-batch with ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lamellar.functions.text import embedded_json
from lamellar.session import discard

#: Fields of worker events.
EVENT = "event string, ts timestamp, scale int, shard string, chunks_written long, chunks_failed long, total long, elapsed_s double, memory_gib double"


def read_events(spark: SparkSession, path: str, schema: str = EVENT, files_per_trigger: int = 100) -> DataFrame:
    """Events of log files as they appear in a folder; lines without an event are dropped."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return lines.select(embedded_json(F.col("value"), schema).alias("e")).where("e is not null").select("e.*")


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, a folder or one file, as a stream.  The source takes one file only by a pattern."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def deduplicated(events: DataFrame, keys: list[str], delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Each event once, repeats within the delay dropped."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def progress(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Latest state of every shard; a completion counts over any progress, however late that comes.

    The state is one row per shard that has reported.
    """
    done = F.col("event") == "shard_complete"
    own = F.struct(done.alias("done"), F.col("ts"), F.col("chunks_written"), F.col("chunks_failed"), F.col("total"))
    out = events.withWatermark("ts", delay).groupBy("scale", "shard").agg(F.max(own).alias("s"))
    return out.select("scale", "shard", F.col("s.done").alias("done"), F.col("s.ts").alias("ts"), F.col("s.chunks_written").alias("chunks_written"), F.col("s.chunks_failed").alias("chunks_failed"), F.col("s.total").alias("total"))


def stalled(events: DataFrame, quiet: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Shards that fell silent before they completed: a row once the watermark has passed the last event by ``quiet``.

    scale, shard, since (the last event's time), events (since the shard last woke), chunks_written, total.  State is a row per
    shard that is active; it goes when the shard falls silent, and a shard that wakes and falls silent again is told again.
    Events after a completion count as a new activity.  Append mode.
    """
    last = F.max(F.struct("ts", "chunks_written", "total"))
    own = events.withWatermark("ts", delay).groupBy("scale", "shard", F.session_window("ts", quiet)).agg(F.bool_or(F.col("event") == "shard_complete").alias("done"), F.count(F.lit(1)).alias("events"), last.alias("s"))
    return own.where("not coalesce(done, false)").select("scale", "shard", F.col("s.ts").alias("since"), "events", F.col("s.chunks_written").alias("chunks_written"), F.col("s.total").alias("total"))


def finished(starts: DataFrame, ends: DataFrame, keys: list[str], limit: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Starts (keys, ts) with the ends that come within ``limit`` of them: keys, ts, end_ts; null once no end can come any more.

    A stream-stream left outer join: a start without an end is told when both watermarks have passed its limit, and both
    sides' state goes by the same rule.  Null keys never have an end.  Append mode.
    """
    left = starts.select(*keys, "ts").withWatermark("ts", delay)
    right = ends.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("ts").alias("end_ts")).withWatermark("end_ts", delay)
    on = (F.col("end_ts") >= F.col("ts")) & (F.col("end_ts") <= F.col("ts") + F.expr(f"interval {limit}"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    return left.join(right, on, "left_outer").select(*keys, "ts", "end_ts")


def windowed(events: DataFrame, width: str = "5 minutes", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Events and largest memory per time window and kind; late events count until the watermark passes."""
    w = F.window("ts", width, slide or width)
    out = events.withWatermark("ts", delay).groupBy(w, "event").agg(F.count(F.lit(1)).alias("events"), F.max("memory_gib").alias("peak_gib"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event", "events", "peak_gib")


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "complete", finish: bool = True) -> StreamingQuery:
    """Keep a Parquet table equal to a stream's result; ``finish`` stops when the present input is read.

    Complete results are a new version per micro-batch, which :func:`read_table` finds once it is whole, so readers
    always have one; the version before last goes.  Appended rows go to a folder per micro-batch, so a repeated one
    replaces only its own.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{'batch' if mode == 'append' else 'version'}={number}")
        if mode != "append" and number > 1:
            discard(batch.sparkSession, f"{path}/version={number - 2}")

    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (w.trigger(availableNow=True) if finish else w.trigger(processingTime="30 seconds")).start()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a table that :func:`to_table` keeps, or all rows of an appended one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = lambda f: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))
    versions = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("version=") and whole(f.getPath())]
    if not versions:
        return spark.read.parquet(path).drop("batch")
    return spark.read.parquet(max(versions, key=lambda f: int(f.getName().partition("=")[2])).toString())


def wait(query: StreamingQuery, finished: Callable[[], bool], every: float = 30.0, limit: float | None = None) -> bool:
    """Poll until ``finished`` says so, the query ends, or ``limit`` seconds pass; whether it finished."""
    import time

    end = None if limit is None else time.monotonic() + limit
    while not finished():
        if not query.isActive or (end is not None and time.monotonic() > end):
            return finished()
        query.awaitTermination(every)
    return True
