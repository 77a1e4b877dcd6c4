"""Work planning: pruning, tiers, balanced tasks and the downsampling plan."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lamellar.functions import models
from lamellar.functions.geometry import AXES, Scale, child_shards, chunks_per_shard, div, settled, shard_box, shard_filename, shard_of_name
from lamellar.session import fresh, materialize, remove

from .ranks import running


def without(rows: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not excluded."""
    return rows.join(excluded.select(*keys), keys, "left_anti")


def empty_candidates(shards: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Shards with chunks of suspiciously few bytes."""
    return shards.where((F.col("chunks") != 0) & (F.col("bytes") / F.col("chunks") < least_bytes)).withColumn("bytes_per_chunk", F.col("bytes") / F.col("chunks"))


def deletion_plan(candidates: DataFrame, confirmed: DataFrame, keys: list[str], least_bytes: int = 1000) -> DataFrame:
    """Confirmed empty shards that still look empty; nothing is deleted here."""
    return empty_candidates(candidates.join(confirmed.select(*keys), keys, "left_semi"), least_bytes)


def only_missing(sources: DataFrame, outputs: DataFrame, scale: Scale, z_compress: int = 0) -> DataFrame:
    """Source shards whose output file is not there."""
    named = sources.withColumn("file", shard_filename(shard_of_name(scale, F.col("shard"), z_compress), scale.shard))
    return named.join(outputs.select("file"), "file", "left_anti")


def with_tier(shards: DataFrame, least: int = 4) -> DataFrame:
    """Memory estimate and tier of source shards (scale, bytes, chunks)."""
    out = settled(shards, memory_gib=models.export_gib(F.col("bytes"), F.col("chunks"), F.col("scale")))
    return out.withColumn("tier_gib", models.pick_tier(F.col("memory_gib"), least))


#: Rows of a group that :func:`balanced` assigns in one task.
BLOCK = 1 << 19


def balanced(rows: DataFrame, weight: str, max_tasks: int, keys: tuple[str, ...] = ("tier_gib",), tie: str = "shard", block: int = BLOCK) -> DataFrame:
    """``rows`` with task_id: heaviest first (ties by ``tie``, if there is such a column), each to the least loaded task (lowest number among equals).

    Exact greedy balancing is sequential, but all that a row needs of those before it is the loads.  So each group of ``keys`` is
    cut, in its order, into blocks of at most ``block`` rows; the k-th blocks of all groups are assigned at once, and the loads
    that they leave, a row per task, start the next.  A task holds a block, however long a group is; steps follow the largest
    group.  Null weights come last and count 0.  For balance without steps, see :func:`snake`.
    """
    spark, name = rows.sparkSession, fresh(rows, "task_id")[0]
    at, after, number, load, *sort = fresh(rows, "__at", "__after", "__number", "__load", "__unknown", "__down", "__last")
    kind = rows.schema[weight].dataType
    whole = isinstance(kind, T.IntegralType)
    total = T.DecimalType(38, 0 if whole else kind.scale) if whole or isinstance(kind, T.DecimalType) else T.DoubleType()
    order = {sort[0]: F.col(weight).isNull(), sort[1]: F.bitwise_not(F.col(weight)) if whole else -F.col(weight)}
    if tie in rows.columns:
        order[sort[2]] = F.col(tie).isNull()
    ranked = running(rows.withColumns(order), [*order, *([tie] if tie in rows.columns else [])], [F.col(k) for k in keys], low=at, high=after)
    ranked = materialize(ranked.select(*rows.columns, at, F.expr(f"{at} div {block}").alias(number)), "ranked")
    schema = T.StructType([*rows.schema, T.StructField(name, T.IntegerType()), T.StructField(load, total)])

    def assign(own: pa.Table, loads: pa.Table) -> pa.Table:
        own = own.sort_by(at)
        value = int if whole else lambda v: v
        known = {k: value(v) for k, v in zip(loads[name].to_pylist(), loads[load].to_pylist(), strict=True)}
        heap = sorted((known.get(k, 0), k) for k in range(max_tasks))
        tasks, last, left = [], {}, [None] * len(own)
        for i, w in enumerate(own[weight].to_pylist()):
            held, k = heap[0]
            heapq.heapreplace(heap, (held if w is None or w != w else held + w, k))
            tasks.append(k)
            last[k] = i
        for held, k in heap:
            if k in last:
                left[last[k]] = held
        return own.select(names).append_column(name, pa.array(tasks, pa.int32())).append_column(load, pa.array(left, to_arrow_type(total)))

    names, loads, paths = rows.columns, spark.createDataFrame([], T.StructType([*(rows.schema[k] for k in keys), *schema[-2:]])), []
    for k in range((ranked.agg(F.max(number)).head()[0] or 0) + 1):
        one = ranked.where(F.col(number) == k).drop(number)
        done = materialize(one.groupBy(*keys).cogroup(loads.groupBy(*keys)).applyInArrow(assign, schema), "assigned")
        paths.append(done.materialized_at)
        both = loads.withColumn(number, F.lit(0)).unionByName(done.where(F.col(load).isNotNull()).select(*loads.columns, F.lit(1).alias(number)))
        loads = materialize(both.groupBy(*keys, name).agg(F.max_by(load, number).alias(load)), "loads")
    remove(ranked)
    return spark.read.schema(schema).parquet(*paths).drop(load)


def snake(rows: DataFrame, weight: str, tasks: int, tie: str, keys: tuple[str, ...] = ("tier_gib",)) -> DataFrame:
    """Balanced tasks without a sequential step: by descending weight, back and forth over the tasks."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(weight), tie)) - 1
    lap, place = div(rank, tasks), rank % tasks
    return rows.withColumn("task_id", F.when(lap % 2 == 0, place).otherwise(tasks - 1 - place).cast("int"))


def round_robin(rows: DataFrame, tasks: int, order: list[str], keys: list[Column] | None = None) -> DataFrame:
    """Row i in order goes to task i modulo ``tasks``."""
    (at, after) = fresh(rows, "__at", "__after")
    found = running(rows, order, keys, low=at, high=after)
    return found.withColumn("task_id", (F.col(at) % tasks).cast("int")).drop(at, after)


def buckets(rows: DataFrame, size: int, order: list[str], keys: list[Column] | None = None) -> DataFrame:
    """Row i in order goes to bucket i div ``size``."""
    (at, after) = fresh(rows, "__at", "__after")
    found = running(rows, order, keys, low=at, high=after)
    return found.withColumn("bucket", div(F.col(at), size).cast("int")).drop(at, after)


def tier_summary(tasks: DataFrame) -> DataFrame:
    """Shards, bytes and largest estimate per tier, and over all (tier null)."""
    return tasks.rollup("tier_gib").agg(F.count(F.lit(1)).alias("shards"), F.sum("bytes").alias("bytes"), F.max("memory_gib").alias("max_gib"))


def downres_plan(parent: Scale, child: Scale, level: int, parents: DataFrame, existing: DataFrame | None = None, label_totals: DataFrame | None = None, max_tasks: int = 5000, z_compress: int = 0) -> DataFrame:
    """Child shards to make from parent shards: box, chunks, estimate, tier and task.

    ``existing`` (file): outputs to leave out.  ``label_totals`` (shard, total_labels): shards with one get the
    label-aware estimate.
    """
    out = child_shards(parent, child, parents)
    out = out.withColumn("file", shard_filename(F.col("shard"), child.shard))
    if existing is not None:
        out = out.join(existing.select("file"), "file", "left_anti")
    origin, extent = shard_box(child, F.col("shard"))
    boxes = {f"o{a}": o for a, o in zip(AXES, origin, strict=True)} | {f"e{a}": e for a, e in zip(AXES, extent, strict=True)}
    out = settled(out, **boxes, chunks=chunks_per_shard(child, F.col("shard"))).where("chunks > 0")
    if label_totals is not None:
        out = out.join(label_totals.select("shard", "total_labels"), "shard", "left")
    else:
        out = out.withColumn("total_labels", F.lit(None).cast("long"))
    parts = models.downres(F.lit(level), F.col("chunks"), F.col("total_labels"))
    out = settled(out, **parts).withColumn("tier_gib", models.pick_tier(F.col("total_gib")))
    return balanced(out, "chunks", max_tasks)


def export_plan(sources: DataFrame, scale: Scale, outputs: DataFrame | None = None, empty: DataFrame | None = None, max_tasks: int = 5000, z_compress: int = 0) -> DataFrame:
    """Source shards to convert, with tiers and tasks: known-empty and finished ones left out."""
    out = sources
    if empty is not None:
        out = without(out, empty, ["scale", "shard"])
    if outputs is not None:
        out = only_missing(out, outputs, scale, z_compress).drop("file")
    return balanced(with_tier(out), "bytes", max_tasks)
