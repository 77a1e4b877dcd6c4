"""Label lists and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale, morton, shard_number


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """Per chunk: listed labels and supervoxels, and exact distinct labels."""
    return chunks.select("chunk_x", "chunk_y", "chunk_z", F.size("labels").alias("num_labels"), F.size("supervoxels").alias("num_supervoxels"), F.size(F.array_distinct("labels")).alias("unique_labels"))


def stats(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows, and sum, mean and largest of each column, per group; zeros for absent values."""
    aggs = [F.count(F.lit(1)).alias("chunk_count")]
    for c in columns:
        v = F.coalesce(F.col(c), F.lit(0))
        aggs += [F.sum(v).alias(f"total_{c}"), F.avg(v).alias(f"mean_{c}"), F.max(v).alias(f"max_{c}")]
    return rows.groupBy(*keys).agg(*aggs)


def distinct_per_cell(labels: DataFrame, cell: list[Column], label: str = "label") -> DataFrame:
    """Exact distinct labels per cell from one row per (place, label).

    Two-step distinct: rows are made distinct by (cell, label) first, so a cell with many labels never is one
    task's set.
    """
    pairs = labels.select(*cell, label).distinct()
    names = [c for c in pairs.columns if c != label]
    return pairs.groupBy(*names).agg(F.count(F.lit(1)).alias("unique_labels"))


def child_union(chunks: DataFrame) -> DataFrame:
    """Distinct labels of each child chunk: the union over its (up to eight) parent chunks."""
    rows = chunks.select(*(F.shiftright(F.col(f"chunk_{a}"), 1).alias(f"chunk_{a}") for a in "xyz"), F.explode("labels").alias("label"))
    return distinct_per_cell(rows, [F.col(f"chunk_{a}") for a in "xyz"])


def merged_predictions(parts: DataFrame, columns: tuple[str, ...] = ("num_labels", "num_supervoxels", "unique_labels")) -> DataFrame:
    """Partial per-chunk counts of several parents: the largest of each, a lower bound of the union."""
    return parts.groupBy("x", "y", "z").agg(*(F.max(c).alias(c) for c in columns))


def totals_by_shard(profile: DataFrame, scale: Scale, column: str = "unique_labels") -> DataFrame:
    """Chunks and label total of each output shard."""
    shard = shard_number(scale, morton(scale, F.col("x"), F.col("y"), F.col("z")))
    return profile.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("chunks"), F.sum(column).alias("total_labels"))


def nonempty(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Whether any label or supervoxel of the group is not background."""
    solid = lambda c: F.exists(c, lambda x: x != 0)
    return chunks.groupBy(*keys).agg(F.bool_or(solid("labels") | solid("supervoxels")).alias("nonempty"))


def background_only(labels: Column) -> Column:
    """Whether the only label of a list is 0."""
    return F.array_distinct(labels) == F.array(F.lit(0).cast("long"))


def map_labels(rows: DataFrame, pairs: DataFrame, column: str = "sv") -> DataFrame:
    """Supervoxels replaced by labels (columns sv, label of ``pairs``); those without a pair stay.

    ``pairs`` must have one row per supervoxel; see :func:`last_pairs`.
    """
    own = pairs.select(F.col("sv").alias("__sv"), F.col("label").alias("__label"))
    return rows.join(own, F.col(column) == F.col("__sv"), "left").withColumn("label", F.coalesce("__label", column)).drop("__sv", "__label")


def last_pairs(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sv, label) of paired lists; of a repeated supervoxel the last pair counts."""
    pairs = chunks.select(*keys, F.posexplode(F.arrays_zip(F.slice("supervoxels", 1, F.least(F.size("labels"), F.size("supervoxels"))).alias("sv"), F.col("labels").alias("label"))).alias("i", "p"))
    pairs = pairs.where(F.col("p.sv").isNotNull())
    return pairs.groupBy(*keys, F.col("p.sv").alias("sv")).agg(F.max_by("p.label", "i").alias("label"))


def extents(chunks: DataFrame, scale: Scale, keys: list[str]) -> DataFrame:
    """Largest voxel reached on each axis and whether it lies in the volume."""
    top = [((F.max(f"chunk_{a}") + 1) * c).alias(f"max_{a}") for a, c in zip("xyz", scale.chunk, strict=True)]
    out = chunks.groupBy(*keys).agg(*top)
    fits = (F.col("max_x") <= scale.size[0]) & (F.col("max_y") <= scale.size[1]) & (F.col("max_z") <= scale.size[2])
    return out.withColumn("inside", fits)
