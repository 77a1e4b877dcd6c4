"""Completeness and value checks of output volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamellar.functions.geometry import AXES, Scale, div, morton, shard_number, shard_of_name, shard_of_voxel

from .ranks import running


def compare_outputs(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Every output file with its state: present, missing or orphaned, and the source shards that lead to it.

    ``expected``: file, shard (several sources may lead to one file); ``actual``: file.
    """
    want = expected.groupBy("file").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    have = actual.select("file", F.lit(True).alias("there")).distinct()
    state = F.when(F.col("shards").isNull(), "orphaned").when(F.col("there").isNull(), "missing").otherwise("present")
    return want.join(have, "file", "full_outer").select("file", state.alias("state"), "shards")


def report(compared: DataFrame, scale: int, key: str) -> DataFrame:
    """The one-row report of a scale: counts.  The files themselves stay rows; see :func:`missing_sources` and :func:`orphans`."""
    miss, orphan = F.col("state") == "missing", F.col("state") == "orphaned"
    return compared.agg(
        F.coalesce(F.sum(F.when(~orphan, F.size("shards")).otherwise(0)), F.lit(0)).alias("source_shards"), F.count(F.when(~orphan, 1)).alias("expected_shards"), F.count(F.when(~miss, 1)).alias("actual_shards"),
        F.count(F.when(miss, 1)).alias("missing_count"), F.count(F.when(orphan, 1)).alias("orphaned_count"),
    ).select(F.lit(scale).alias("scale"), F.lit(key).alias("scale_key"), "*")


def missing_sources(compared: DataFrame, scale: int) -> DataFrame:
    """(scale, file, shard) of all sources whose file is missing."""
    return compared.where("state = 'missing'").select(F.lit(scale).alias("scale"), "file", F.explode("shards").alias("shard"))


def orphans(compared: DataFrame, scale: int) -> DataFrame:
    """(scale, file) of outputs that no source leads to."""
    return compared.where("state = 'orphaned'").select(F.lit(scale).alias("scale"), "file")


def with_metadata(missing: DataFrame, sources: DataFrame, keys: tuple[str, ...] = ("scale", "shard")) -> DataFrame:
    """Missing source shards with their bytes and chunks, to be planned anew; ``known`` is false where there is no source."""
    own = sources.select(*keys, "bytes", "chunks", F.lit(True).alias("known"))
    return missing.select(*keys).distinct().join(own, list(keys), "left").withColumn("known", F.coalesce("known", F.lit(False)))


def outside(scale: Scale, x: Column, y: Column, z: Column) -> Column:
    """Whether chunk coordinates lie beyond the volume's grid."""
    return (x >= scale.grid[0]) | (y >= scale.grid[1]) | (z >= scale.grid[2])


def shard_outcomes(decoded: DataFrame, scale: Scale, z_compress: int = 0) -> DataFrame:
    """Per source shard of decoded chunks (shard, chunk_x.., error): chunks, failed, outside, written, and ``ok``.

    A shard that writes no chunk, all failed or outside the volume, has failed as a whole.
    """
    x, y, z = (F.col(f"chunk_{a}") for a in AXES)
    beyond = outside(scale, x, y, div(z, z_compress + 1))
    bad = F.col("error").isNotNull()
    out = decoded.groupBy("shard").agg(F.count(F.lit(1)).alias("chunks"), F.count(F.when(bad, 1)).alias("failed"), F.count(F.when(~bad & beyond, 1)).alias("outside"))
    return out.withColumn("written", F.col("chunks") - F.col("failed") - F.col("outside")).withColumn("ok", F.col("written") > 0)


def sample_shards(shards: DataFrame, n: int, seed: int = 0, key: str = "shard") -> DataFrame:
    """n shards without replacement, the same for one seed however they are partitioned: the n least hashes of seed and key."""
    return shards.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def consistency(chunks: DataFrame, scale: Scale) -> DataFrame:
    """Per source shard: output shards its chunks fall in, the one its name says, chunks outside and five of them."""
    at = [F.col(f"chunk_{a}") for a in AXES]
    own = chunks.select("shard", *at, outside(scale, *at).alias("outside"), shard_number(scale, morton(scale, *at)).alias("number"))
    first = F.row_number().over(Window.partitionBy("shard", "outside").orderBy(*(f"chunk_{a}" for a in AXES)))
    own = own.withColumn("rank", F.when(F.col("outside"), first))
    out = own.groupBy("shard").agg(F.sort_array(F.collect_set(F.when(~F.col("outside"), F.col("number")))).alias("numbers"), F.count(F.when(F.col("outside"), 1)).alias("outside"), F.sort_array(F.collect_list(F.when(F.col("rank") <= 5, F.struct(*(f"chunk_{a}" for a in AXES))))).alias("samples"))
    named = shard_of_name(scale, F.col("shard"))
    return out.withColumn("consistent", (F.size("numbers") <= 1) & ((F.size("numbers") == 0) | F.array_contains("numbers", named)))


def exposed_faces(scale: Scale, records: DataFrame, existing: DataFrame) -> DataFrame:
    """Faces of shards whose neighbouring voxel lies in the volume but in no existing shard.

    ``records``: shard, ox.. origin, ex.. extent; ``existing``: shard.
    """
    faces = []
    for k, a in enumerate(AXES):
        b, c = (x for x in AXES if x != a)
        for direction in (-1, 1):
            probe = F.col(f"o{a}") - 1 if direction < 0 else F.col(f"o{a}") + F.col(f"e{a}")
            faces.append(F.struct(F.lit(a).alias("axis"), F.lit(direction).alias("direction"), probe.alias("probe"), F.lit(scale.size[k]).cast("long").alias("limit"), (F.col(f"e{b}") * F.col(f"e{c}")).alias("area")))
    out = records.select("*", F.explode(F.array(*faces)).alias("f")).where("f.area > 0 and f.probe >= 0 and f.probe < f.limit")
    point = [F.when(F.col("f.axis") == a, F.col("f.probe")).otherwise(F.col(f"o{a}")) for a in AXES]
    out = out.withColumn("beside", shard_of_voxel(scale, *point))
    out = out.join(existing.select(F.col("shard").alias("beside")), "beside", "left_anti")
    return out.select("shard", "f.axis", "f.direction", "f.area", *(f"o{a}" for a in AXES), *(f"e{a}" for a in AXES))


def _draw(seed: int, i: Column, k: int) -> Column:
    """A number in [0, 1) from (seed, i, k): the first 52 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), i.cast("string"), F.lit(str(k)))), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def cumulative(rows: DataFrame, weight: str, order: list[str]) -> DataFrame:
    """``rows`` with high, the running sum of a weight, and low, the sum before."""
    return running(rows, order, weight=weight)


def _picked(rows: DataFrame, weight: str, n: int, seed: int, spark) -> DataFrame:
    """n draws of rows with probability in proportion to weight: running sums and a range join.

    Ends are bucketed so that the join is an equi-join.
    """
    own = cumulative(rows, weight, ["shard", *(c for c in ("axis", "direction") if c in rows.columns)])
    total = own.agg(F.max("high")).head()[0] or 0
    step = max(1, total // 1024)
    parts = own.withColumn("part", F.explode(F.sequence(div(F.col("low"), step), div(F.col("high") - 1, step))))
    points = spark.range(n).select(F.col("id").alias("point_id"), F.floor(_draw(seed, F.col("id"), 0) * F.lit(float(total))).cast("long").alias("pick"))
    points = points.withColumn("part", div(F.col("pick"), step))
    return points.join(parts, "part").where("pick >= low and pick < high").drop("part", "low", "high", "pick") if total else points.where("false").join(parts, "part").drop("part", "low", "high", "pick")


def sample_inside(records: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n voxels of shards, each voxel as likely: point_id, x, y, z.  Draws depend on seed and point number alone."""
    got = _picked(records, "volume", n, seed, records.sparkSession)
    inner = [(F.col(f"o{a}") + F.floor(_draw(seed, F.col("point_id"), k + 1) * F.col(f"e{a}"))).cast("long").alias(a) for k, a in enumerate(AXES)]
    return got.select("point_id", *inner)


def sample_outside(faces: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n voxels just beyond exposed faces, faces drawn by area."""
    got = _picked(faces, "area", n, seed, faces.sparkSession)
    out = []
    for k, a in enumerate(AXES):
        beyond = F.when(F.col("direction") < 0, F.col(f"o{a}") - 1).otherwise(F.col(f"o{a}") + F.col(f"e{a}"))
        inner = F.col(f"o{a}") + F.floor(_draw(seed, F.col("point_id"), k + 1) * F.col(f"e{a}"))
        out.append(F.when(F.col("axis") == a, beyond).otherwise(inner).cast("long").alias(a))
    return got.select("point_id", *out)


def values_at(points: DataFrame, voxels: DataFrame) -> DataFrame:
    """Points with their label; voxels without a row are background."""
    return points.join(voxels.select("x", "y", "z", "label"), ["x", "y", "z"], "left").withColumn("label", F.coalesce("label", F.lit(0).cast("long")))


def mismatches(points: DataFrame, exported: DataFrame, truth: DataFrame) -> DataFrame:
    """Points where two volumes differ: point_id, x, y, z, export_value, truth_value."""
    ours = values_at(points, exported).withColumnRenamed("label", "export_value")
    theirs = values_at(points, truth).select("point_id", F.col("label").alias("truth_value"))
    return ours.join(theirs, "point_id").where("export_value <> truth_value")
