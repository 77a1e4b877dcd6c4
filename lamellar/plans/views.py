"""Volume-shaped views of the benchmark tables, as DataFrames and as SQL text that says the same.

``vox``: a sparse label volume of 128 x 128 x 8 voxels (many line items per voxel; the smallest supplier plus one wins).
``chunks``: its chunks of 8 x 8 x 4 voxels with label lists.  ``shards``: source shards from orders.
``outputs``: output shard files, some missing and some without a source.  ``log``: run events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale, settled, shard_filename, shard_of_name
from lamellar.session import table

#: The toy volume of ``vox``.
TOY = Scale("toy", (128, 128, 8), (8, 8, 4), 1, 2, 6)
HALF = Scale("half", (64, 64, 4), (8, 8, 4), 1, 2, 4)
#: A volume of production size.
LARGE = Scale("large", (94088, 78317, 134576), (64, 64, 64), 9, 6, 19)
LARGE_HALF = Scale("large_half", (47044, 39158, 67288), (64, 64, 64), 9, 6, 16)


def vox(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.groupBy((F.col("l_partkey") % 128).alias("x"), (F.col("l_orderkey") % 128).alias("y"), F.col("l_linenumber").cast("long").alias("z")).agg((F.min("l_suppkey") + 1).alias("label"))


def shards(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    name = F.concat_ws("_", F.col("o_custkey") % 40 * 2048, F.col("o_orderkey") % 35 * 2048, F.col("o_orderkey") % 50 * 2048)
    return o.select("o_orderkey", (F.col("o_orderkey") % 6).cast("int").alias("scale"), name.alias("shard"), F.floor(F.col("o_totalprice") * 1000).cast("long").alias("bytes"), (1 + F.col("o_orderkey") * 7919 % 32768).alias("chunks"))


def numbered(spark: SparkSession, sf: str) -> DataFrame:
    """Shards with output number and file."""
    n = settled(shards(spark, sf), number=shard_of_name(LARGE, F.col("shard")))
    return n.withColumn("file", shard_filename(F.col("number"), LARGE.shard))


def outputs(spark: SparkSession, sf: str) -> DataFrame:
    own = numbered(spark, sf).where("o_orderkey % 5 <> 0").groupBy("file", "number").agg(F.max("bytes").alias("bytes"))
    stray = table(spark, sf, "part").where("p_partkey % 10 = 0").select((F.col("p_partkey") + 500000).alias("number"), F.lit(1000).cast("long").alias("bytes"))
    return own.unionByName(stray.select(shard_filename(F.col("number"), LARGE.shard).alias("file"), "number", "bytes"))


def log(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        "event_id", "ts", "event_type", F.col("user_id").alias("shard_number"), (F.col("event_id") % 3).cast("int").alias("scale"), F.col("value").alias("peak_memory_gib"),
        F.from_json("props", "k long")["k"].alias("num_chunks"), F.when(F.col("event_id") % 4 != 0, F.col("value") * 2 + 1).alias("estimated_memory_gib"), (F.col("event_id") % 3600).cast("double").alias("elapsed_s"),
    )


# --- the same as SQL --------------------------------------------------------------------------------------


def morton_sql(scale: Scale, x: str, y: str, z: str) -> str:
    at = (x, y, z)
    return "(" + " | ".join(f"(((({at[a]})::BIGINT >> {level}) & 1) << {place})" for place, (a, level) in enumerate(scale.plan)) + ")"


def shard_sql(scale: Scale, x: str, y: str, z: str) -> str:
    """Shard number of chunk coordinates."""
    return f"(({morton_sql(scale, x, y, z)} >> {scale.low}) & {(1 << scale.shard) - 1})"


def file_sql(number: str, bits: int) -> str:
    return f"(printf('%0{max(1, -(-bits // 4))}x', {number}) || '.shard')"


def name_sql(scale: Scale, name: str, z_compress: int = 0) -> str:
    part = lambda k: f"split_part({name}, '_', {k})::BIGINT"
    return shard_sql(scale, f"{part(1)} // {scale.chunk[0]}", f"{part(2)} // {scale.chunk[1]}", f"({part(3)} // {z_compress + 1}) // {scale.chunk[2]}")


def origin_sql(scale: Scale, number: str, axis: int) -> str:
    parts = [f"((({number} >> {place - scale.low}) & 1) << {level})" for place, (a, level) in enumerate(scale.plan) if a == axis and place >= scale.low]
    return "(" + (" | ".join(parts) or "0") + ")::BIGINT"


VOX = "vox AS (SELECT l_partkey % 128 AS x, l_orderkey % 128 AS y, l_linenumber::BIGINT AS z, min(l_suppkey) + 1 AS label FROM lineitem GROUP BY 1, 2, 3)"
SHARDS = "shards AS (SELECT o_orderkey, (o_orderkey % 6)::INT AS scale, concat_ws('_', o_custkey % 40 * 2048, o_orderkey % 35 * 2048, o_orderkey % 50 * 2048) AS shard, floor(o_totalprice * 1000)::BIGINT AS bytes, 1 + o_orderkey * 7919 % 32768 AS chunks FROM orders)"
NUMBERED = f"{SHARDS}, numbered0 AS (SELECT *, {name_sql(LARGE, 'shard')} AS number FROM shards), numbered AS (SELECT *, {file_sql('number', LARGE.shard)} AS file FROM numbered0)"
OUTPUTS = f"{NUMBERED}, outputs AS (SELECT file, number, max(bytes) AS bytes FROM numbered WHERE o_orderkey % 5 <> 0 GROUP BY 1, 2 UNION ALL SELECT {file_sql('(p_partkey + 500000)', LARGE.shard)}, p_partkey + 500000, 1000 FROM part WHERE p_partkey % 10 = 0)"
LOG = "log AS (SELECT event_id, ts, event_type, user_id AS shard_number, (event_id % 3)::INT AS scale, value AS peak_memory_gib, (props::JSON->>'k')::BIGINT AS num_chunks, CASE WHEN event_id % 4 <> 0 THEN value * 2 + 1 END AS estimated_memory_gib, (event_id % 3600)::DOUBLE AS elapsed_s FROM events)"
