"""Queries over source shards, specs, manifests, profiles and logs that the engine itself writes from the benchmark tables."""

from __future__ import annotations

import base64
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.functions import geometry, text
from lamellar.operators import codecs, planning, telemetry, verification, volume
from lamellar.session import scratch, ship, table
from lamellar.sources import labels as label_service
from lamellar.sources import shards, specs, volumes
from lamellar.sources.files import write_files

from . import pipelines, runs
from . import views as V
from .registry import _CHILD, _EXPORT, _LPT, _PARENT, _ROOM, _TIER, BLOCK_BYTES_SQL, ORACLES, PALETTES, blocks, query

#: Two scales of the toy volume with blocks of 8 x 8 x 8 voxels.
WHOLE = geometry.Scale("whole8", (128, 128, 8), (8, 8, 8), 1, 3, 4)
HALF = geometry.Scale("half8", (64, 64, 4), (8, 8, 8), 1, 3, 2)
#: The same volume cut short: chunks beyond it are outside.
CUT = geometry.Scale("cut8", (64, 128, 8), (8, 8, 8), 1, 3, 3)
#: Chunks across a source shard of the toy volume.
ACROSS = 4


def source(spark: SparkSession, sf: str, ranges: bool = True, broken: Column | None = None) -> str:
    """Write the toy volume as source shards of 4 x 4 x 1 chunks, three chunks a batch; the folder of its scale.

    ``broken``: chunks whose blocks can't be decoded.
    """
    at = f"{scratch(spark, 'source')}/s0"
    name = F.concat_ws("_", *(geometry.div(F.col(f"chunk_{a}"), ACROSS) * (ACROSS * 8) for a in "xyz"))
    own = blocks(spark, sf).withColumn("shard", name)
    if broken is not None:
        own = own.withColumn("block", F.when(broken, F.lit(b"no block")).otherwise(F.col("block")))
    shards.write_shards(own, at, 3, ranges).write.format("noop").mode("overwrite").save()
    return at


_NAMED = f"{PALETTES}, s AS (SELECT *, (chunk_x // 4 * 32) || '_' || (chunk_y // 4 * 32) || '_' || (chunk_z // 4 * 32) AS shard FROM b), i AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY chunk_z, chunk_y, chunk_x) - 1 AS k FROM s)"
_CHUNKS = f"WITH {_NAMED} SELECT shard, chunk_x, chunk_y, chunk_z, n::INT AS num_labels, n::INT AS num_supervoxels, {BLOCK_BYTES_SQL} AS uncompressed_size FROM s"


def _shown(chunks: DataFrame) -> DataFrame:
    return chunks.select("shard", "chunk_x", "chunk_y", "chunk_z", F.size("labels").alias("num_labels"), F.size("supervoxels").alias("num_supervoxels"), "uncompressed_size")


@query("shard_scan", _CHUNKS)
def shard_scan(spark, sf):
    return _shown(shards.read_shards(spark, source(spark, sf)))


@query("shard_ranges", _CHUNKS)
def shard_ranges(spark, sf):
    """The same chunks by the byte ranges of their indexes."""
    return _shown(shards.read_shards(spark, source(spark, sf), indexed=True))


@query("shard_ranges_pruned", f"WITH {_NAMED}, t AS (SELECT DISTINCT shard, k // 3 AS batch FROM i WHERE chunk_x = 5) SELECT i.shard, chunk_x, chunk_y, chunk_z FROM i JOIN t ON i.shard = t.shard AND i.k // 3 = t.batch")
def shard_ranges_pruned(spark, sf):
    """Whole batches of the entries asked for, no others."""
    entries = shards.index_entries(spark, source(spark, sf)).where("x = 5")
    return shards.read_ranges(spark, entries).select("shard", "chunk_x", "chunk_y", "chunk_z")


def _at_ranges(index: DataFrame, entries: DataFrame) -> DataFrame:
    """Index rows with the uncompressed size of their chunk, each batch read by itself at the range that its entry states."""
    chunks = shards.read_ranges(spark=entries.sparkSession, entries=entries, apart=True)
    found = chunks.select("shard", *(F.col(f"chunk_{a}").cast("long").alias(a) for a in "xyz"), F.col("offset").alias("at"), "uncompressed_size")
    return index.join(found, ["shard", "x", "y", "z"]).where("at = offset").select("shard", "x", "y", "z", "batch_idx", "uncompressed_size")


@query("index_scan", f"WITH {_NAMED} SELECT shard, chunk_x::BIGINT AS x, chunk_y::BIGINT AS y, chunk_z::BIGINT AS z, k // 3 AS batch_idx, {BLOCK_BYTES_SQL} AS uncompressed_size FROM i")
def index_scan(spark, sf):
    """Index entries, each with its chunk as found by reading the entry's own byte range and no other."""
    at = source(spark, sf)
    return _at_ranges(shards.read_index(spark, at), shards.index_entries(spark, at))


@query("batch_offsets", f"WITH {_NAMED} SELECT shard, chunk_x::BIGINT AS x, chunk_y::BIGINT AS y, chunk_z::BIGINT AS z, k // 3 AS batch_idx, {BLOCK_BYTES_SQL} AS uncompressed_size FROM i")
def batch_offsets(spark, sf):
    """Ranges found by skipping from message to message, checked by reading each chunk at its range."""
    at = source(spark, sf, ranges=False)
    found = shards.with_offsets(shards.read_index(spark, at), shards.batch_offsets(spark, at))
    return _at_ranges(found, found.join(shards.list_shards(spark, at).select("shard", "path"), "shard"))


@query("offsets_csv", f"WITH {_NAMED} SELECT shard, chunk_x::BIGINT AS x, chunk_y::BIGINT AS y, chunk_z::BIGINT AS z, k // 3 AS batch_idx, {BLOCK_BYTES_SQL} AS uncompressed_size, 'exists' AS status FROM i")
def offsets_csv(spark, sf):
    """Offsets written beside old indexes, read back and used; a second run finds every shard done."""
    at, out = source(spark, sf, ranges=False), scratch(spark, "offsets")
    shards.write_offsets(spark, at, out)
    again = shards.write_offsets(spark, at, out)
    rows = spark.read.option("header", True).schema("x long, y long, z long, offset long, size long, batch_idx long, schema_size long, shard string").csv(out)
    return _at_ranges(rows, rows.join(shards.list_shards(spark, at).select("shard", "path"), "shard")).join(again, "shard")


@query("index_presence", f"WITH {_NAMED} SELECT shard, count(*) FILTER (chunk_x % 3 <> 0) AS found, count(*) FILTER (chunk_x % 3 = 0) AS missing FROM s GROUP BY 1")
def index_presence(spark, sf):
    """Index entries with and without a chunk in the file, for files that lack a third of them."""
    at = source(spark, sf)
    index, chunks = shards.read_index(spark, at), shards.read_shards(spark, at).where("chunk_x % 3 <> 0")
    found = shards.indexed_chunks(index, chunks).groupBy("shard").agg(F.count(F.lit(1)).alias("found"))
    missing = shards.missing_chunks(index, chunks).groupBy("shard").agg(F.count(F.lit(1)).alias("missing"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return found.join(missing, "shard", "full_outer").select("shard", zero("found"), zero("missing"))


@query("chunk_lookup", f"WITH {PALETTES} SELECT chunk_x, chunk_y, chunk_z, n::INT AS num_labels, n::INT AS num_supervoxels, {BLOCK_BYTES_SQL} AS uncompressed_size FROM b WHERE chunk_x = 3 AND chunk_y = 5 AND chunk_z = 0")
def chunk_lookup(spark, sf):
    return shards.chunk_info(shards.find_chunk(spark, source(spark, sf), 3, 5, 0)).drop("compressed_size")


@query("shard_listing", f"WITH {_NAMED} SELECT 0 AS scale, shard, true AS has_bytes FROM s GROUP BY shard")
def shard_listing(spark, sf):
    return shards.list_shards(spark, source(spark, sf)).select("scale", "shard", (F.col("bytes") > 0).alias("has_bytes"))


# --- runs ---------------------------------------------------------------------------------------------------


def _voxels(spark, out: str, level: int, scale: geometry.Scale) -> DataFrame:
    return volume.explode_voxels(pipelines.read_level(spark, out, level), scale)


@query("export_volume", f"WITH {V.VOX} SELECT x, y, z, label + 1000 AS label FROM vox")
def export_volume(spark, sf):
    """Source shards converted and written, labels mapped, read back as voxels."""
    out = scratch(spark, "volume")
    pipelines.export(spark, source(spark, sf), out, WHOLE)
    return _voxels(spark, out, 0, WHOLE)


@query("export_decimated", f"WITH {V.VOX} SELECT x, y, z // 2 AS z, label FROM vox WHERE z % 2 = 0")
def export_decimated(spark, sf):
    """The same with every second plane, supervoxels kept."""
    out = scratch(spark, "volume")
    pipelines.export(spark, source(spark, sf), out, WHOLE, label_type=codecs.SUPERVOXELS, z_compress=1)
    return _voxels(spark, out, 0, WHOLE)


_OUTCOMES = f"{_NAMED}, o AS (SELECT shard, count(*) AS chunks, count(*) FILTER (chunk_x % 4 = 1 AND chunk_y % 3 = 0) AS failed, count(*) FILTER (chunk_x >= 8 AND NOT (chunk_x % 4 = 1 AND chunk_y % 3 = 0)) AS outside FROM s GROUP BY 1)"


@query("export_outcomes", f"WITH {_OUTCOMES} SELECT shard, chunks, failed, outside, chunks - outside - failed AS written, chunks > outside + failed AS ok FROM o")
def export_outcomes(spark, sf):
    """What each source shard wrote of a volume that ends at half of it, some blocks being broken; shards that wrote nothing have failed."""
    at = source(spark, sf, broken=(F.col("chunk_x") % 4 == 1) & (F.col("chunk_y") % 3 == 0))
    return verification.shard_outcomes(pipelines.encode_source(spark, at, CUT), CUT)


@query("outcome_totals", f"WITH {_OUTCOMES} SELECT count(*) FILTER (chunks > outside + failed) AS shards_ok, count(*) FILTER (chunks = outside + failed) AS shards_failed, sum(chunks - outside - failed)::BIGINT AS written, sum(failed)::BIGINT AS failed, sum(outside)::BIGINT AS outside FROM o")
def outcome_totals(spark, sf):
    return telemetry.outcome_totals(export_outcomes(spark, sf))


@query("volume_files", f"WITH {V.VOX}, c AS (SELECT DISTINCT x // 8 AS cx, y // 8 AS cy, z // 8 AS cz FROM vox) SELECT {V.shard_sql(WHOLE, 'cx', 'cy', 'cz')} AS shard, {V.file_sql(V.shard_sql(WHOLE, 'cx', 'cy', 'cz'), WHOLE.shard)} AS file, count(*) AS chunks, list_sort(list({V.morton_sql(WHOLE, 'cx', 'cy', 'cz')}))[1] AS first_code FROM c GROUP BY 1, 2")
def volume_files(spark, sf):
    """Shard files of an exported scale with the chunks that each one's own indexes list."""
    out = scratch(spark, "volume")
    pipelines.export(spark, source(spark, sf), out, WHOLE)
    code = geometry.morton(WHOLE, *(F.col(f"chunk_{a}") for a in "xyz"))
    own = volumes.read_volume(spark, out).groupBy("shard").agg(F.count("*").alias("chunks"), F.min(code).alias("first_code"))
    return volumes.volume_files(spark, out).select("shard", "file").join(own, "shard")


@query("volume_box", f"WITH {V.VOX} SELECT x, y, z, label + 1000 AS label FROM vox WHERE x // 8 = 5 AND y // 8 BETWEEN 3 AND 9")
def volume_box(spark, sf):
    """The chunks of a box, read by the ranges of an exported scale's shard files that hold them."""
    out = scratch(spark, "volume")
    pipelines.export(spark, source(spark, sf), out, WHOLE)
    return volume.explode_voxels(pipelines.read_level(spark, out, 0, "chunk_x = 5 and chunk_y >= 3 and chunk_y < 10"), WHOLE)


@query("shard_pushdown", f"WITH {_NAMED} SELECT shard, chunk_x, chunk_y, chunk_z, {BLOCK_BYTES_SQL} AS uncompressed_size FROM s WHERE chunk_x = 5 AND chunk_y >= 3")
def shard_pushdown(spark, sf):
    """Filters on the source itself: they choose the batches that are read."""
    rows = shards.read_shards(spark, source(spark, sf)).where("chunk_x = 5 and chunk_y >= 3")
    return rows.select("shard", "chunk_x", "chunk_y", "chunk_z", "uncompressed_size")


@query("pyramid_run", ORACLES["mode_downsample"].replace("SELECT x, y, z, label FROM r", "SELECT x, y, z, label + 1000 AS label FROM r"))
def pyramid_run(spark, sf):
    """A whole run: export, verify, the next scale, verify; its second scale."""
    out = scratch(spark, "volume")
    runs.run(spark, source(spark, sf), out, [WHOLE, HALF])
    return _voxels(spark, out, 1, HALF)


@query("profile_run", f"WITH {V.VOX}, c AS (SELECT x // 8 AS cx, y // 8 AS cy, z // 8 AS cz, count(DISTINCT label) AS u FROM vox GROUP BY 1, 2, 3) SELECT {V.shard_sql(WHOLE, 'cx', 'cy', 'cz')} AS shard, count(*) AS chunks, sum(u)::BIGINT AS total_labels FROM c GROUP BY 1")
def profile_run(spark, sf):
    """Label totals of a written scale's shards; a second run finds nothing to do."""
    out, at = scratch(spark, "volume"), scratch(spark, "profiles")
    pipelines.export(spark, source(spark, sf), out, WHOLE, label_type=codecs.SUPERVOXELS)
    pipelines.profile_to(spark, out, 0, WHOLE, at)
    pipelines.profile_to(spark, out, 0, WHOLE, at)
    return spark.read.parquet(at).select("shard", "chunks", "total_labels")


@query("empty_source_shards", f"WITH {_NAMED} SELECT shard FROM s GROUP BY shard HAVING max(chunk_x) < 8")
def empty_source_shards(spark, sf):
    """Shards of background only, told from their label lists; here the volume's first half is cleared."""
    at = f"{scratch(spark, 'source')}/s0"
    zeros = F.array(F.lit(0).cast("long"))
    name = F.concat_ws("_", *(geometry.div(F.col(f"chunk_{a}"), ACROSS) * (ACROSS * 8) for a in "xyz"))
    kept = F.col("chunk_x") >= 8
    b = blocks(spark, sf).withColumns({"shard": name, "labels": F.when(kept, F.col("labels")).otherwise(zeros), "supervoxels": F.when(kept, F.col("supervoxels")).otherwise(zeros)})
    shards.write_shards(b, at).write.format("noop").mode("overwrite").save()
    return pipelines.empty_shards(spark, at)


@query("segmentation_voxels", f"WITH {V.VOX} SELECT x, y, z, label + 1000 AS label FROM vox")
def segmentation_voxels(spark, sf):
    """Stored blocks transcoded to gzipped segmentations and decoded again."""
    encoded = codecs.to_segmentation(blocks(spark, sf), shape=(8, 8, 8))
    return volume.explode_voxels(codecs.from_segmentation(encoded.where("error is null"), (8, 8, 8)), WHOLE)


@query("file_listings", "SELECT 'output' AS kind, printf('%02x.shard', s_suppkey) AS name, s_suppkey AS number, s_suppkey % 7 + 1 AS bytes FROM supplier UNION ALL SELECT 'profile', s_suppkey || '_0_0', NULL, s_suppkey % 5 + 2 FROM supplier UNION ALL SELECT 'prediction', s_suppkey || '-predicted-1.csv', NULL, s_suppkey % 3 + 3 FROM supplier")
def file_listings(spark, sf):
    """Outputs, label profiles and predictions found by name in one folder, among files of other names."""
    at, none, k = scratch(spark, "listing"), F.lit(None).cast("long").alias("number"), F.col("s_suppkey")
    named = lambda name, n: F.struct(name.alias("name"), F.repeat(F.lit("x"), n.cast("int")).alias("content"))
    tail = lambda end: F.concat(k.cast("string"), F.lit(end))
    every = F.array(named(F.format_string("%02x.shard", k), k % 7 + 1), named(tail("_0_0-labels.csv"), k % 5 + 2), named(tail("-predicted-1.csv"), k % 3 + 3), named(tail(".txt"), k % 2 + 1))
    write_files(table(spark, sf, "supplier").select(F.inline(every)), at).write.format("noop").mode("overwrite").save()
    out = shards.list_outputs(spark, at).select(F.lit("output").alias("kind"), F.col("file").alias("name"), "number", "bytes")
    profiles = shards.list_profiles(spark, at).select(F.lit("profile").alias("kind"), F.col("shard").alias("name"), none, "bytes")
    return out.unionByName(profiles).unionByName(shards.list_predictions(spark, at).select(F.lit("prediction").alias("kind"), F.col("file").alias("name"), none, "bytes"))


# --- planning -----------------------------------------------------------------------------------------------


@query("deletion_plan", f"WITH {V.SHARDS}, c AS (SELECT DISTINCT scale, shard FROM shards WHERE o_orderkey % 3 = 0) SELECT o_orderkey, s.scale, s.shard, bytes / chunks AS bytes_per_chunk FROM shards s JOIN c ON s.scale = c.scale AND s.shard = c.shard WHERE chunks <> 0 AND bytes / chunks < 5000")
def deletion_plan(spark, sf):
    """Shards confirmed empty that still look so; nothing is deleted."""
    s = V.shards(spark, sf)
    return planning.deletion_plan(s, s.where("o_orderkey % 3 = 0"), ["scale", "shard"], 5000).select("o_orderkey", "scale", "shard", "bytes_per_chunk")


_KNOWN = f"WITH {V.NUMBERED}, p AS (SELECT DISTINCT number AS n FROM numbered), po AS (SELECT {_PARENT} FROM p), c AS (SELECT DISTINCT {V.shard_sql(V.LARGE_HALF, 'px // 2', 'py // 2', 'pz // 2')} AS n FROM po WHERE px < {V.LARGE.grid[0]} AND py < {V.LARGE.grid[1]} AND pz < {V.LARGE.grid[2]}), co AS (SELECT n, {_CHILD} FROM c), k AS (SELECT n, {_ROOM} AS chunks FROM co)"


@query("label_aware_plan", f"{_KNOWN} SELECT n AS shard, CASE WHEN n % 2 = 0 THEN 'label_aware' ELSE 'chunk_count' END AS estimate_model, CASE WHEN n % 2 = 0 THEN n * 1000 END AS total_labels FROM k WHERE chunks > 0")
def label_aware_plan(spark, sf):
    """Child shards with the label-aware estimate where label totals are known and the chunk count's elsewhere."""
    p = V.numbered(spark, sf).select(F.col("number").alias("shard")).distinct()
    totals = geometry.child_shards(V.LARGE, V.LARGE_HALF, p).where("shard % 2 = 0").select("shard", (F.col("shard") * 1000).alias("total_labels"))
    return planning.downres_plan(V.LARGE, V.LARGE_HALF, 1, p, label_totals=totals, max_tasks=100).select("shard", "estimate_model", "total_labels")


# --- specs, manifests, profiles, logs -----------------------------------------------------------------------

def _spec_text(k: int) -> str:
    """A volume's spec with two scales, as it is written beside an output volume."""
    sharding = {"preshift_bits": k % 10, "minishard_bits": k % 7, "shard_bits": k % 12, "hash": "identity"}
    one = lambda n: {"key": f"v{k}s{n}", "size": [(1000 + k) >> n, 500, 300], "chunk_sizes": [[64, 64, 64], [32, 32, 32]], "resolution": [8.0, 8.0, 8.0], "voxel_offset": [0, 0, 0], "encoding": "raw", "sharding": sharding}
    return specs.destination_info(json.dumps({"@type": specs.SPEC_TYPE, "type": "segmentation", "data_type": "uint64", "num_channels": 1, "scales": [one(0), one(1)]}), "raw" if k % 2 else "compressed_segmentation")


@query("spec_scan", "SELECT scale, 'v' || s_suppkey || 's' || scale AS key, (1000 + s_suppkey) >> scale AS size_x, 64::BIGINT AS chunk_x, (s_suppkey % 10)::INT AS preshift, (s_suppkey % 7)::INT AS minishard, (s_suppkey % 12)::INT AS shard_bits, (1 << ((18 + s_suppkey % 10 + s_suppkey % 7) // 3)::INT)::DOUBLE AS side, CASE WHEN s_suppkey % 2 = 0 THEN 'compressed_segmentation' ELSE 'raw' END AS encoding, CASE WHEN s_suppkey % 2 = 0 THEN 8 END AS block FROM supplier, (SELECT range::INT AS scale FROM range(2)) r")
def spec_scan(spark, sf):
    """The scales of one volume's info file per supplier, either variant as written beside an output volume."""
    at = scratch(spark, "spec")
    ship(spark)
    text = F.udf(_spec_text)
    write_files(table(spark, sf, "supplier").select(F.concat(F.lit("v"), F.col("s_suppkey").cast("string"), F.lit("/info")).alias("name"), text("s_suppkey").alias("content")), at).write.format("noop").mode("overwrite").save()
    s = specs.read_spec(spark, f"{at}/v*")
    side = geometry.rough_shard(F.col("scale"), F.col("sharding.preshift_bits"), F.col("sharding.minishard_bits"))["side"]
    return s.select(
        "scale", "key", F.col("size")[0].alias("size_x"), F.col("chunk")[0].alias("chunk_x"), F.col("sharding.preshift_bits").alias("preshift"), F.col("sharding.minishard_bits").alias("minishard"), F.col("sharding.shard_bits").alias("shard_bits"), side.cast("double").alias("side"),
        "encoding", F.col("compressed_segmentation_block_size")[0].alias("block"),
    )


def _tasks(spark, sf) -> DataFrame:
    return planning.balanced(planning.with_tier(V.shards(spark, sf)), "bytes", 50, tie="o_orderkey")


_PLAN = f"WITH RECURSIVE {V.SHARDS}, t AS (SELECT *, {_EXPORT} AS memory_gib FROM shards), r AS (SELECT o_orderkey AS k, bytes AS w, {_TIER('memory_gib')} AS tier_gib FROM t){_LPT.format(tasks=50)}, tasks AS (SELECT o.k AS o_orderkey, o.tier_gib, a.task AS task_id FROM o JOIN a ON o.tier_gib = a.tier_gib AND o.i = a.i)"


@query("manifests", f"{_PLAN} SELECT o_orderkey, tier_gib, task_id FROM tasks")
def manifests(spark, sf):
    at = scratch(spark, "manifests")
    specs.write_manifests(_tasks(spark, sf).select("o_orderkey", "tier_gib", "task_id"), at)
    return specs.read_manifests(spark, at, "o_orderkey long").select("o_orderkey", "tier_gib", "task_id")


@query("manifest_summary", f"{_PLAN} SELECT tier_gib, count(*) AS shards, count(DISTINCT task_id) AS tasks FROM tasks GROUP BY ROLLUP (tier_gib)")
def manifest_summary(spark, sf):
    at = scratch(spark, "summary")
    specs.write_summary(_tasks(spark, sf), at)
    return specs.read_summary(spark, at)


@query("tier_totals", f"{_PLAN}, s AS (SELECT tier_gib, count(*) AS n FROM tasks GROUP BY 1), j AS (SELECT s_suppkey, 'export-tier-' || (4 * (1 + s_suppkey % 3)) || 'gi' AS job, 4 * (1 + s_suppkey % 3) AS t FROM supplier) SELECT s_suppkey, job, n AS tier_shards FROM j LEFT JOIN s ON t = tier_gib")
def tier_totals(spark, sf):
    """Jobs with the planned shards of the tier in their name."""
    jobs = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("export-tier-"), (4 * (1 + F.col("s_suppkey") % 3)).cast("string"), F.lit("gi")).alias("job"))
    return specs.with_tier_totals(jobs, "job", specs.manifest_summary(_tasks(spark, sf))).select("s_suppkey", "job", "tier_shards")


@query("debug_manifest", f"WITH {V.SHARDS} SELECT (4 * (1 + o_orderkey % 3))::INT AS tier_gib, (o_orderkey % 20)::INT AS task_id, scale, shard FROM shards WHERE o_orderkey % 5 = 0")
def debug_manifest(spark, sf):
    """Chosen shards as replay manifests in the array form, a file per tier and task, read back."""
    at, k = scratch(spark, "debug"), F.col("o_orderkey")
    chosen = V.shards(spark, sf).where(k % 5 == 0).withColumns({"tier_gib": (4 * (1 + k % 3)).cast("int"), "task_id": (k % 20).cast("int")})
    specs.write_task_files(chosen, at, order=("o_orderkey",)).write.format("noop").mode("overwrite").save()
    return specs.read_task_files(spark, at)


_PROFILE = "profile AS (SELECT (o_orderkey % 6)::INT AS scale, 's' || o_orderkey % 50 AS shard, o_orderkey AS x, o_orderkey % 7 AS y, o_orderkey % 5 AS z, o_custkey % 90 AS num_labels, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 80 END AS unique_labels FROM orders)"


def _profile(spark, sf) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = table(spark, sf, "orders")
    return o.select((k % 6).cast("int").alias("scale"), F.concat(F.lit("s"), (k % 50).cast("string")).alias("shard"), k.alias("x"), (k % 7).alias("y"), (k % 5).alias("z"), (c % 90).alias("num_labels"), (c % 90).alias("num_supervoxels"), F.when(k % 3 != 0, c % 80).alias("unique_labels"))


@query("profile_csv", f"WITH {_PROFILE} SELECT x, y, z, num_labels, coalesce(unique_labels, num_labels) AS unique_labels FROM profile")
def profile_csv(spark, sf):
    at = scratch(spark, "profiles")
    specs.write_profiles(_profile(spark, sf), at)
    return specs.read_profiles(spark, at).select("x", "y", "z", "num_labels", "unique_labels")


@query("label_summary", f"WITH {_PROFILE} SELECT shard, sum(coalesce(unique_labels, num_labels))::BIGINT AS total_labels FROM profile GROUP BY 1")
def label_summary(spark, sf):
    """Label totals by shard, from the one summary file that stands before the profiles."""
    at = scratch(spark, "labels")
    totals = _profile(spark, sf).groupBy("shard").agg(F.sum(F.coalesce("unique_labels", "num_labels")).alias("total_labels"))
    specs.write_label_summary(totals, at)
    return specs.shard_labels(spark, at)


@query("log_events", f"WITH {V.LOG} SELECT event_id, shard_number, scale FROM log WHERE scale = 1 AND event_id % 2 = 0 AND event_type LIKE '%c%'")
def log_events(spark, sf):
    """Log lines written as text, read back by job, execution and a pattern on the event."""
    at = scratch(spark, "log")
    e = V.log(spark, sf)
    fields = F.struct(F.col("event_type").alias("event"), F.concat(F.lit("job-"), F.col("scale").cast("string")).alias("job"), F.concat(F.lit("run-"), (F.col("event_id") % 2).cast("string")).alias("execution"), "event_id", "shard_number", "scale")
    lines = e.select(F.concat(F.lit("INFO worker: "), F.to_json(fields)).alias("value"))
    lines.unionByName(spark.createDataFrame([("no event",), ("broken {",)], "value string")).write.text(at)
    out = specs.read_events(spark, at, "event string, job string, execution string, event_id long, shard_number long, scale int", event="c", job="job-1", execution="run-0")
    return out.select("event_id", "shard_number", "scale")


SETTINGS = "source string, destination string, label_type string, z_compress int, scales string, downres_scales string, memory_gib double, staging string, manifests string, limit_minutes int, polling_seconds int"


def _settings(text: str) -> tuple:
    c = specs.config_from_env(specs.read_env(text))
    joined = lambda v: ",".join(map(str, v))
    return (c.source, c.destination, c.label_type, c.z_compress, joined(c.scales), joined(c.downres_scales), c.memory_gib, c.staging, c.manifests, c.limit_minutes, c.polling_seconds)


@query("settings", "SELECT s_suppkey, s_name AS source, 'out/' || s_suppkey AS destination, CASE WHEN s_suppkey % 2 = 0 THEN 'supervoxels' ELSE 'labels' END AS label_type, (s_suppkey % 4)::INT AS z_compress, '0,' || s_suppkey % 9 AS scales, '3,4' AS downres_scales, (s_suppkey % 16)::DOUBLE AS memory_gib, '/tmp/s' AS staging, 'm' AS manifests, CASE WHEN s_suppkey % 3 = 0 THEN 60 ELSE 1440 END AS limit_minutes, CASE WHEN s_suppkey % 5 = 0 THEN 30 ELSE 10 END AS polling_seconds FROM supplier")
def settings(spark, sf):
    """Settings of a run per supplier, from env files with comments, quotes and settings left to their defaults."""
    ship(spark)
    k = F.col("s_suppkey")
    line = lambda name, value: F.concat(F.lit(f"{name}="), value.cast("string"), F.lit("\n"))
    rest = F.lit("NG_SPEC=" + base64.b64encode(b"{}").decode() + "\nDOWNRES_SCALES=3, 4\nSTAGING_PATH=/tmp/s\nMANIFEST_URI=m\n")
    env = F.concat(F.lit("# settings\nexport SOURCE_PATH="), F.col("s_name"), F.lit("\n"), line("DEST_PATH", F.concat(F.lit("'out/"), k.cast("string"), F.lit("'"))), line("Z_COMPRESS", k % 4), line("SCALES", F.concat(F.lit("0,"), (k % 9).cast("string"))), line("WORKER_MEMORY_GIB", k % 16), rest)
    given = [F.when(k % 2 == 0, "LABEL_TYPE=supervoxels\n"), F.when(k % 3 == 0, "MAX_PROCESSING_TIME=60\n"), F.when(k % 5 == 0, "POLLING_INTERVAL=30\n")]
    own = table(spark, sf, "supplier").select("s_suppkey", F.concat(env, *(F.coalesce(g, F.lit("")) for g in given)).alias("env"))
    return own.select("s_suppkey", F.udf(_settings, SETTINGS)("env").alias("c")).select("s_suppkey", "c.*")


@query("truncated_events", f"WITH {V.LOG} SELECT least(count(*), 21) AS n, count(*) > 20 AS more FROM log")
def truncated_events(spark, sf):
    """The first 20 events and one more, which tells that there are more."""
    at = scratch(spark, "log")
    V.log(spark, sf).select(F.to_json(F.struct(F.col("event_type").alias("event"))).alias("value")).write.text(at)
    return specs.read_events(spark, at, "event string", limit=20).agg(F.count(F.lit(1)).alias("n")).withColumn("more", F.col("n") > 20)


@query("label_types", "SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN 'supervoxels' END, CASE WHEN s_suppkey % 2 = 0 THEN 'env' END, 'labels') AS label_type, 'bucket' AS bucket, 'dir/' || s_name AS key, s_suppkey + 0.5::DOUBLE AS seconds FROM supplier")
def label_types(spark, sf):
    """Resolved label types, the parts of object addresses, and seconds between ISO times."""
    k = F.col("s_suppkey")
    bucket, key = text.bucket_and_key(F.concat(F.lit("gs://bucket/dir/"), F.col("s_name")))
    start = F.timestamp_seconds(F.lit(1_700_000_000))
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    end = F.timestamp_micros(F.lit(1_700_000_000_000_000) + k * 1_000_000 + 500_000)
    return table(spark, sf, "supplier").select("s_suppkey", specs.resolve_label_type(F.when(k % 3 == 0, "supervoxels"), F.when(k % 2 == 0, "env")).alias("label_type"), bucket.alias("bucket"), key.alias("key"), text.seconds_between(iso(start), iso(end)).alias("seconds"))


@query("report_csv", f"WITH {V.LOG}, r AS (SELECT event_type, scale, count(*) AS errors FROM log GROUP BY 1, 2) SELECT event_type, scale, errors, row_number() OVER (ORDER BY scale, event_type)::INT AS line FROM r")
def report_csv(spark, sf):
    """A report as one sorted CSV; the line numbers are the file's."""
    at = scratch(spark, "report")
    specs.write_report(telemetry.error_counts(V.log(spark, sf), ["event_type", "scale"]), at, ["scale", "event_type"])
    whole = spark.read.text(at, wholetext=True).select(F.posexplode(F.split(F.trim("value"), "\n")).alias("line", "row")).where("line > 0 and row <> ''")
    part = lambda k: F.split("row", ",")[k]
    return whole.select(part(0).alias("event_type"), part(1).cast("int").alias("scale"), part(2).cast("long").alias("errors"), "line")


@query("text_digests", "SELECT s_suppkey, base64(s_name::BLOB) AS coded, md5(s_name) AS digest, substr(sha256(s_name), 1, 12) AS short, regexp_matches('tier-' || s_suppkey, '^[a-z][a-z0-9-]{0,62}$') AS valid, CASE WHEN s_suppkey >= 3600 THEN (s_suppkey // 3600) || 'h' || printf('%02d', s_suppkey % 3600 // 60) || 'm' || printf('%02d', s_suppkey % 60) || 's' WHEN s_suppkey >= 60 THEN (s_suppkey // 60) || 'm' || printf('%02d', s_suppkey % 60) || 's' ELSE s_suppkey || 's' END AS elapsed, (s_suppkey % 64 + 1) / 1024.0::DOUBLE AS memory_gib, 'http://h/api/node/u/seg/labels?scale=2&hash=' || md5('[[' || s_suppkey || ',1,2]]') || '&supervoxels=true' AS address FROM supplier")
def text_digests(spark, sf):
    k = F.col("s_suppkey")
    body = F.to_json(F.array(F.array(k, F.lit(1).cast("long"), F.lit(2).cast("long"))))
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.base64(F.col("s_name").cast("binary")).alias("coded"), F.md5("s_name").alias("digest"), text.short_digest(F.col("s_name")).alias("short"), text.valid_name(F.concat(F.lit("tier-"), k.cast("string"))).alias("valid"),
        text.elapsed(k.cast("double")).alias("elapsed"), text.memory_gib(F.concat((k % 64 + 1).cast("string"), F.lit("Mi"))).alias("memory_gib"), text.labels_url(F.lit("http://h/api/"), F.lit("u"), F.lit("seg"), F.lit(2), True, body).alias("address"),
    )


def _answer(address: str, body: bytes) -> bytes:
    """A label service that knows a rule instead of a volume."""
    return json.dumps([(1 << 64) - 1 - x if x % 5 == 0 else x * 3 + y for x, y, _ in json.loads(body)]).encode()


@query("service_labels", "SELECT o_orderkey AS point_id, CASE WHEN o_custkey % 5 = 0 THEN -1 - o_custkey ELSE o_custkey * 3 + o_orderkey % 128 END AS label FROM orders")
def service_labels(spark, sf):
    """Labels of points from a service, in checked batches, as int64 patterns."""
    p = table(spark, sf, "orders").select(F.col("o_orderkey").alias("point_id"), F.col("o_custkey").alias("x"), (F.col("o_orderkey") % 128).alias("y"), (F.col("o_orderkey") % 8).alias("z"))
    return label_service.service_labels(p, "http://h", "u", "seg", 0, ask=_answer).select("point_id", "label")
