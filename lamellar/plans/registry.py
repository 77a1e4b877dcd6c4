"""The engine's queries over the benchmark tables, each beside the SQL that states its result."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.functions import bits, geometry, models, text
from lamellar.operators import calibration, chunked, codecs, labels, labelsets, planning, ranks, telemetry, verification, volume
from lamellar.session import materialize, scratch, table
from lamellar.sources import colocated, shards
from lamellar.streaming import progress

from . import views as V
from .views import HALF, LARGE, LARGE_HALF, TOY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

G = float(1 << 30)


def query(name: str, sql: str | None = None):
    """Register a query and, if there is one, its SQL."""

    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


def _coords(li: DataFrame) -> DataFrame:
    return li.select("l_orderkey", "l_linenumber", (F.col("l_partkey") * 37 % 1471).alias("cx"), (F.col("l_orderkey") * 11 % 1224).alias("cy"), (F.col("l_suppkey") * 101 % 2103).alias("cz"))


COORDS = "coords AS (SELECT l_orderkey, l_linenumber, l_partkey * 37 % 1471 AS cx, l_orderkey * 11 % 1224 AS cy, l_suppkey * 101 % 2103 AS cz FROM lineitem)"
_M = V.morton_sql(LARGE, "cx", "cy", "cz")


# --- geometry ---------------------------------------------------------------------------------------------


@query("grid_bits", "SELECT o_orderkey, CASE WHEN c = 0 THEN 0 ELSE length(bin(c)) END::INT AS nbits FROM (SELECT o_orderkey, greatest(0, ceil(o_custkey / (1.0 + o_orderkey % 64))::BIGINT - 1) AS c FROM orders)")
def grid_bits(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", geometry.grid_bits(F.col("o_custkey"), 1.0 + F.col("o_orderkey") % 64).cast("int").alias("nbits"))


@query("morton_code", f"WITH {COORDS} SELECT l_orderkey, l_linenumber, cx, cy, cz, {_M} AS code FROM coords")
def morton_code(spark, sf):
    return _coords(table(spark, sf, "lineitem")).withColumn("code", geometry.morton(LARGE, F.col("cx"), F.col("cy"), F.col("cz")))


@query("shard_number", f"WITH {COORDS}, m AS (SELECT l_orderkey, l_linenumber, {_M} AS code FROM coords) SELECT l_orderkey, l_linenumber, (code >> 15) & 524287 AS shard, (code >> 9) & 63 AS minishard FROM m")
def shard_number(spark, sf):
    m = _coords(table(spark, sf, "lineitem")).select("l_orderkey", "l_linenumber", geometry.morton(LARGE, F.col("cx"), F.col("cy"), F.col("cz")).alias("code"))
    return m.select("l_orderkey", "l_linenumber", geometry.shard_number(LARGE, F.col("code")).alias("shard"), geometry.minishard_number(LARGE, F.col("code")).alias("minishard"))


@query("shard_filename", f"SELECT p_partkey, {V.file_sql('p_partkey', 19)} AS file, {V.file_sql('(p_partkey % 16)', 4)} AS short_file FROM part")
def shard_filename(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", geometry.shard_filename(F.col("p_partkey"), 19).alias("file"), geometry.shard_filename(F.col("p_partkey") % 16, 4).alias("short_file"))


_BOX = ", ".join(f"{V.origin_sql(LARGE, 'n', k)} * 64 AS o{a}" for k, a in enumerate("xyz"))


@query(
    "shard_bbox",
    f"WITH b AS (SELECT DISTINCT l_partkey * 97 % 262144 AS n FROM lineitem), o AS (SELECT n AS shard, {_BOX} FROM b), "
    f"e AS (SELECT *, greatest(0, least({LARGE.shard_shape[0] * 64}, 94088 - ox)) AS ex, greatest(0, least({LARGE.shard_shape[1] * 64}, 78317 - oy)) AS ey, greatest(0, least({LARGE.shard_shape[2] * 64}, 134576 - oz)) AS ez, "
    f"greatest(0, least({LARGE.shard_shape[0]}, 1471 - ox // 64)) * greatest(0, least({LARGE.shard_shape[1]}, 1224 - oy // 64)) * greatest(0, least({LARGE.shard_shape[2]}, 2103 - oz // 64)) AS chunks FROM o) "
    "SELECT *, ex * ey * ez AS volume FROM e WHERE ex * ey * ez > 0",
)
def shard_bbox(spark, sf):
    n = table(spark, sf, "lineitem").select((F.col("l_partkey") * 97 % 262144).alias("shard")).distinct()
    return geometry.shard_table(LARGE, n)


@query("nonempty_shards", f"WITH n AS (SELECT DISTINCT o_orderkey * 7919 % {2 * LARGE.shard_numbers} AS n FROM orders) SELECT n AS shard FROM n WHERE n < {LARGE.shard_numbers} AND " + " AND ".join(f"{V.origin_sql(LARGE, 'n', k)} < {g}" for k, g in enumerate(LARGE.grid)))
def nonempty_shards(spark, sf):
    """Of the numbers that orders name, those of shards inside the grid."""
    numbers = table(spark, sf, "orders").select((F.col("o_orderkey") * 7919 % (2 * LARGE.shard_numbers)).alias("shard")).distinct()
    return geometry.nonempty_shards(LARGE, numbers)


#: Toy shards with a voxel of one label in eleven.
_HELD = f"{V.VOX}, e AS (SELECT DISTINCT {V.shard_sql(TOY, 'x // 8', 'y // 8', 'z // 4')} AS n FROM vox WHERE label % 11 = 0)"


def _held(spark, sf):
    return V.vox(spark, sf).where("label % 11 = 0").select(geometry.shard_of_voxel(TOY, F.col("x"), F.col("y"), F.col("z")).alias("shard")).distinct()


@query("shard_chunks", f"WITH {_HELD}, c AS (SELECT x.range AS cx, y.range AS cy, z.range AS cz FROM range({TOY.grid[0]}) x, range({TOY.grid[1]}) y, range({TOY.grid[2]}) z), s AS (SELECT {V.shard_sql(TOY, 'cx', 'cy', 'cz')} AS shard, cx, cy, cz FROM c) SELECT s.* FROM s JOIN e ON shard = n")
def shard_chunks(spark, sf):
    return geometry.chunk_coordinates(TOY, _held(spark, sf))


@query("voxel_to_shard", f"WITH {V.VOX} SELECT x, y, z, {V.shard_sql(TOY, 'x // 8', 'y // 8', 'z // 4')} AS shard FROM vox")
def voxel_to_shard(spark, sf):
    return V.vox(spark, sf).select("x", "y", "z", geometry.shard_of_voxel(TOY, F.col("x"), F.col("y"), F.col("z")).alias("shard"))


@query("name_to_shard", f"WITH {V.SHARDS} SELECT o_orderkey, shard, {V.name_sql(LARGE, 'shard')} AS number, {V.name_sql(LARGE, 'shard', 1)} AS number_z1 FROM shards")
def name_to_shard(spark, sf):
    return V.shards(spark, sf).select("o_orderkey", "shard", geometry.shard_of_name(LARGE, F.col("shard")).alias("number"), geometry.shard_of_name(LARGE, F.col("shard"), 1).alias("number_z1"))


@query("z_decimate", f"WITH {V.VOX} SELECT x, y, z // 4 AS z, label FROM vox WHERE z % 4 = 0")
def z_decimate(spark, sf):
    return geometry.decimate_z(V.vox(spark, sf), 3).select("x", "y", "z", "label")


@query("clip_volume", f"WITH {V.VOX} SELECT * FROM vox WHERE x < 100 AND y < 90 AND z < 6")
def clip_volume(spark, sf):
    return geometry.clip(V.vox(spark, sf), geometry.Scale("cut", (100, 90, 6)))


@query("parent_child_shards", f"WITH p AS (SELECT DISTINCT l_partkey % {TOY.shard_numbers} AS n FROM lineitem), c AS (SELECT x.range AS cx, y.range AS cy, z.range AS cz FROM range(16) x, range(16) y, range(2) z), pc AS (SELECT * FROM c WHERE {V.shard_sql(TOY, 'cx', 'cy', 'cz')} IN (SELECT n FROM p)) SELECT DISTINCT {V.shard_sql(HALF, 'cx // 2', 'cy // 2', 'cz // 2')} AS shard FROM pc")
def parent_child_shards(spark, sf):
    p = table(spark, sf, "lineitem").select((F.col("l_partkey") % TOY.shard_numbers).alias("shard")).distinct()
    return geometry.child_shards(TOY, HALF, p)


# --- label statistics -------------------------------------------------------------------------------------


def _toy_chunks(spark, sf) -> DataFrame:
    v = V.vox(spark, sf)
    return v.groupBy(*(geometry.div(F.col(a), c).alias(f"chunk_{a}") for a, c in zip("xyz", TOY.chunk, strict=True))).agg(F.sort_array(F.collect_list("label")).alias("labels"), F.sort_array(F.collect_list(F.col("label") * 10)).alias("supervoxels"))


CHUNKS = f"{V.VOX}, keyed AS (SELECT x // 8 AS chunk_x, y // 8 AS chunk_y, z // 4 AS chunk_z, label FROM vox)"


@query("label_counts_per_chunk", f"WITH {CHUNKS} SELECT chunk_x, chunk_y, chunk_z, count(*)::INT AS num_labels, count(*)::INT AS num_supervoxels, count(DISTINCT label)::INT AS unique_labels FROM keyed GROUP BY ALL")
def label_counts_per_chunk(spark, sf):
    return labels.chunk_counts(_toy_chunks(spark, sf))


_SHARD = V.shard_sql(TOY, "chunk_x", "chunk_y", "chunk_z")


@query("shard_label_stats", f"WITH {CHUNKS}, c AS (SELECT chunk_x, chunk_y, chunk_z, count(*) AS n, count(DISTINCT label) AS u FROM keyed GROUP BY 1, 2, 3) SELECT {_SHARD} AS shard, count(*) AS chunk_count, sum(n)::BIGINT AS total_num_labels, round(avg(n), 6) AS mean_num_labels, max(n)::INT AS max_num_labels, sum(u)::BIGINT AS total_unique_labels, round(avg(u), 6) AS mean_unique_labels, max(u)::INT AS max_unique_labels FROM c GROUP BY 1")
def shard_label_stats(spark, sf):
    c = labels.chunk_counts(_toy_chunks(spark, sf))
    s = geometry.shard_number(TOY, geometry.morton(TOY, F.col("chunk_x"), F.col("chunk_y"), F.col("chunk_z")))
    out = labels.stats(c.withColumn("shard", s), ["shard"], ["num_labels", "unique_labels"])
    return out.withColumns({f"mean_{k}": F.round(f"mean_{k}", 6) for k in ("num_labels", "unique_labels")})


@query("child_label_union", f"WITH {CHUNKS} SELECT chunk_x // 2 AS chunk_x, chunk_y // 2 AS chunk_y, chunk_z // 2 AS chunk_z, count(DISTINCT label) AS unique_labels FROM keyed GROUP BY 1, 2, 3")
def child_label_union(spark, sf):
    return labels.child_union(_toy_chunks(spark, sf))


@query("max_merge_predictions", f"WITH {CHUNKS}, c AS (SELECT chunk_x, chunk_y, chunk_z, count(*) AS n, count(DISTINCT label) AS u FROM keyed GROUP BY 1, 2, 3) SELECT chunk_x // 2 AS x, chunk_y // 2 AS y, chunk_z // 2 AS z, max(n)::INT AS num_labels, max(n)::INT AS num_supervoxels, max(u)::INT AS unique_labels FROM c GROUP BY 1, 2, 3")
def max_merge_predictions(spark, sf):
    c = labels.chunk_counts(_toy_chunks(spark, sf)).select(*(F.shiftright(f"chunk_{a}", 1).alias(a) for a in "xyz"), "num_labels", "num_supervoxels", "unique_labels")
    return labels.merged_predictions(c)


@query("labels_by_shard", f"WITH {CHUNKS}, c AS (SELECT chunk_x, chunk_y, chunk_z, count(DISTINCT label) AS u FROM keyed GROUP BY 1, 2, 3) SELECT {_SHARD} AS shard, count(*) AS chunks, sum(u)::BIGINT AS total_labels FROM c GROUP BY 1")
def labels_by_shard(spark, sf):
    c = labels.distinct_per_cell(V.vox(spark, sf), [geometry.div(F.col(a), n).alias(a) for a, n in zip("xyz", TOY.chunk, strict=True)])
    return labels.totals_by_shard(c, TOY)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks and distinct labels of each output shard, by file name."""
    out = labels_by_shard(spark, sf)
    return out.select(geometry.shard_filename(F.col("shard"), TOY.shard).alias("file"), "chunks", "total_labels")


query("shard_contents", f"WITH {CHUNKS}, c AS (SELECT chunk_x, chunk_y, chunk_z, count(DISTINCT label) AS u FROM keyed GROUP BY 1, 2, 3), s AS (SELECT {_SHARD} AS shard, count(*) AS chunks, sum(u)::BIGINT AS total_labels FROM c GROUP BY 1) SELECT {V.file_sql('shard', TOY.shard)} AS file, chunks, total_labels FROM s")(flagship)


@query("distinct_labels_readback", f"WITH {V.VOX}, c AS (SELECT DISTINCT x // 8 AS cx, y // 8 AS cy, z // 4 AS cz, label FROM vox WHERE label <> 0) SELECT cx, cy, cz, count(*) AS unique_labels FROM c GROUP BY 1, 2, 3")
def distinct_labels_readback(spark, sf):
    return labels.distinct_per_cell(V.vox(spark, sf).where("label <> 0"), volume.chunk_key(TOY))


@query(
    "mode_downsample",
    f"WITH {V.VOX}, v AS (SELECT x // 2 AS x, y // 2 AS y, z // 2 AS z, label, count(*) AS n FROM vox GROUP BY ALL), "
    "f AS (SELECT x, y, z, least(2, 128 - 2 * x) * least(2, 128 - 2 * y) * least(2, 8 - 2 * z) - sum(n) AS zeros FROM v GROUP BY 1, 2, 3), "
    "a AS (SELECT x, y, z, label, n FROM v UNION ALL SELECT x, y, z, 0, zeros::BIGINT FROM f WHERE zeros > 0), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY n DESC, label) AS k FROM a) SELECT x, y, z, label FROM r WHERE k = 1 AND label <> 0",
)
def mode_downsample(spark, sf):
    return volume.downsample(V.vox(spark, sf), TOY.size)


@query("mode_present", f"WITH {V.VOX}, v AS (SELECT x // 4 AS x, y // 4 AS y, label, count(*) AS n FROM vox GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY x, y)::BIGINT AS voxels, row_number() OVER (PARTITION BY x, y ORDER BY n DESC, label) AS k FROM v) SELECT x, y, label, voxels FROM r WHERE k = 1")
def mode_present(spark, sf):
    return volume.majority(V.vox(spark, sf), [F.floor(F.col(a) / 4).cast("long").alias(a) for a in "xy"])


@query("empty_shards", f"WITH {V.VOX} SELECT x // 8 AS shard, bool_or(label % 7 = 0) AS nonempty FROM vox GROUP BY 1")
def empty_shards(spark, sf):
    v = V.vox(spark, sf).withColumn("label", F.when(F.col("label") % 7 == 0, F.col("label")).otherwise(0))
    c = v.groupBy(F.floor(F.col("x") / 8).cast("long").alias("shard"), "y").agg(F.collect_list("label").alias("labels"), F.collect_list("label").alias("supervoxels"))
    return labels.nonempty(c, ["shard"])


@query("background_chunks", f"WITH {V.VOX} SELECT x // 8 AS cx, y // 8 AS cy, z FROM vox GROUP BY 1, 2, 3 HAVING max(CASE WHEN label % 5 = 0 THEN label ELSE 0 END) = 0")
def background_chunks(spark, sf):
    v = V.vox(spark, sf).withColumn("label", F.when(F.col("label") % 5 == 0, F.col("label")).otherwise(F.lit(0).cast("long")))
    c = v.groupBy(F.floor(F.col("x") / 8).cast("long").alias("cx"), F.floor(F.col("y") / 8).cast("long").alias("cy"), "z").agg(F.collect_list("label").alias("labels"))
    return c.where(labels.background_only(F.col("labels"))).select("cx", "cy", "z")


@query("label_mapping", f"WITH {V.VOX}, m AS (SELECT s_suppkey AS sv, s_nationkey::BIGINT + 100000 AS l FROM supplier WHERE s_suppkey % 3 <> 0) SELECT x, y, z, vox.label AS sv, coalesce(m.l, vox.label) AS label FROM vox LEFT JOIN m ON vox.label = m.sv")
def label_mapping(spark, sf):
    pairs = table(spark, sf, "supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("sv"), (F.col("s_nationkey").cast("long") + 100000).alias("label"))
    return labels.map_labels(V.vox(spark, sf).withColumnRenamed("label", "sv"), pairs)


@query("pair_lists_last_wins", "SELECT l_orderkey AS chunk, l_suppkey % 5 AS sv, arg_max(l_partkey, l_linenumber) AS label FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) GROUP BY 1, 2")
def pair_lists_last_wins(spark, sf):
    li = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey")).alias("m"))
    c = li.groupBy(F.col("l_orderkey").alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "m"))).alias("s"))
    c = c.select("chunk", F.transform("s", lambda x: x["m"]["l_partkey"]).alias("labels"), F.transform("s", lambda x: x["m"]["l_suppkey"] % 5).alias("supervoxels"))
    return labels.last_pairs(c, ["chunk"])


@query("shard_extents", f"WITH {CHUNKS}, c AS (SELECT {_SHARD} AS shard, (max(chunk_x) + 1) * 8 AS max_x, (max(chunk_y) + 1) * 8 AS max_y, (max(chunk_z) + 1) * 4 AS max_z FROM keyed GROUP BY 1) SELECT *, max_x <= 128 AND max_y <= 128 AND max_z <= 8 AS inside FROM c")
def shard_extents(spark, sf):
    c = _toy_chunks(spark, sf).withColumn("shard", geometry.shard_number(TOY, geometry.morton(TOY, F.col("chunk_x"), F.col("chunk_y"), F.col("chunk_z"))))
    return labels.extents(c, TOY, ["shard"])


@query("slice_2d", f"WITH {V.VOX} SELECT x, y, label FROM vox WHERE z = 3 AND x >= 10 AND x < 90 AND y >= 20 AND y < 70")
def slice_2d(spark, sf):
    return volume.region_slice(V.vox(spark, sf), "z", 3, (10, 20, 0), (90, 70, 8))


@query("plane_boxes", f"WITH {_HELD}, o AS (SELECT n AS shard, {', '.join(f'{V.origin_sql(TOY, chr(110), k)} * {c} AS o{a}' for k, (a, c) in enumerate(zip('xyz', TOY.chunk)))} FROM e) SELECT shard, ox, oy, oz FROM o WHERE ox <= 37 AND ox + {TOY.shard_shape[0] * 8} > 37")
def plane_boxes(spark, sf):
    return volume.boxes_on_plane(geometry.shard_table(TOY, _held(spark, sf)), "x", 37).select("shard", "ox", "oy", "oz")


# --- sources and filters ----------------------------------------------------------------------------------


@query("empty_candidates", f"WITH {V.SHARDS} SELECT o_orderkey, scale, shard, bytes, chunks, bytes / chunks AS bytes_per_chunk FROM shards WHERE chunks <> 0 AND bytes / chunks < 5000")
def empty_candidates(spark, sf):
    return planning.empty_candidates(V.shards(spark, sf), 5000)


@query("exclude_list_anti", f"WITH {V.SHARDS} SELECT o_orderkey, scale, shard FROM shards WHERE (scale, shard) NOT IN (SELECT scale, shard FROM shards WHERE o_orderkey % 7 = 0)")
def exclude_list_anti(spark, sf):
    s = V.shards(spark, sf)
    return planning.without(s, s.where("o_orderkey % 7 = 0"), ["scale", "shard"]).select("o_orderkey", "scale", "shard")


@query("only_missing", f"WITH {V.OUTPUTS} SELECT file, o_orderkey, shard FROM numbered WHERE file NOT IN (SELECT file FROM outputs)")
def only_missing(spark, sf):
    return planning.only_missing(V.shards(spark, sf), V.outputs(spark, sf), LARGE).select("file", "o_orderkey", "shard")


@query("out_of_bounds", f"WITH {COORDS} SELECT l_orderkey, l_linenumber, cx, cy, cz FROM coords WHERE cx >= 1000 OR cy >= 1000 OR cz >= 2000")
def out_of_bounds(spark, sf):
    cut = geometry.Scale("cut", (64_000, 64_000, 128_000))
    return _coords(table(spark, sf, "lineitem")).where(verification.outside(cut, F.col("cx"), F.col("cy"), F.col("cz")))


def _index_rows(spark, sf) -> DataFrame:
    """An index's rows: chunks of one shard."""
    return table(spark, sf, "lineitem").select(F.lit("a").alias("shard"), (F.col("l_orderkey") % 100).alias("x"), F.col("l_linenumber").cast("long").alias("y"), F.lit(0).cast("long").alias("z")).distinct()


def _file_rows(spark, sf) -> DataFrame:
    """A file's rows: other chunks of the same shard."""
    a = table(spark, sf, "orders").where("o_orderkey % 3 <> 0").groupBy((F.col("o_orderkey") % 100).cast("int").alias("chunk_x"), (F.col("o_orderkey") % 9).cast("int").alias("chunk_y")).agg(F.max("o_custkey").alias("payload"))
    return a.select(F.lit("a").alias("shard"), "chunk_x", "chunk_y", F.lit(0).alias("chunk_z"), "payload")


@query("csv_arrow_join", "WITH i AS (SELECT DISTINCT l_orderkey % 100 AS x, l_linenumber AS y FROM lineitem), a AS (SELECT o_orderkey % 100 AS x, (o_orderkey % 9)::INT AS y, max(o_custkey) AS payload FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2) SELECT x, y, payload FROM i JOIN a USING (x, y)")
def csv_arrow_join(spark, sf):
    i, a = _index_rows(spark, sf), _file_rows(spark, sf)
    return shards.indexed_chunks(i, a).select("x", F.col("y").cast("int").alias("y"), "payload")


@query("csv_arrow_missing", "WITH i AS (SELECT DISTINCT l_orderkey % 100 AS x, l_linenumber AS y FROM lineitem), a AS (SELECT DISTINCT o_orderkey % 100 AS x, (o_orderkey % 9)::INT AS y FROM orders WHERE o_orderkey % 3 <> 0) SELECT x, y FROM i ANTI JOIN a USING (x, y)")
def csv_arrow_missing(spark, sf):
    return shards.missing_chunks(_index_rows(spark, sf), _file_rows(spark, sf)).select("x", F.col("y").cast("int").alias("y"))


@query("positional_join", "WITH b AS (SELECT (s_suppkey % 10)::VARCHAR AS shard, s_suppkey // 10 AS rec, s_suppkey * 100 AS o FROM supplier) SELECT o_orderkey AS x, b.o AS \"offset\", b.rec AS batch_idx FROM orders JOIN b ON (o_orderkey % 10)::VARCHAR = b.shard AND o_orderkey % 15 = b.rec")
def positional_join(spark, sf):
    k = F.col("s_suppkey")
    offsets = table(spark, sf, "supplier").select((k % 10).cast("string").alias("shard"), geometry.div(k, 10).alias("batch_idx"), (k * 100).alias("offset"), F.lit(50).cast("long").alias("size"), F.lit(688).cast("long").alias("schema_size"))
    o = F.col("o_orderkey")
    index = table(spark, sf, "orders").select((o % 10).cast("string").alias("shard"), o.alias("x"), F.lit(0).alias("y"), F.lit(0).alias("z"), (o % 15).alias("batch_idx"))
    return shards.with_offsets(index, offsets).select("x", "offset", "batch_idx")


@query("chunk_estimate", "SELECT o_orderkey, greatest(0, (o_custkey * 97) // 15 - 1) AS chunks FROM orders")
def chunk_estimate(spark, sf):
    from lamellar.sources.shards import estimated_chunks

    return table(spark, sf, "orders").select("o_orderkey", estimated_chunks(F.col("o_custkey") * 97).cast("long").alias("chunks"))


# --- models and planning ----------------------------------------------------------------------------------


def _case(scale: str, values: dict, default: float) -> str:
    return f"(CASE {scale} " + " ".join(f"WHEN {k} THEN {float(v)}::DOUBLE" for k, v in values.items()) + f" ELSE {float(default)}::DOUBLE END)"


_BPC = _case("scale", models.BYTES_PER_CHUNK, models.BYTES_PER_CHUNK_DEFAULT)
_EXPORT = f"(bytes / {G} + 2 * (chunks * {_BPC} / {G}) + 2.0::DOUBLE)"
_TIER = lambda g: f"(CASE WHEN {g} <= 4 THEN 4 WHEN {g} <= 8 THEN 8 WHEN {g} <= 16 THEN 16 WHEN {g} <= 24 THEN 24 ELSE 32 END)"


@query("memory_model", f"WITH {V.SHARDS} SELECT o_orderkey, round({_EXPORT}, 9) AS memory_gib, {_TIER(_EXPORT)} AS tier_gib FROM shards")
def memory_model(spark, sf):
    return planning.with_tier(V.shards(spark, sf)).select("o_orderkey", F.round("memory_gib", 9).alias("memory_gib"), "tier_gib")


_BPL = _case("scale", models.BYTES_PER_LABEL, models.BYTES_PER_LABEL_DEFAULT)
_SPIKE = _case("scale", models.COMMIT_SPIKE_GIB, models.COMMIT_SPIKE_DEFAULT_GIB)
_DOWN = f"""d0 AS (SELECT o_orderkey, scale, chunks, CASE WHEN o_orderkey % 2 = 0 THEN bytes // 3 END AS labels FROM shards),
d AS (SELECT *, CASE WHEN labels IS NOT NULL THEN labels * {_BPL} / {G} ELSE chunks * {_BPC} / {G} END AS output_gib,
  greatest(1.0, floor(pow(chunks::DOUBLE, 2 / 3.0::DOUBLE))) * 2 * 1048576.0 / {G} AS raw_batch_gib,
  CASE WHEN labels IS NOT NULL AND scale >= 4 THEN greatest(0.5, labels * 80 / {G}) ELSE 0.5 END AS label_readback_gib, {_SPIKE} AS commit_spike_gib FROM d0)"""


@query("downres_memory_model", f"WITH {V.SHARDS}, {_DOWN}, t AS (SELECT *, (raw_batch_gib + 2 * output_gib + 1.0 + label_readback_gib + commit_spike_gib) * 1.2 AS total FROM d) SELECT o_orderkey, CASE WHEN labels IS NULL THEN 'chunk_count' ELSE 'label_aware' END AS estimate_model, round(total, 9) AS total_gib, {_TIER('total')} AS tier_gib FROM t")
def downres_memory_model(spark, sf):
    s = V.shards(spark, sf).withColumn("labels", F.when(F.col("o_orderkey") % 2 == 0, F.floor(F.col("bytes") / 3)))
    parts = models.downres(F.col("scale"), F.col("chunks"), F.col("labels"))
    return s.select("o_orderkey", parts["estimate_model"].alias("estimate_model"), F.round(parts["total_gib"], 9).alias("total_gib"), models.pick_tier(parts["total_gib"]).alias("tier_gib"))


@query("tier_pick", "SELECT p_partkey, CASE WHEN g <= 8 THEN 8 WHEN g <= 16 THEN 16 WHEN g <= 24 THEN 24 ELSE 32 END AS tier, CASE WHEN g <= 8 THEN 2 WHEN g <= 16 THEN 4 WHEN g <= 24 THEN 6 ELSE 8 END AS cpu, least(1000, floor(40000.0 / CASE WHEN g <= 8 THEN 8 WHEN g <= 16 THEN 16 WHEN g <= 24 THEN 24 ELSE 32 END))::BIGINT AS parallel FROM (SELECT p_partkey, p_size * 0.75 AS g FROM part)")
def tier_pick(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", models.pick_tier(F.col("p_size") * 0.75, 8).alias("tier"))
    return p.select("p_partkey", "tier", models.tier_cpu(F.col("tier")).alias("cpu"), models.parallelism(F.lit(1000), F.col("tier")).cast("long").alias("parallel"))


_OLD = f"((bytes / {G} + 1.3 * (chunks * {_case('scale', models.KB_PER_CHUNK_OLD, models.KB_PER_CHUNK_OLD_DEFAULT)} / 1048576.0) + 1.5) * 1.3)"


@query("tier_histogram_pivot", f"WITH {V.SHARDS}, t AS (SELECT {_TIER(_EXPORT)} AS tier, 'current' AS model FROM shards UNION ALL SELECT {_TIER(_OLD)}, 'old' FROM shards UNION ALL SELECT {_TIER(f'((bytes / {G} + chunks * 100000.0 / {G} + 1.5) * 1.15)')}, 'scaled' FROM shards) SELECT tier, count(*) FILTER (model = 'current') AS current, count(*) FILTER (model = 'old') AS old, count(*) FILTER (model = 'scaled') AS scaled FROM t GROUP BY 1")
def tier_histogram_pivot(spark, sf):
    b, c, s = F.col("bytes"), F.col("chunks"), F.col("scale")
    tiers = {"current": models.export_gib(b, c, s), "old": models.old_gib(b, c, s), "scaled": models.scaled_gib(b, c * 100000.0)}
    return calibration.tier_histogram(V.shards(spark, sf), {k: models.pick_tier(v) for k, v in tiers.items()})


@query("tier_summary", f"WITH {V.SHARDS}, t AS (SELECT *, {_EXPORT} AS memory_gib FROM shards), u AS (SELECT *, {_TIER('memory_gib')} AS tier_gib FROM t) SELECT tier_gib, count(*) AS shards, sum(bytes)::BIGINT AS bytes, round(max(memory_gib), 9) AS max_gib FROM u GROUP BY ROLLUP (tier_gib)")
def tier_summary(spark, sf):
    return planning.tier_summary(planning.with_tier(V.shards(spark, sf))).withColumn("max_gib", F.round("max_gib", 9))


@query("round_robin", f"WITH {V.SHARDS} SELECT o_orderkey, ((row_number() OVER (PARTITION BY scale ORDER BY shard, o_orderkey) - 1) % 17)::INT AS task_id FROM shards")
def round_robin(spark, sf):
    return planning.round_robin(V.shards(spark, sf), 17, ["shard", "o_orderkey"], [F.col("scale")]).select("o_orderkey", "task_id")


@query("fixed_buckets", f"WITH {V.SHARDS} SELECT o_orderkey, ((row_number() OVER (PARTITION BY scale ORDER BY o_orderkey) - 1) // 100)::INT AS bucket FROM shards")
def fixed_buckets(spark, sf):
    return planning.buckets(V.shards(spark, sf), 100, ["o_orderkey"], [F.col("scale")]).select("o_orderkey", "bucket")


@query("snake_tasks", f"WITH {V.SHARDS}, r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY scale ORDER BY bytes DESC, o_orderkey) - 1 AS k FROM shards) SELECT o_orderkey, (CASE WHEN (k // 16) % 2 = 0 THEN k % 16 ELSE 15 - k % 16 END)::INT AS task_id FROM r")
def snake_tasks(spark, sf):
    return planning.snake(V.shards(spark, sf), "bytes", 16, "o_orderkey", ("scale",)).select("o_orderkey", "task_id")


_LPT = """, o AS (SELECT *, row_number() OVER (PARTITION BY tier_gib ORDER BY w DESC, k) AS i, least({tasks}, count(*) OVER (PARTITION BY tier_gib)) AS n FROM r),
a AS (SELECT tier_gib, 0::BIGINT AS i, list_transform(range(any_value(n)), lambda j: 0::HUGEINT) AS loads, 0 AS task FROM o GROUP BY 1
  UNION ALL SELECT a.tier_gib, o.i, list_concat(a.loads[:p.at - 1], [a.loads[p.at] + o.w], a.loads[p.at + 1:]), (p.at - 1)::INT
  FROM a JOIN o ON o.tier_gib = a.tier_gib AND o.i = a.i + 1, LATERAL (SELECT list_position(a.loads, list_min(a.loads)) AS at) p)"""


@query("lpt_tasks", f"WITH RECURSIVE {V.SHARDS}, t AS (SELECT *, {_EXPORT} AS memory_gib FROM shards), r AS (SELECT o_orderkey AS k, bytes AS w, {_TIER('memory_gib')} AS tier_gib FROM t){_LPT.format(tasks=50)} SELECT o.k AS o_orderkey, o.tier_gib, a.task AS task_id, o.w AS bytes FROM o JOIN a ON o.tier_gib = a.tier_gib AND o.i = a.i")
def lpt_tasks(spark, sf):
    return planning.balanced(planning.with_tier(V.shards(spark, sf)), "bytes", 50, tie="o_orderkey").select("o_orderkey", "tier_gib", "task_id", "bytes")


_PARENT = ", ".join(f"{V.origin_sql(LARGE, 'n', k)} AS p{a}" for k, a in enumerate("xyz"))
_CHILD = ", ".join(f"{V.origin_sql(LARGE_HALF, 'n', k)} AS c{a}" for k, a in enumerate("xyz"))
_ROOM = " * ".join(f"greatest(0, least({s}, {g} - c{a}))" for a, s, g in zip("xyz", LARGE_HALF.shard_shape, LARGE_HALF.grid, strict=True))
_DOWN1 = f"((greatest(1.0, floor(pow(chunks::DOUBLE, 2 / 3.0::DOUBLE))) * 2 * 1048576.0 / {G} + 2 * chunks * {float(models.BYTES_PER_CHUNK[1])}::DOUBLE / {G} + 2.0) * 1.2)"


@query("downres_plan", f"WITH RECURSIVE {V.NUMBERED}, p AS (SELECT DISTINCT number AS n FROM numbered), po AS (SELECT {_PARENT} FROM p), c AS (SELECT DISTINCT {V.shard_sql(LARGE_HALF, 'px // 2', 'py // 2', 'pz // 2')} AS n FROM po WHERE px < {LARGE.grid[0]} AND py < {LARGE.grid[1]} AND pz < {LARGE.grid[2]}), co AS (SELECT n, {_CHILD} FROM c), k AS (SELECT n, {_ROOM} AS chunks FROM co), r AS (SELECT n AS k, chunks AS w, {_TIER(_DOWN1)} AS tier_gib FROM k WHERE chunks > 0){_LPT.format(tasks=100)} SELECT o.k AS shard, {V.file_sql('o.k', LARGE_HALF.shard)} AS file, o.w AS chunks, o.tier_gib, a.task AS task_id FROM o JOIN a ON o.tier_gib = a.tier_gib AND o.i = a.i")
def downres_plan(spark, sf):
    p = V.numbered(spark, sf).select(F.col("number").alias("shard")).distinct()
    return planning.downres_plan(LARGE, LARGE_HALF, 1, p, max_tasks=100).select("shard", "file", "chunks", "tier_gib", "task_id")


@query("rough_shards", "SELECT p_partkey, side, (side // 64) ** 3 AS max_chunks, round((side // 64) ** 3 * CASE WHEN s = 0 THEN 5.0 ELSE least(50.0, 5.0 * pow(2.0, s)) END / 1024, 6) AS max_mb FROM (SELECT p_partkey, p_partkey % 9 AS s, 1 << ((18 + p_size % 10 + p_partkey % 7) // 3)::INT AS side FROM part)".replace("(side // 64) ** 3", "(side // 64) * (side // 64) * (side // 64)"))
def rough_shards(spark, sf):
    k, n = F.col("p_partkey"), F.col("p_size")
    out = geometry.rough_shard(k % 9, n % 10, k % 7)
    return table(spark, sf, "part").select("p_partkey", out["side"].alias("side"), out["max_chunks"].alias("max_chunks"), F.round(out["max_mb"], 6).alias("max_mb"))


# --- verification -----------------------------------------------------------------------------------------

_CMP = f"WITH {V.OUTPUTS}, w AS (SELECT file, list_sort(list(shard)) AS shards FROM numbered GROUP BY 1), c AS (SELECT coalesce(w.file, o.file) AS file, CASE WHEN w.file IS NULL THEN 'orphaned' WHEN o.file IS NULL THEN 'missing' ELSE 'present' END AS state, coalesce(len(w.shards), 0)::INT AS n FROM w FULL JOIN (SELECT DISTINCT file FROM outputs) o ON w.file = o.file)"


@query("verify_full_outer", f"{_CMP} SELECT file, state, n FROM c")
def verify_full_outer(spark, sf):
    c = verification.compare_outputs(V.numbered(spark, sf), V.outputs(spark, sf))
    return c.select("file", "state", F.coalesce(F.size("shards"), F.lit(0)).alias("n")).withColumn("n", F.greatest("n", F.lit(0)))


@query("verify_report", f"{_CMP} SELECT 0 AS scale, 's0' AS scale_key, sum(n)::BIGINT AS source_shards, count(*) FILTER (state <> 'orphaned') AS expected_shards, count(*) FILTER (state <> 'missing') AS actual_shards, count(*) FILTER (state = 'missing') AS missing_count, count(*) FILTER (state = 'orphaned') AS orphaned_count FROM c")
def verify_report(spark, sf):
    c = verification.compare_outputs(V.numbered(spark, sf), V.outputs(spark, sf))
    return verification.report(c, 0, "s0")


@query("missing_sources", f"WITH {V.OUTPUTS} SELECT 0 AS scale, file, shard FROM numbered WHERE file NOT IN (SELECT file FROM outputs)")
def missing_sources(spark, sf):
    c = verification.compare_outputs(V.numbered(spark, sf), V.outputs(spark, sf))
    return verification.missing_sources(c, 0)


@query("orphaned_outputs", f"WITH {V.OUTPUTS} SELECT DISTINCT 0 AS scale, file FROM outputs WHERE file NOT IN (SELECT file FROM numbered)")
def orphaned_outputs(spark, sf):
    return verification.orphans(verification.compare_outputs(V.numbered(spark, sf), V.outputs(spark, sf)), 0)


@query("missing_metadata", f"WITH {V.SHARDS}, m AS (SELECT DISTINCT scale, shard FROM shards WHERE o_orderkey % 5 = 0), s AS (SELECT DISTINCT ON (scale, shard) scale, shard, bytes, chunks FROM shards WHERE o_orderkey % 3 <> 0 ORDER BY scale, shard, o_orderkey) SELECT m.scale, m.shard, s.bytes, s.chunks, s.shard IS NOT NULL AS known FROM m LEFT JOIN s ON m.scale = s.scale AND m.shard = s.shard")
def missing_metadata(spark, sf):
    s = V.shards(spark, sf)
    own = telemetry.latest(s.where("o_orderkey % 3 <> 0").withColumn("first", -F.col("o_orderkey")), ["scale", "shard"], "first", "first")
    return verification.with_metadata(s.where("o_orderkey % 5 = 0"), own)


@query("sampled_shards", f"WITH {V.SHARDS} SELECT DISTINCT shard FROM shards ORDER BY md5('3|' || shard), shard LIMIT 100")
def sampled_shards(spark, sf):
    return verification.sample_shards(V.shards(spark, sf).select("shard").distinct(), 100, 3)


@query("failed_anti", f"WITH {V.SHARDS} SELECT o_orderkey, scale, shard FROM shards s WHERE NOT EXISTS (SELECT 1 FROM shards c WHERE c.scale = s.scale AND c.shard = s.shard AND (c.o_orderkey % 5 = 1 OR c.o_orderkey % 11 = 0))")
def failed_anti(spark, sf):
    s = V.shards(spark, sf)
    return telemetry.failed_shards(s, s.where("o_orderkey % 5 = 1"), s.where("o_orderkey % 11 = 0")).select("o_orderkey", "scale", "shard")


_TOYBOX = ", ".join(f"{V.origin_sql(TOY, 'n', k)} * {c} AS o{a}" for k, (a, c) in enumerate(zip("xyz", TOY.chunk, strict=True)))
_EXT = dict(zip("xyz", (s * c for s, c in zip(TOY.shard_shape, TOY.chunk, strict=True)), strict=True))
_FACE = " UNION ALL ".join(
    f"SELECT shard, '{a}' AS axis, {d} AS direction, {' * '.join(str(_EXT[b]) for b in 'xyz' if b != a)} AS area, {', '.join((f'o{a} - 1' if d < 0 else f'o{a} + {_EXT[a]}') + f' AS p{a}' if b == a else f'o{b} AS p{b}' for b in 'xyz')} FROM r"
    for a in "xyz" for d in (-1, 1)
)


@query("exposed_faces", f"WITH e AS (SELECT DISTINCT l_partkey % 64 AS n FROM lineitem WHERE l_partkey % 64 % 3 <> 0), r AS (SELECT n AS shard, {_TOYBOX} FROM e), f AS ({_FACE}) SELECT shard, axis, direction, area::BIGINT AS area FROM f WHERE px >= 0 AND px < 128 AND py >= 0 AND py < 128 AND pz >= 0 AND pz < 8 AND {V.shard_sql(TOY, 'px // 8', 'py // 8', 'pz // 4')} NOT IN (SELECT n FROM e)")
def exposed_faces(spark, sf):
    e = table(spark, sf, "lineitem").where("l_partkey % 64 % 3 <> 0").select((F.col("l_partkey") % 64).alias("shard")).distinct()
    return verification.exposed_faces(TOY, geometry.shard_table(TOY, e), e).select("shard", "axis", "direction", "area")


_DRAW = lambda k: f"(('0x' || substr(md5('7|' || i || '|{k}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"
_SOME = f"e AS (SELECT DISTINCT l_partkey % 64 AS n FROM lineitem WHERE l_partkey % 64 % 3 <> 0), g AS (SELECT row_number() OVER () - 1 AS range FROM orders), r AS (SELECT n AS shard, {_TOYBOX} FROM e)"
_PICKS = f"p AS (SELECT range AS i, floor({_DRAW(0)} * (SELECT max(high) FROM c)::DOUBLE)::BIGINT AS pick FROM g), j AS (SELECT * FROM p JOIN c ON pick >= high - w AND pick < high)".replace("'|' || i", "'|' || range").replace("'7|' || i", "'7|' || range")


def _some(spark, sf):
    return table(spark, sf, "lineitem").where("l_partkey % 64 % 3 <> 0").select((F.col("l_partkey") % 64).alias("shard")).distinct()


@query("sample_points", f"WITH {_SOME}, c AS (SELECT *, {math.prod(_EXT.values())} AS w, sum({math.prod(_EXT.values())}) OVER (ORDER BY shard)::BIGINT AS high FROM r), {_PICKS} SELECT i AS point_id, {', '.join(f'(o{a} + floor({_DRAW(k + 1)} * {_EXT[a]}))::BIGINT AS {a}' for k, a in enumerate('xyz'))} FROM j")
def sample_points(spark, sf):
    """As many points as orders, in the shards that line items name."""
    return verification.sample_inside(geometry.shard_table(TOY, _some(spark, sf)), table(spark, sf, "orders").count(), 7)


_INNER = lambda k, a: f"o{a} + floor({_DRAW(k + 1)} * {_EXT[a]})"


@query("sample_outside_points", f"WITH {_SOME}, f AS ({_FACE}), x AS (SELECT f.*, {', '.join(f'r.o{a}' for a in 'xyz')} FROM f JOIN r USING (shard) WHERE px >= 0 AND px < 128 AND py >= 0 AND py < 128 AND pz >= 0 AND pz < 8 AND {V.shard_sql(TOY, 'px // 8', 'py // 8', 'pz // 4')} NOT IN (SELECT n FROM e)), c AS (SELECT *, area AS w, sum(area) OVER (ORDER BY shard, axis, direction)::BIGINT AS high FROM x), {_PICKS} SELECT i AS point_id, " + ", ".join(f"(CASE WHEN axis = '{a}' THEN p{a} ELSE {_INNER(k, a)} END)::BIGINT AS {a}" for k, a in enumerate("xyz")) + " FROM j")
def sample_outside_points(spark, sf):
    some = _some(spark, sf)
    return verification.sample_outside(verification.exposed_faces(TOY, geometry.shard_table(TOY, some), some), table(spark, sf, "orders").count(), 7)


@query("point_compare", f"WITH {V.VOX}, p AS (SELECT o_orderkey AS point_id, o_custkey % 128 AS x, o_orderkey % 128 AS y, o_orderkey % 8 AS z FROM orders), b AS (SELECT p.*, coalesce(CASE WHEN label % 13 = 0 THEN label + 1 ELSE label END, 0) AS export_value, coalesce(label, 0) AS truth_value FROM p LEFT JOIN vox USING (x, y, z)) SELECT * FROM b WHERE export_value <> truth_value")
def point_compare(spark, sf):
    v = V.vox(spark, sf)
    p = table(spark, sf, "orders").select(F.col("o_orderkey").alias("point_id"), (F.col("o_custkey") % 128).alias("x"), (F.col("o_orderkey") % 128).alias("y"), (F.col("o_orderkey") % 8).alias("z"))
    return verification.mismatches(p, v.withColumn("label", F.when(F.col("label") % 13 == 0, F.col("label") + 1).otherwise(F.col("label"))), v)


@query("outside_nonzero", f"WITH {V.VOX}, p AS (SELECT o_orderkey AS point_id, o_custkey % 128 AS x, o_orderkey % 128 AS y, o_orderkey % 8 AS z FROM orders) SELECT x, y, z, point_id, label FROM p JOIN vox USING (x, y, z) WHERE label <> 0")
def outside_nonzero(spark, sf):
    p = table(spark, sf, "orders").select(F.col("o_orderkey").alias("point_id"), (F.col("o_custkey") % 128).alias("x"), (F.col("o_orderkey") % 128).alias("y"), (F.col("o_orderkey") % 8).alias("z"))
    return verification.values_at(p, V.vox(spark, sf)).where("label <> 0")


@query(
    "consistency_check",
    f"WITH {V.SHARDS}, c AS (SELECT shard, split_part(shard, '_', 1)::BIGINT // 64 + o_orderkey % 40 AS cx, split_part(shard, '_', 2)::BIGINT // 64 AS cy, split_part(shard, '_', 3)::BIGINT // 64 + (o_orderkey % 3) * 700 AS cz FROM shards), "
    f"k AS (SELECT *, cx >= 1471 OR cy >= 1224 OR cz >= 2103 AS o, {V.shard_sql(LARGE, 'cx', 'cy', 'cz')} AS number FROM c), "
    f"g AS (SELECT shard, count(DISTINCT CASE WHEN NOT o THEN number END)::INT AS n, count(*) FILTER (o) AS outside, bool_or(NOT o AND number = {V.name_sql(LARGE, 'shard')}) AS own FROM k GROUP BY 1) SELECT shard, n, outside, n <= 1 AND (n = 0 OR own) AS consistent FROM g",
)
def consistency_check(spark, sf):
    x, y, z = geometry.name_origin(F.col("shard"))
    c = V.shards(spark, sf).select("shard", (F.floor(x / 64) + F.col("o_orderkey") % 40).alias("chunk_x"), F.floor(y / 64).alias("chunk_y"), (F.floor(z / 64) + F.col("o_orderkey") % 3 * 700).alias("chunk_z"))
    return verification.consistency(c, LARGE).select("shard", F.size("numbers").alias("n"), "outside", "consistent")


# --- telemetry --------------------------------------------------------------------------------------------


@query("latest_event", f"WITH {V.LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY shard_number, scale ORDER BY ts DESC, event_id DESC) AS k FROM log) SELECT shard_number, scale, event_id FROM r WHERE k = 1")
def latest_event(spark, sf):
    return telemetry.latest(V.log(spark, sf), ["shard_number", "scale"], "ts", "event_id").select("shard_number", "scale", "event_id")


@query("latest_execution", f"WITH {V.LOG}, l AS (SELECT *, event_id % 5 AS execution FROM log), m AS (SELECT event_type, arg_max(execution, struct_pack(ts := ts, e := execution)) AS last FROM l GROUP BY 1) SELECT event_type, event_id, execution FROM l JOIN m USING (event_type) WHERE execution = last")
def latest_execution(spark, sf):
    return telemetry.latest_execution(V.log(spark, sf).withColumn("execution", F.col("event_id") % 5), "event_type", "execution", "ts").select("event_type", "event_id", "execution")


@query("in_flight", f"WITH {V.LOG}, p AS (SELECT * FROM log WHERE event_id % 2 = 0 AND shard_number NOT IN (SELECT shard_number FROM log WHERE event_id % 97 = 1)), r AS (SELECT *, row_number() OVER (PARTITION BY shard_number ORDER BY ts DESC, event_id DESC) AS k FROM p) SELECT shard_number, event_id, num_chunks FROM r WHERE k = 1")
def in_flight(spark, sf):
    e = V.log(spark, sf)
    return telemetry.in_flight(e.where("event_id % 2 = 0"), e.where("event_id % 97 = 1"), ["shard_number"], "ts", "event_id").select("shard_number", "event_id", "num_chunks")


@query("incomplete", f"WITH {V.LOG} SELECT DISTINCT shard_number, scale FROM log a WHERE NOT EXISTS (SELECT 1 FROM log b WHERE b.shard_number = a.shard_number AND b.scale = a.scale AND (b.event_id % 7 = 0 OR b.event_id % 11 = 0))")
def incomplete(spark, sf):
    e = V.log(spark, sf)
    return telemetry.incomplete(e, e.where("event_id % 7 = 0"), e.where("event_id % 11 = 0"), ["shard_number", "scale"])


_CLASS = "CASE WHEN contains(lower(m), 'zstd') THEN 'zstd_decompression' WHEN contains(m, 'CURL error') THEN 'curl_gcs' WHEN contains(lower(m), 'not found') THEN 'file_not_found' WHEN contains(lower(m), 'timeout') THEN 'timeout' WHEN contains(lower(m), 'memory') OR contains(lower(m), 'oom') THEN 'memory_pressure' ELSE 'other' END"
_MESSAGES = "CASE event_id % 9 WHEN 0 THEN 'ZSTD frame broken' WHEN 1 THEN 'CURL error 28 timeout' WHEN 2 THEN 'curl error, Not Found' WHEN 3 THEN 'Timeout: memory' WHEN 4 THEN 'OOM killed' ELSE 'bad ' || event_type END"


def _errors(spark, sf) -> DataFrame:
    k = F.col("event_id") % 9
    m = F.when(k == 0, "ZSTD frame broken").when(k == 1, "CURL error 28 timeout").when(k == 2, "curl error, Not Found").when(k == 3, "Timeout: memory").when(k == 4, "OOM killed").otherwise(F.concat(F.lit("bad "), "event_type"))
    return V.log(spark, sf).withColumn("error", m)


@query("error_classes", f"WITH {V.LOG}, e AS (SELECT *, {_MESSAGES} AS m FROM log) SELECT {_CLASS} AS category, scale, count(*) AS errors FROM e GROUP BY 1, 2")
def error_classes(spark, sf):
    return telemetry.error_counts(telemetry.classified(_errors(spark, sf)), ["category", "scale"])


@query("document_classes", f"SELECT {_CLASS} AS category, lang, count(*) AS errors FROM (SELECT text AS m, lang FROM documents) GROUP BY 1, 2")
def document_classes(spark, sf):
    return telemetry.error_counts(telemetry.classified(table(spark, sf, "documents"), "text"), ["category", "lang"])


@query("top10_errors", f"WITH {V.LOG} SELECT shard_number, count(*) AS errors FROM log GROUP BY 1 ORDER BY errors DESC, shard_number LIMIT 10")
def top10_errors(spark, sf):
    return telemetry.top_errors(V.log(spark, sf), "shard_number")


@query("top_bottom5", f"WITH {V.LOG}, p AS (SELECT shard_number, round(100.0 * sum(num_chunks) / 100000, 6) AS pct FROM log GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY pct DESC, shard_number) AS t, row_number() OVER (ORDER BY pct, shard_number DESC) AS b FROM p) SELECT shard_number, pct, CASE WHEN t <= 5 THEN 'top' ELSE 'bottom' END AS \"end\" FROM r WHERE t <= 5 OR b <= 5")
def top_bottom5(spark, sf):
    p = V.log(spark, sf).groupBy("shard_number").agg(F.round(100.0 * F.sum("num_chunks") / 100000, 6).alias("pct"))
    return telemetry.best_and_worst(p, "pct", "shard_number")


@query("memory_summary", f"WITH {V.LOG} SELECT scale, count(*) AS shards_profiled, round(avg(peak_memory_gib), 6) AS peak_memory_avg, max(peak_memory_gib) AS peak_memory_max, round(avg(elapsed_s), 6) AS avg_elapsed_s, max(elapsed_s) AS max_elapsed_s, round(avg(estimated_memory_gib), 6) AS estimated_memory_gib_avg, max(estimated_memory_gib) AS estimated_memory_gib_max, round(max(peak_memory_gib - estimated_memory_gib), 6) AS prediction_error_gib_max, round(max(peak_memory_gib / nullif(estimated_memory_gib, 0)), 6) AS prediction_ratio_max FROM log GROUP BY 1")
def memory_summary(spark, sf):
    e = telemetry.prediction(V.log(spark, sf)).withColumns({"memory_limit_gib": F.lit(32.0), "batches": F.lit(1)})
    s = telemetry.memory_summary(e, ["scale"])
    r = lambda c: F.round(c, 6).alias(c)
    return s.select("scale", "shards_profiled", r("peak_memory_avg"), "peak_memory_max", r("avg_elapsed_s"), "max_elapsed_s", r("estimated_memory_gib_avg"), "estimated_memory_gib_max", r("prediction_error_gib_max"), r("prediction_ratio_max"))


@query("json_extract", "SELECT event_id, (props::JSON->>'k')::BIGINT AS k FROM events")
def json_extract(spark, sf):
    line = F.concat(F.lit("worker 3: "), F.col("props"))
    return table(spark, sf, "events").select("event_id", text.embedded_json(line, "k long")["k"].alias("k"))


@query("normalized_events", f"WITH {V.LOG} SELECT event_id, shard_number::VARCHAR AS shard, num_chunks AS chunks_written, 0 AS chunks_failed, 1 AS batches FROM log")
def normalized_events(spark, sf):
    return telemetry.normalized(V.log(spark, sf)).select("event_id", "shard", "chunks_written", F.col("chunks_failed").cast("int").alias("chunks_failed"), F.col("batches").cast("int").alias("batches"))


@query("progress_totals", f"WITH {V.LOG} SELECT sum(num_chunks)::BIGINT AS written, (count(*) FILTER (event_id % 2 = 1))::BIGINT AS failed, sum(num_chunks * 2)::BIGINT AS total, round(100.0 * sum(num_chunks) / sum(num_chunks * 2), 6) AS percent FROM log")
def progress_totals(spark, sf):
    e = V.log(spark, sf).select(F.col("num_chunks").alias("chunks_written"), (F.col("event_id") % 2).alias("chunks_failed"), (F.col("num_chunks") * 2).alias("total"), "event_id")
    return telemetry.progress_totals(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")).withColumn("percent", F.round("percent", 6))


@query("memory_pressure", f"WITH {V.LOG}, p AS (SELECT peak_memory_gib / 100.0 AS s FROM log) SELECT CASE WHEN s > 0.9 THEN 'critical' WHEN s > 0.75 THEN 'high' ELSE 'ok' END AS pressure, count(*) AS n FROM p GROUP BY 1")
def memory_pressure(spark, sf):
    e = V.log(spark, sf).select(F.col("peak_memory_gib").alias("memory_gib"), F.lit(100.0).alias("memory_limit_gib"))
    return telemetry.pressure(e).groupBy("pressure").agg(F.count(F.lit(1)).alias("n"))


@query("stream_windows", "SELECT time_bucket(INTERVAL 6 HOURS, ts)::VARCHAR AS start, event_type AS event, count(*) AS events, max(value) AS peak_gib FROM events GROUP BY 1, 2")
def stream_windows(spark, sf):
    """The events table as a stream, in six-hour windows; the finished stream's table."""
    path = f"{sf}/events.parquet"
    stream = progress.table_stream(spark, path)
    stream = stream.select(F.col("event_type").alias("event"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("memory_gib"))
    at = scratch(spark, "stream")
    progress.to_table(progress.windowed(stream, "6 hours"), f"{at}/table", f"{at}/checkpoint").awaitTermination()
    out = progress.read_table(spark, f"{at}/table")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event", "events", "peak_gib")


@query("stream_progress", "WITH r AS (SELECT user_id, event_id % 3 AS scale, ts, event_id, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY (event_id % 101 = 0) DESC, ts DESC, event_id DESC) AS k FROM events) SELECT (scale)::INT AS scale, user_id::VARCHAR AS shard, event_id % 101 = 0 AS done, event_id AS chunks_written FROM r WHERE k = 1")
def stream_progress(spark, sf):
    """Latest state of every shard from a stream of events, completions first."""
    path = f"{sf}/events.parquet"
    e = progress.table_stream(spark, path)
    e = e.select(F.when(F.col("event_id") % 101 == 0, "shard_complete").otherwise("progress").alias("event"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 3).cast("int").alias("scale"), F.col("user_id").cast("string").alias("shard"), F.col("event_id").alias("chunks_written"), F.lit(0).cast("long").alias("chunks_failed"), F.lit(1).cast("long").alias("total"))
    at = scratch(spark, "stream")
    progress.to_table(progress.progress(e), f"{at}/table", f"{at}/checkpoint").awaitTermination()
    return progress.read_table(spark, f"{at}/table").select("scale", "shard", "done", "chunks_written")


@query(
    "stream_stalled",
    "WITH e AS (SELECT (event_id % 3)::INT AS scale, user_id::VARCHAR AS shard, ts, event_id, event_id % 13 = 0 AS done FROM events), "
    "g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 1 DAY THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY scale, shard ORDER BY ts)), "
    "s AS (SELECT *, sum(fresh) OVER (PARTITION BY scale, shard ORDER BY ts) AS k FROM g), "
    "a AS (SELECT scale, shard, max(ts) AS last, count(*) AS events, bool_or(done) AS done, max_by(event_id, (ts, event_id)) AS chunks_written FROM s GROUP BY scale, shard, k) "
    "SELECT scale, shard, epoch_us(last) AS since, events, chunks_written FROM a WHERE NOT done AND last + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE",
)
def stream_stalled(spark, sf):
    """Shards of the event stream that were silent for a day before they completed."""
    e = progress.table_stream(spark, f"{sf}/events.parquet")
    e = e.select(F.when(F.col("event_id") % 13 == 0, "shard_complete").otherwise("progress").alias("event"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 3).cast("int").alias("scale"), F.col("user_id").cast("string").alias("shard"), F.col("event_id").alias("chunks_written"), F.lit(1).cast("long").alias("total"))
    at = scratch(spark, "stream")
    progress.to_table(progress.stalled(e, "1 day"), f"{at}/table", f"{at}/checkpoint", "append").awaitTermination()
    return progress.read_table(spark, f"{at}/table").select("scale", "shard", F.unix_micros("since").alias("since"), "events", "chunks_written")


@query(
    "stream_unfinished",
    "WITH s AS (SELECT event_id // 2 AS run, ts FROM events WHERE event_id % 2 = 0), e AS (SELECT event_id // 2 AS run, ts FROM events WHERE event_id % 2 = 1 AND event_id % 7 <> 0), "
    "w AS (SELECT least((SELECT max(ts) FROM s), (SELECT max(ts) FROM e)) - INTERVAL 10 MINUTE AS mark) "
    "SELECT s.run, epoch_us(s.ts) AS started, epoch_us(e.ts) AS ended FROM s LEFT JOIN e ON s.run = e.run AND e.ts >= s.ts AND e.ts <= s.ts + INTERVAL 2 MINUTE, w WHERE e.run IS NOT NULL OR s.ts + INTERVAL 2 MINUTE <= mark",
)
def stream_unfinished(spark, sf):
    """Starts (even events) joined in flight with their ends (odd ones, some lost); those without one within two minutes stay alone."""
    e = progress.table_stream(spark, f"{sf}/events.parquet").select(F.expr("event_id div 2").alias("run"), F.col("ts").cast("timestamp").alias("ts"), "event_id")
    at = scratch(spark, "stream")
    out = progress.finished(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1 and event_id % 7 <> 0"), ["run"], "2 minutes")
    progress.to_table(out, f"{at}/table", f"{at}/checkpoint", "append").awaitTermination()
    return progress.read_table(spark, f"{at}/table").select("run", F.unix_micros("ts").alias("started"), F.unix_micros("end_ts").alias("ended"))


# --- calibration ------------------------------------------------------------------------------------------


@query("percentile_nearest", "WITH r AS (SELECT o_orderpriority AS k, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) SELECT k, max(CASE WHEN i = least(floor(0.5::DOUBLE * n)::BIGINT, n - 1) THEN v END) AS p50, max(CASE WHEN i = least(floor(0.95::DOUBLE * n)::BIGINT, n - 1) THEN v END) AS p95, max(CASE WHEN i = n - 1 THEN v END) AS p100 FROM r GROUP BY 1")
def percentile_nearest(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("k"), F.col("o_totalprice").alias("v"))
    return calibration.percentiles(o, "v", ["k"])


@query("ls_1var", f"WITH {V.SHARDS}, s AS (SELECT scale, count(*) AS n, sum(chunks::DOUBLE * chunks) AS xx, sum(chunks::DOUBLE * bytes) AS xy, sum(bytes::DOUBLE * bytes) AS yy, sum(bytes::DOUBLE) AS sy FROM shards GROUP BY 1) SELECT scale, n, round(xy / xx, 4) AS a, round(1 - (yy - 2 * (xy / xx) * xy + (xy / xx) * (xy / xx) * xx) / (yy - sy * sy / n), 6) AS r2 FROM s")
def ls_1var(spark, sf):
    return calibration.fit_one(V.shards(spark, sf), "bytes", "chunks", ["scale"]).select("scale", "n", F.round("a", 4).alias("a"), F.round("r2", 6).alias("r2"))


@query("ls_2var", f"WITH {V.SHARDS}, s AS (SELECT scale, count(*) AS n, sum(chunks::DOUBLE * chunks) AS a11, sum(chunks::DOUBLE * o_orderkey) AS a12, sum(o_orderkey::DOUBLE * o_orderkey) AS a22, sum(chunks::DOUBLE * bytes) AS b1, sum(o_orderkey::DOUBLE * bytes) AS b2 FROM shards GROUP BY 1) SELECT scale, n, round((b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12), 3) AS a, round((b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12), 3) AS b FROM s")
def ls_2var(spark, sf):
    return calibration.fit_two(V.shards(spark, sf), "bytes", "chunks", "o_orderkey", ["scale"]).select("scale", "n", F.round("a", 3).alias("a"), F.round("b", 3).alias("b"))


@query("three_way_correlation", f"WITH {V.OUTPUTS}, l AS (SELECT scale, shard, sum(chunks)::BIGINT AS total_sv FROM shards WHERE o_orderkey % 4 <> 0 GROUP BY 1, 2) SELECT s.scale, count(*) AS sources, count(*) FILTER (o.bytes IS NULL) AS no_output, count(*) FILTER (total_sv IS NULL) AS no_labels FROM numbered s LEFT JOIN outputs o ON s.number = o.number LEFT JOIN l ON s.scale = l.scale AND s.shard = l.shard GROUP BY 1")
def three_way_correlation(spark, sf):
    stats = V.shards(spark, sf).where("o_orderkey % 4 <> 0").groupBy("scale", "shard").agg(F.sum("chunks").alias("total_sv"))
    return calibration.match_counts(calibration.correlate(V.numbered(spark, sf), V.outputs(spark, sf), stats), "total_sv")


@query("collisions", f"WITH {V.NUMBERED} SELECT number, count(*) AS sources FROM numbered GROUP BY 1 HAVING count(*) > 1")
def collisions(spark, sf):
    return calibration.collisions(V.numbered(spark, sf))


@query("bytes_per_chunk", f"WITH {V.SHARDS} SELECT scale, max(bytes / chunks) AS max_bytes_per_chunk FROM shards GROUP BY 1")
def bytes_per_chunk(spark, sf):
    return calibration.bytes_per_chunk(V.shards(spark, sf).withColumnRenamed("bytes", "output_bytes"))


@query("overestimation_percentiles", f"WITH {V.SHARDS}, q AS (SELECT scale, {_EXPORT} / ((bytes / {G} + chunks * 100000.0 / {G} + 1.5) * 1.15) AS v FROM shards), r AS (SELECT scale, v, row_number() OVER (PARTITION BY scale ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY scale) AS n FROM q) SELECT scale, round(max(CASE WHEN i = least(floor(0.5::DOUBLE * n)::BIGINT, n - 1) THEN v END), 6) AS p50, round(max(CASE WHEN i = least(floor(0.95::DOUBLE * n)::BIGINT, n - 1) THEN v END), 6) AS p95, round(max(v), 6) AS p100 FROM r GROUP BY 1")
def overestimation_percentiles(spark, sf):
    b, c, s = F.col("bytes"), F.col("chunks"), F.col("scale")
    q = V.shards(spark, sf).select("scale", (models.export_gib(b, c, s) / models.scaled_gib(b, c * 100000.0)).alias("v"))
    out = calibration.percentiles(q, "v", ["scale"])
    return out.select("scale", *(F.round(f"p{p}", 6).alias(f"p{p}") for p in (50, 95, 100)))


# --- sets and scalars -------------------------------------------------------------------------------------


@query("set_difference", "SELECT DISTINCT l_partkey % 1000 AS k FROM lineitem EXCEPT SELECT o_custkey % 900 FROM orders")
def set_difference(spark, sf):
    return table(spark, sf, "lineitem").select((F.col("l_partkey") % 1000).alias("k")).subtract(table(spark, sf, "orders").select((F.col("o_custkey") % 900).alias("k")))


@query("set_union", "SELECT l_partkey % 1000 AS k FROM lineitem UNION SELECT o_custkey % 1500 FROM orders")
def set_union(spark, sf):
    return table(spark, sf, "lineitem").select((F.col("l_partkey") % 1000).alias("k")).union(table(spark, sf, "orders").select((F.col("o_custkey") % 1500).alias("k"))).distinct()


@query("bag_union", f"WITH {V.LOG} SELECT scale, count(*) AS n FROM (SELECT scale FROM log WHERE event_id % 2 = 0 UNION ALL SELECT scale FROM log WHERE event_id % 3 = 0) GROUP BY 1")
def bag_union(spark, sf):
    e = V.log(spark, sf)
    return telemetry.merge_partial([e.where("event_id % 2 = 0"), e.where("event_id % 3 = 0")]).groupBy("scale").agg(F.count(F.lit(1)).alias("n"))


@query("dedupe_first", f"WITH {V.SHARDS}, r AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY o_orderkey) AS k FROM shards) SELECT shard, o_orderkey FROM r WHERE k = 1")
def dedupe_first(spark, sf):
    first = V.shards(spark, sf).withColumn("first", -F.col("o_orderkey"))
    return telemetry.latest(first, ["shard"], "first", "first").select("shard", "o_orderkey")


@query("cumulative_orders", "SELECT o_orderkey, o_custkey % 7 AS part, sum(o_custkey) OVER (PARTITION BY o_custkey % 7 ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)::BIGINT AS high, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place FROM orders")
def cumulative_orders(spark, sf):
    """Running sums within groups, and places over a whole table, from the sums of sorted ranges."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    own = ranks.running(o, ["o_orderdate", "o_orderkey"], [F.col("o_custkey") % 7], "o_custkey", low="before")
    return ranks.running(own, ["o_orderdate", "o_orderkey"], low="place", high="after").select("o_orderkey", (F.col("o_custkey") % 7).alias("part"), "high", "place")


@query("cumulative_weights", "WITH n AS (SELECT n_nationkey, count(*) AS w FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1) SELECT n_nationkey, w, sum(w) OVER (ORDER BY n_nationkey)::BIGINT AS cumulative FROM n")
def cumulative_weights(spark, sf):
    c = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("w"))
    c = c.join(table(spark, sf, "nation").select("n_nationkey"), "n_nationkey")
    return verification.cumulative(c, "w", ["n_nationkey"]).select("n_nationkey", "w", F.col("high").alias("cumulative"))


@query("bits_and_bounds", "SELECT p_partkey, CASE WHEN p_partkey < 2 THEN 0 ELSE length(bin(p_partkey - 1)) END::INT AS nbits, CASE WHEN p_partkey <= 1 THEN 0 WHEN p_partkey <= 2 THEN 1 WHEN p_partkey <= 4 THEN 2 WHEN p_partkey <= 16 THEN 4 WHEN p_partkey <= 256 THEN 8 WHEN p_partkey <= 65536 THEN 16 ELSE 32 END::INT AS encoding_bits, (4 + c * 8 + c * (256 + 1024) * 4)::BIGINT AS bound FROM (SELECT p_partkey, ceil(p_size / 8.0) * ceil(p_partkey / 8.0) * 8 AS c FROM part)")
def bits_and_bounds(spark, sf):
    n = F.col("p_partkey")
    return table(spark, sf, "part").select("p_partkey", bits.bits_for(n).alias("nbits"), bits.encoding_bits(n).alias("encoding_bits"), bits.encoded_bound(F.col("p_size"), n, F.lit(64)).alias("bound"))


@query("unsigned_labels", "SELECT o_orderkey, CASE WHEN v < 0 THEN v::HUGEINT + 18446744073709551616 ELSE v::HUGEINT END::DECIMAL(20, 0) AS label FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE -o_custkey END AS v FROM orders)")
def unsigned_labels(spark, sf):
    v = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).otherwise(-F.col("o_custkey"))
    return table(spark, sf, "orders").select("o_orderkey", bits.unsigned(v).alias("label"))


@query("text_scalars", "SELECT s_suppkey, regexp_replace(list_extract(string_split(p, '/'), -1), '\\.[^.]*$', '') AS stem, md5(p) AS digest, regexp_extract(p, 'tier-?(\\d+)gi', 1)::INT AS tier FROM (SELECT s_suppkey, 'gs://b/tier-' || (4 * (1 + s_suppkey % 8)) || 'gi/' || s_name || '.json' AS p FROM supplier)")
def text_scalars(spark, sf):
    p = F.concat(F.lit("gs://b/tier-"), (4 * (1 + F.col("s_suppkey") % 8)).cast("string"), F.lit("gi/"), F.col("s_name"), F.lit(".json"))
    return table(spark, sf, "supplier").select("s_suppkey", text.stem(p).alias("stem"), F.md5(p).alias("digest"), text.tier_of(p).alias("tier"))


# --- codecs, rows only ------------------------------------------------------------------------------------


def blocks(spark, sf) -> DataFrame:
    """Toy chunks as stored blocks of 8 x 8 x 8 voxels, encoded once per application and read from then on."""
    sc = spark.sparkContext
    kept = sc.__dict__.setdefault("_lamellar_blocks", {})
    if sf not in kept or kept[sf].materialized_at not in sc._lamellar_scratch:
        kept[sf] = materialize(_encoded(spark, sf), "blocks")
    return kept[sf]


def _encoded(spark, sf) -> DataFrame:
    import numpy as np
    import pandas as pd
    import zstandard

    from lamellar.session import ship

    ship(spark)
    v = V.vox(spark, sf).select(*(F.floor(F.col(a) / 8).cast("int").alias(f"chunk_{a}") for a in "xyz"), *(F.col(a) % 8 for a in "xyz"), "label").toDF("chunk_x", "chunk_y", "chunk_z", "x", "y", "z", "label")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        cube = np.zeros((8, 8, 8), np.uint64)
        cube[rows.z, rows.y, rows.x] = rows.label
        own = [int(i) for i in np.unique(cube)]
        plain = codecs.encode_block(cube)
        block = zstandard.ZstdCompressor().compress(plain)
        first = rows.iloc[0]
        return pd.DataFrame({"chunk_x": [first.chunk_x], "chunk_y": [first.chunk_y], "chunk_z": [first.chunk_z], "labels": [[i + 1000 if i else 0 for i in own]], "supervoxels": [own], "block": [block], "uncompressed_size": [len(plain)]})

    return v.groupBy("chunk_x", "chunk_y", "chunk_z").applyInPandas(build, "chunk_x int, chunk_y int, chunk_z int, labels array<long>, supervoxels array<long>, block binary, uncompressed_size long")


@query("block_decode", f"WITH {V.VOX} SELECT (x // 8)::INT AS chunk_x, (y // 8)::INT AS chunk_y, (z // 8)::INT AS chunk_z, label + 1000 AS label, count(*) AS voxels FROM vox GROUP BY ALL")
def block_decode(spark, sf):
    d = codecs.decoded_labels(blocks(spark, sf), shape=(8, 8, 8))
    return d.select("chunk_x", "chunk_y", "chunk_z", F.explode(F.arrays_zip("values", "counts")).alias("p")).select("chunk_x", "chunk_y", "chunk_z", F.col("p.values").alias("label"), F.col("p.counts").alias("voxels")).where("label <> 0")


@query("block_voxels", f"WITH {V.VOX} SELECT * FROM vox")
def block_voxels(spark, sf):
    d = codecs.decode(blocks(spark, sf), codecs.SUPERVOXELS, (8, 8, 8))
    return volume.explode_voxels(d, geometry.Scale("toy8", (128, 128, 8), (8, 8, 8)))


@query("chunk_downsample", ORACLES["mode_downsample"])
def chunk_downsample(spark, sf):
    """The same votes as mode_downsample, chunk by chunk."""
    whole, half = geometry.Scale("toy8", (128, 128, 8), (8, 8, 8)), geometry.Scale("half8", (64, 64, 4), (8, 8, 8))
    d = codecs.decode(blocks(spark, sf), codecs.SUPERVOXELS, (8, 8, 8))
    return volume.explode_voxels(chunked.downsample(d, whole, half), half)


#: Distinct labels of each block of 8 x 8 x 8 voxels, background included where it is not full.
PALETTES = f"{V.VOX}, b AS (SELECT (x // 8)::INT AS chunk_x, (y // 8)::INT AS chunk_y, (z // 8)::INT AS chunk_z, count(DISTINCT label) + CASE WHEN count(*) < 512 THEN 1 ELSE 0 END AS n FROM vox GROUP BY 1, 2, 3)"
BLOCK_BYTES_SQL = "(16 + 8 * n + CASE WHEN n = 1 THEN 0 ELSE 2 + 4 * n + 64 * length(bin(n - 1)) END)::BIGINT"


@query("block_info", f"WITH {PALETTES} SELECT chunk_x, chunk_y, chunk_z, CASE WHEN n = 1 THEN 'solid' ELSE 'compressed' END AS type, 1::BIGINT AS sub_blocks, n::BIGINT AS label_count, {BLOCK_BYTES_SQL} AS uncompressed_bytes FROM b")
def block_info(spark, sf):
    return codecs.info(blocks(spark, sf)).select("chunk_x", "chunk_y", "chunk_z", "type", "sub_blocks", "label_count", "uncompressed_bytes")


@query("segmentation_encode", f"WITH {PALETTES} SELECT chunk_x, chunk_y, chunk_z, (4 + 8 + 8 * n + 64 * CASE WHEN n = 1 THEN 0 WHEN n <= 2 THEN 1 WHEN n <= 4 THEN 2 WHEN n <= 16 THEN 4 WHEN n <= 256 THEN 8 ELSE 16 END)::INT AS n_bytes, NULL::VARCHAR AS error FROM b")
def segmentation_encode(spark, sf):
    e = codecs.to_segmentation(blocks(spark, sf), gzipped=False, shape=(8, 8, 8))
    return e.select("chunk_x", "chunk_y", "chunk_z", F.octet_length("encoded").alias("n_bytes"), "error")


# --- volumes that grow with the table ----------------------------------------------------------------------------

#: Chunks of 16 x 8 x 8 voxels along x, as many as the order keys reach; most voxels have a line item, of few labels.
LONG = geometry.Scale("long", (1 << 30, 8, 8), (16, 8, 8))
LONG_HALF = geometry.Scale("long_half", (1 << 29, 4, 4), (16, 8, 8))
LONG_VOX = "vox AS (SELECT l_orderkey // 32 AS x, l_partkey % 8 AS y, l_linenumber::BIGINT AS z, min(l_suppkey % 5) AS label FROM lineitem GROUP BY 1, 2, 3)"


def _long(spark, sf) -> DataFrame:
    """A stored chunk per 512 order keys."""
    li = table(spark, sf, "lineitem")
    v = li.groupBy(F.expr("l_orderkey div 32").alias("x"), (F.col("l_partkey") % 8).alias("y"), F.col("l_linenumber").cast("long").alias("z")).agg(F.min(F.col("l_suppkey") % 5).alias("label"))
    return chunked.from_voxels(v, LONG)


@query("encoded_voxels", f"WITH {LONG_VOX} SELECT * FROM vox WHERE label <> 0")
def encoded_voxels(spark, sf):
    """Chunks encoded from voxels and decoded again."""
    return volume.explode_voxels(chunked.decoded(_long(spark, sf), LONG), LONG)


@query(
    "palette_downsample",
    f"WITH {LONG_VOX}, v AS (SELECT x // 2 AS x, y // 2 AS y, z // 2 AS z, label, count(*) AS n FROM vox WHERE label <> 0 GROUP BY ALL), "
    "a AS (SELECT * FROM v UNION ALL SELECT x, y, z, 0, (8 - sum(n))::BIGINT FROM v GROUP BY 1, 2, 3 HAVING sum(n) < 8), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY n DESC, label) AS k FROM a) SELECT x, y, z, label FROM r WHERE k = 1 AND label <> 0",
)
def palette_downsample(spark, sf):
    """Votes by the tables and indices of encoded chunks, pieces joined encoded, voxels made for the result only."""
    pieces = chunked.halved(_long(spark, sf), LONG, LONG_HALF)
    return volume.explode_voxels(chunked.decoded(chunked.put_together(pieces, LONG_HALF), LONG_HALF), LONG_HALF)


@query(
    "label_set_pyramid",
    "WITH c AS (SELECT DISTINCT l_partkey // 64 AS x, l_orderkey // 1024 AS y, l_linenumber::BIGINT AS z, l_suppkey AS label FROM lineitem) "
    "SELECT level::INT AS level, x >> level AS x, y >> level AS y, z >> level AS z, count(DISTINCT label)::BIGINT AS unique_labels FROM c, (SELECT unnest([0, 1, 2, 3]) AS level) GROUP BY ALL",
)
def label_set_pyramid(spark, sf):
    """Distinct suppliers of every chunk at four scales, each from the bits of the one before."""
    rows = table(spark, sf, "lineitem").select(F.expr("l_partkey div 64").alias("chunk_x"), F.expr("l_orderkey div 1024").alias("chunk_y"), F.col("l_linenumber").cast("long").alias("chunk_z"), F.col("l_suppkey").alias("label"))
    scales = [geometry.Scale(str(k), ((1 << 27) >> k,) * 3) for k in range(4)]
    own = materialize(labelsets.sets(rows, labelsets.numbered(rows, scales[0])), "sets")
    out = None
    for k in range(4):
        if k:
            own = materialize(labelsets.raised(own, scales[k - 1], scales[k]), "sets")
        level = labelsets.counts(own).select(F.lit(k).alias("level"), *(F.col(f"chunk_{a}").alias(a) for a in "xyz"), "unique_labels")
        out = level if out is None else out.unionByName(level)
    return out


LONG_QUARTER = geometry.Scale("long_quarter", (1 << 28, 2, 2), (16, 8, 8))


def _vote_sql(name: str, of: str) -> str:
    """The relation ``name`` of the voxels of ``of``, halved along each axis by majority, background left out."""
    return (
        f"{name}_v AS (SELECT x // 2 AS x, y // 2 AS y, z // 2 AS z, label, count(*) AS n FROM {of} WHERE label <> 0 GROUP BY ALL), "
        f"{name}_a AS (SELECT * FROM {name}_v UNION ALL SELECT x, y, z, 0, (8 - sum(n))::BIGINT FROM {name}_v GROUP BY 1, 2, 3 HAVING sum(n) < 8), "
        f"{name}_r AS (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY n DESC, label) AS k FROM {name}_a), {name} AS (SELECT x, y, z, label FROM {name}_r WHERE k = 1 AND label <> 0)"
    )


#: Nearly every voxel has line items, of three labels about alike, so that votes differ at every scale.
FULL_VOX = "vox AS (SELECT l_orderkey // 128 AS x, l_partkey % 8 AS y, (l_partkey // 8 + l_linenumber) % 8 AS z, (1 + sum(l_suppkey) % 3)::BIGINT AS label FROM lineitem GROUP BY 1, 2, 3)"


@query("colocated_downsample", f"WITH {FULL_VOX}, {_vote_sql('half', 'vox')}, {_vote_sql('quarter', 'half')} SELECT * FROM quarter")
def colocated_downsample(spark, sf):
    """Two scales up from bucketed tables of encoded chunks, without an exchange between scales; voxels of the last one."""
    own = colocated.create(spark, scratch(spark, "colocated"), [LONG, LONG_HALF, LONG_QUARTER])
    v = table(spark, sf, "lineitem").groupBy(F.expr("l_orderkey div 128").alias("x"), (F.col("l_partkey") % 8).alias("y"), F.expr("(l_partkey div 8 + l_linenumber) % 8").alias("z")).agg((1 + F.sum("l_suppkey") % 3).alias("label"))
    own.write(chunked.from_voxels(v, LONG), 0)
    for level in (1, 2):
        own.raise_chunks(level)
    return volume.explode_voxels(chunked.decoded(own.read(2), LONG_QUARTER), LONG_QUARTER)


#: Line items, each a word of 48 bytes at most, that a bucket of :func:`colocated_pairs` merges and joins in one task.
BUCKET_ROWS = 1 << 19


@query(
    "colocated_pairs",
    "WITH c AS (SELECT DISTINCT l_partkey // 64 AS x, l_orderkey // 1024 AS y, l_linenumber::BIGINT AS z, l_suppkey AS label FROM lineitem), "
    "n AS (SELECT level::INT AS level, x >> level AS x, y >> level AS y, z >> level AS z, count(DISTINCT label)::BIGINT AS n FROM c, (SELECT unnest([0, 1, 2, 3]) AS level) GROUP BY ALL) "
    "SELECT k.level, p.x AS parent_x, p.y AS parent_y, p.z AS parent_z, k.x, k.y, k.z, p.n AS parent_labels, k.n AS child_labels FROM n p JOIN n k ON k.level = p.level + 1 AND k.x = p.x >> 1 AND k.y = p.y >> 1 AND k.z = p.z >> 1",
)
def colocated_pairs(spark, sf):
    """Distinct suppliers of every chunk beside those of the chunk it becomes, scale by scale, joined bucket by bucket."""
    rows = table(spark, sf, "lineitem").select(F.expr("l_partkey div 64").alias("chunk_x"), F.expr("l_orderkey div 1024").alias("chunk_y"), F.col("l_linenumber").cast("long").alias("chunk_z"), F.col("l_suppkey").alias("label"))
    scales = [geometry.Scale(str(k), ((1 << 27) >> k,) * 3) for k in range(4)]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), colocated.buckets_for(rows.count(), BUCKET_ROWS))
    own = colocated.create(spark, scratch(spark, "colocated"), scales, buckets, span=2)
    own.write_sets(labelsets.words(rows, materialize(labelsets.numbered(rows, scales[0]), "numbers")), 0)
    counted = lambda level: labelsets.counts(own.read(level), ["home", *labelsets.AT]).withColumnRenamed("unique_labels", "labels")
    out = None
    with colocated.subset_keys(spark):
        for level in (1, 2, 3):
            own.raise_sets(level)
            found = own.pairs(level, counted(level - 1), counted(level))
            stored = materialize(found.select(F.lit(level).alias("level"), *colocated.ABOVE, *(F.col(f"chunk_{a}").alias(a) for a in "xyz"), "parent_labels", "child_labels"), "pairs")
            out = stored if out is None else out.unionByName(stored)
    return out
