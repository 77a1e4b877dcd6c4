"""From Arrow shards to voxels, end to end, and the table operators around them."""

import json

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale, all_shards, shard_table
from lamellar.operators import calibration, codecs, labels, planning, telemetry, verification, volume
from lamellar.sources import shards, specs


def solid(value, upper=None):
    cube = np.full((64, 64, 64), value, np.uint64)
    if upper is not None:
        cube[32:] = upper
    return cube


CUBES = {(0, 0, 0): solid(100), (1, 0, 0): solid(200), (0, 1, 0): solid(300), (1, 1, 0): solid(400), (0, 0, 1): solid(500, 600), (1, 0, 1): solid(700), (0, 1, 1): solid(800), (1, 1, 1): solid(900)}


def shard_bytes(cubes=CUBES, batch_size=1):
    rows = []
    for (x, y, z), cube in cubes.items():
        own = np.unique(cube).tolist()
        plain = codecs.encode_block(cube)
        rows.append({"chunk_x": x, "chunk_y": y, "chunk_z": z, "labels": [v + 1000 for v in own], "supervoxels": own, shards.BLOCK_COLUMN: zstandard.ZstdCompressor().compress(plain), "uncompressed_size": len(plain)})
    return shards.write_shard(rows, batch_size)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("source") / "s0"
    d.mkdir()
    data = shard_bytes()
    (d / "0_0_0.arrow").write_bytes(data)
    size, offsets = shards.scan_offsets(data)
    lines = [f"# schema_size={size}", "x,y,z,offset,size,batch_idx", *(f"{x},{y},{z},{o},{n},{k}" for (x, y, z), (k, o, n) in zip(CUBES, offsets))]
    (d / "0_0_0.csv").write_text("\n".join(lines) + "\n")
    return str(d)


def test_export(spark, folder):
    scale = Scale("0", (128, 128, 100))
    for kind, add in ((codecs.SUPERVOXELS, 0), (codecs.LABELS, 1000)):
        d = codecs.decode(shards.read_shards(spark, folder), kind)
        assert d.where("error is not null").count() == 0
        v = volume.explode_voxels(d, scale)
        assert v.count() == 128 * 128 * 100
        want = {(32, 32, 32): 100, (96, 32, 32): 200, (32, 96, 32): 300, (96, 96, 32): 400, (32, 32, 80): 500, (32, 32, 98): 600, (96, 32, 96): 700, (96, 96, 96): 900}
        got = {(r.x, r.y, r.z): r.label for r in v.where(F.struct("x", "y", "z").isin(*(F.struct(*(F.lit(c).cast("long").alias(a) for a, c in zip("xyz", k))) for k in want))).collect()}
        assert got == {k: n + add for k, n in want.items()}


def test_decimated(spark, folder):
    d = codecs.decode(shards.read_shards(spark, folder), codecs.SUPERVOXELS)
    v = volume.explode_voxels(d, Scale("0", (128, 128, 64)), z_compress=1)
    assert v.groupBy().agg(F.max("z")).head()[0] == 63
    assert {r.label for r in v.where("x = 32 and y = 32 and z in (40, 60)").collect()} == {500, 600}


def test_index_ranges_and_pushdown(spark, folder):
    whole = shards.read_shards(spark, folder)
    ranged = shards.read_shards(spark, folder, indexed=True)
    assert ranged.count() == whole.count() == 8
    one = shards.index_entries(spark, folder).where("x = 1 and y = 0 and z = 1")
    assert shards.read_ranges(spark, one).count() == 1  # of eight batches only the one asked for is read
    assert [r.supervoxels for r in shards.find_chunk(spark, folder, 1, 0, 1).collect()] == [[700]]
    assert shards.find_chunk(spark, folder, 9, 9, 9).count() == 0
    with pytest.raises(ValueError):
        shards.read_chunk(whole, -1, 0, 0)
    assert {r.num_labels for r in shards.chunk_info(whole).collect()} == {1, 2}


def test_index_tables(spark, folder):
    idx = shards.read_index(spark, folder)
    found = shards.batch_offsets(spark, folder)
    assert idx.count() == 8
    assert idx.join(found, ["shard", "batch_idx", "offset", "size"]).count() == 8
    chunks = shards.read_shards(spark, folder)
    assert shards.missing_chunks(idx, chunks).count() == 0
    assert shards.indexed_chunks(idx, chunks.where("chunk_x = 0")).count() == 4
    assert shards.missing_chunks(idx, chunks.where("chunk_x = 0")).count() == 4
    assert [(r.scale, r.shard) for r in shards.list_shards(spark, folder).collect()] == [(0, "0_0_0")]


def test_parse_index():
    old, size = shards.parse_index(b"x,y,z,rec\n509,413,469,0\n")
    assert old == {(509, 413, 469): (-1, -1, 0)} and size == 0
    mixed, size = shards.parse_index(b"# schema_size=688\nx,y,z,rec,offset,size\n509,413,469,0,688,792\n")
    assert mixed == {(509, 413, 469): (-1, -1, 0)} and size == 688
    new, size = shards.parse_index(b"# schema_size=688\nx,y,z,offset,size,batch_idx\n509,413,469,688,792,0\n")
    assert new == {(509, 413, 469): (688, 792, 0)} and size == 688
    with pytest.raises(shards.ShardError):
        shards.parse_index(b"x,y\n1,2\n")
    with pytest.raises(shards.ShardError):
        shards.open_table(b"nonsense")


def test_broken_blocks_are_rows(spark):
    df = spark.createDataFrame([(0, 0, 0, [1], [1], bytearray(b"junk")), (1, 0, 0, [], [], bytearray(b""))], "chunk_x int, chunk_y int, chunk_z int, labels array<long>, supervoxels array<long>, block binary")
    rows = {r.chunk_x: r for r in codecs.decode(df).collect()}
    assert rows[0].voxels is None and "zstd" in rows[0].error and not any(rows[1].voxels) and rows[1].error is None
    with pytest.raises(ValueError):
        codecs.decode(df, "other")


def brute_mode(grid):
    out = {}
    X, Y, Z = grid.shape
    for x in range(0, X, 2):
        for y in range(0, Y, 2):
            for z in range(0, Z, 2):
                v, n = np.unique(grid[x : x + 2, y : y + 2, z : z + 2], return_counts=True)
                best = v[n == n.max()].min()
                if best:
                    out[x // 2, y // 2, z // 2] = int(best)
    return out


def test_downsample_votes_with_background(spark):
    rng = np.random.default_rng(3)
    grid = rng.integers(0, 3, (7, 6, 5)).astype(np.uint64)
    grid[grid == 2] = np.uint64((1 << 64) - 2)
    rows = [(int(x), int(y), int(z), int(grid[x, y, z].astype(np.int64))) for x, y, z in zip(*np.nonzero(grid))]
    got = {(r.x, r.y, r.z): r.label & ((1 << 64) - 1) for r in volume.downsample(spark.createDataFrame(rows, "x long, y long, z long, label long"), grid.shape).collect()}
    assert got == brute_mode(grid)


def test_label_pairs(spark):
    c = spark.createDataFrame([(1, [10, 20, 30], [5, 5, 7, 8])], "chunk int, labels array<long>, supervoxels array<long>")
    assert {(r.sv, r.label) for r in labels.last_pairs(c, ["chunk"]).collect()} == {(5, 20), (7, 30)}


def test_balanced_tasks(spark):
    rows = spark.createDataFrame([(4, i, (i * 37) % 101 + 1) for i in range(60)], "tier_gib int, id int, bytes long")
    got = planning.balanced(rows, "bytes", 7).collect()
    loads = {}
    for r in got:
        loads[r.task_id] = loads.get(r.task_id, 0) + r.bytes
    total, top = sum(r.bytes for r in got), max(r.bytes for r in got)
    assert len(got) == 60 and set(loads) == set(range(7)) and max(loads.values()) <= total / 7 + top
    assert planning.balanced(rows.limit(3), "bytes", 7).select("task_id").distinct().count() == 3


def greedy(rows, tasks):
    """task by id of (key, id, weight): heaviest first, each to the least loaded."""
    out, loads = {}, {}
    for key, i, w in sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[1])):
        own = loads.setdefault(key, [0] * tasks)
        k = own.index(min(own))
        own[k] += w or 0
        out[i] = k
    return out


@pytest.mark.parametrize("kind", ["long", "double", "decimal(20,2)"])
def test_balanced_block_by_block(spark, kind):
    # Blocks of 40 rows: several steps, ties, equal loads, groups that end early, a null group and null weights
    rows = [(None if i % 11 == 0 else 4 if i % 3 else 8, i, None if i % 40 == 9 else (i * 37) % 23) for i in range(200)] + [(16, 1000 + i, (1 << 40) + i % 2) for i in range(3)]
    df = spark.createDataFrame(rows, "tier_gib int, id int, bytes long").withColumn("bytes", F.col("bytes").cast(kind))
    for block in (40, 1 << 19):
        got = planning.balanced(df, "bytes", 5, tie="id", block=block)
        assert got.columns == ["tier_gib", "id", "bytes", "task_id"] and got.schema["bytes"] == df.schema["bytes"]
        assert {r.id: r.task_id for r in got.collect()} == greedy(rows, 5)
        assert got.count() == len(rows)
    assert planning.balanced(df.limit(0), "bytes", 5, tie="id").count() == 0
    # No task was given a whole group: the rows of the largest one came in files of a block at most
    files = planning.balanced(df, "bytes", 5, tie="id", block=40).groupBy(F.input_file_name(), "tier_gib").count()
    assert files.agg(F.max("count")).head()[0] <= 40


def test_points_and_faces(spark):
    s = Scale("t", (128, 64, 64), shard=1)
    both = all_shards(s, spark)
    assert both.count() == 2
    left = shard_table(s, both.where("shard = 0"))
    faces = verification.exposed_faces(s, left, both.where("shard = 0")).collect()
    assert [(f.axis, f.direction, f.area) for f in faces] == [("x", 1, 64 * 64)]
    inside = verification.sample_inside(left, 200, 5)
    assert inside.where("x between 0 and 63 and y between 0 and 63 and z between 0 and 63").count() == 200
    outside = verification.sample_outside(verification.exposed_faces(s, left, both.where("shard = 0")), 50, 5)
    assert outside.where("x = 64 and y between 0 and 63").count() == 50
    points = spark.createDataFrame([(0, 1, 1, 1), (1, 2, 2, 2)], "point_id long, x long, y long, z long")
    ours = spark.createDataFrame([(1, 1, 1, 7)], "x long, y long, z long, label long")
    truth = spark.createDataFrame([(1, 1, 1, 99)], "x long, y long, z long, label long")
    assert [tuple(r) for r in verification.mismatches(points, ours, truth).select("point_id", "export_value", "truth_value").collect()] == [(0, 7, 99)]


def test_sampling_follows_volume(spark):
    s = Scale("t", (100, 64, 64), shard=1)
    n = verification.sample_inside(shard_table(s, all_shards(s, spark)), 4000, 1).where("x < 64").count()
    assert abs(n / 4000 - 0.64) < 0.04


def test_fits_and_percentiles(spark):
    rows = spark.createDataFrame([(0, float(x), 2.0 * x) for x in range(1, 6)], "k int, x double, y double")
    r = calibration.fit_one(rows, "y", "x", ["k"]).head()
    assert r.a == pytest.approx(2) and r.r2 == pytest.approx(1)
    r = calibration.fit_two(rows.withColumn("w", F.col("x") * F.col("x")).withColumn("y", 3 * F.col("x") - F.col("w")), "y", "x", "w", ["k"]).head()
    assert (r.a, r.b) == (pytest.approx(3), pytest.approx(-1))
    assert calibration.fit_two(rows.limit(2), "y", "x", "x", ["k"]).head().a is None
    four = spark.createDataFrame([(0, v) for v in (1, 2, 3, 4)], "k int, v int")
    assert calibration.percentiles(four, "v", ["k"], (50, 100)).head().asDict() == {"k": 0, "p50": 3, "p100": 4}


def test_specs_and_manifests(spark, tmp_path):
    spec = {"@type": specs.SPEC_TYPE, "data_type": "uint64", "num_channels": 1, "scales": [{"key": "8x8x8", "size": [94088, 78317, 134576], "chunk_sizes": [[64, 64, 64], [1, 1, 1]], "resolution": [8, 8, 8], "sharding": {"preshift_bits": 9, "minishard_bits": 6, "shard_bits": 19}}]}
    path = tmp_path / "spec.json"
    path.write_text(json.dumps(spec))
    scales = specs.scales_of(specs.read_spec(spark, str(path)))
    assert scales == specs.parse_spec(path.read_text(), True) and scales[0].bits == (11, 11, 12)
    with pytest.raises(specs.SpecError):
        specs.parse_spec('{"scales": []}', True)
    assert json.loads(specs.destination_info(path.read_text()))["scales"][0]["compressed_segmentation_block_size"] == [8, 8, 8]
    tasks = spark.createDataFrame([(4, 0, 0, "a"), (4, 1, 0, "b"), (8, 0, 1, "c")], "tier_gib int, task_id int, scale int, shard string")
    specs.write_manifests(tasks, str(tmp_path / "m"))
    assert sorted(map(tuple, specs.read_manifests(spark, str(tmp_path / "m"), "scale int, shard string").select("tier_gib", "task_id", "scale", "shard").collect())) == sorted(map(tuple, tasks.collect()))
    one = tmp_path / "f" / "tier-16gi"
    one.mkdir(parents=True)
    (one / "task-3.json").write_text('[{"scale": 0, "shard": "x"}, {"scale": 1, "shard": "y"}]')
    assert [tuple(r) for r in specs.read_task_files(spark, str(tmp_path / "f")).orderBy("scale").collect()] == [(16, 3, 0, "x"), (16, 3, 1, "y")]
    env = specs.read_env('A=1\n# no\nexport B="two words"\n')
    assert env == {"A": "1", "B": "two words"}


def test_reports(spark):
    want = spark.createDataFrame([("a", "s1"), ("a", "s2"), ("b", "s3")], "file string, shard string")
    have = spark.createDataFrame([("a",), ("c",)], "file string")
    c = verification.compare_outputs(want, have)
    r = verification.report(c, 0, "k").head()
    assert (r.source_shards, r.expected_shards, r.actual_shards, r.missing_count, r.orphaned_count) == (3, 2, 2, 1, 1)
    assert [tuple(m) for m in verification.missing_sources(c, 0).collect()] == [(0, "b", "s3")] and [tuple(o) for o in verification.orphans(c, 0).collect()] == [(0, "c")]
    empty = verification.report(verification.compare_outputs(want.limit(0), have.limit(0)), 0, "k").head()
    assert (empty.source_shards, empty.expected_shards, empty.actual_shards) == (0, 0, 0)


def test_failed_leaves_empty_out(spark):
    s = spark.createDataFrame([(0, x) for x in "abc"], "scale int, shard string")
    assert [r.shard for r in telemetry.failed_shards(s, s.where("shard = 'a'"), s.where("shard = 'b'")).collect()] == ["c"]


@pytest.mark.parametrize("bins", [4096, 200])
def test_percentiles_by_refinement(spark, monkeypatch, bins):
    """Skewed, tied, huge and tiny values, and null keys, against sorted lists."""
    monkeypatch.setattr(calibration, "BINS", bins)
    rng = np.random.default_rng(5)
    groups = {"a": 10.0 ** rng.uniform(-250, 250, 200), "b": np.repeat([1.5, 2.5], [90, 11]), None: rng.normal(0, 1, 77), "one": np.array([-3.25]), "ends": np.array([-1.7e308, 1.7e308, 0.0])}
    rows = [(k, float(v)) for k, own in groups.items() for v in own] + [("a", None), ("gone", None), ("b", float("nan"))]
    points = (0, 5, 50, 95, 100)
    got = {r.k: r.asDict() for r in calibration.percentiles(spark.createDataFrame(rows, "k string, v double"), "v", ["k"], points).collect()}
    for k, own in groups.items():
        own = sorted(map(float, own))
        assert got.pop(k) == {"k": k} | {f"p{p}": own[min(int(p / 100 * len(own)), len(own) - 1)] for p in points}
    assert not got
    longs = sorted(int(v) for v in rng.integers(-(1 << 62), 1 << 62, 60)) + [(1 << 62) + 1, (1 << 62) + 2]
    df = spark.createDataFrame([(v,) for v in longs], "v long")
    assert calibration.percentiles(df, "v", [], points).head().asDict() == {f"p{p}": longs[min(int(p / 100 * 62), 61)] for p in points}
