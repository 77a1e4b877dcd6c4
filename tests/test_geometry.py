"""Published golden values of compressed Morton codes and shard geometry."""

import pytest
from pyspark.sql import functions as F

from lamellar.functions import bits, geometry as g, models, text

GOLDEN = g.Scale("golden", (99, 98, 97), (50, 25, 13), 1, 2, 3)
LARGE = g.Scale("large", (94088, 78317, 134576), (64, 64, 64), 9, 6, 19)


def one(spark, *columns):
    return spark.range(1).select(*columns).head()


def grid_scale(bits_):
    return g.Scale("b", tuple(64 * (1 << b) if b else 64 for b in bits_))


@pytest.mark.parametrize("bits_,at,code", [((4, 2, 1), (2, 0, 1), 12), ((4, 2, 1), (2, 3, 0), 26), ((4, 2, 1), (9, 2, 1), 85), ((1, 1, 3), (0, 0, 4), 16)])
def test_morton(spark, bits_, at, code):
    assert grid_scale(bits_).bits == bits_
    assert one(spark, g.morton(grid_scale(bits_), *map(F.lit, at)))[0] == code


def test_bits():
    assert GOLDEN.grid == (2, 4, 8) and GOLDEN.bits == (1, 2, 3)
    assert LARGE.grid == (1471, 1224, 2103) and LARGE.bits == (11, 11, 12)
    assert GOLDEN.shard_shape == (2, 2, 2) and GOLDEN.minishard_shape == (2, 1, 1)
    with pytest.raises(ValueError):
        _ = g.Scale("small", (99, 98, 97), (50, 25, 13), 1, 1, 1).shard_shape


@pytest.mark.parametrize("bits_,n,name", [(16, 65535, "ffff"), (4, 15, "f"), (0, 0, "0"), (12, 255, "0ff"), (19, 25029, "061c5")])
def test_file_names(spark, bits_, n, name):
    got = one(spark, g.shard_filename(F.lit(n), bits_).alias("f"))
    assert got.f == f"{name}.shard"
    assert one(spark, g.filename_number(F.lit(got.f)))[0] == n


def test_real_shard(spark):
    assert one(spark, g.shard_of_name(LARGE, F.lit("10240_40960_43008")))[0] == 25029
    assert one(spark, g.shard_of_name(LARGE, F.lit("10240_40960")))[0] is None


@pytest.mark.parametrize("size,counts", [((99, 98, 97), [8] * 8), ((99, 98, 91), [8] * 4 + [8, 8, 4, 4]), ((99, 75, 91), [8, 4, 8, 4, 8, 4, 4, 2])])
def test_chunks_per_shard(spark, size, counts):
    s = g.Scale("c", size, (50, 25, 13), 1, 2, 3)
    rows = spark.range(9).select(g.chunks_per_shard(s, F.col("id"))).collect()
    assert sorted(r[0] for r in rows) == sorted([*counts, 0])


def test_boxes(spark):
    rows = {r.shard: r for r in g.shard_table(GOLDEN, spark.range(8).withColumnRenamed("id", "shard")).collect()}
    assert [rows[0][c] for c in ("ox", "oy", "oz", "ex", "ey", "ez")] == [0, 0, 0, 99, 50, 26]
    assert [rows[7][c] for c in ("ox", "oy", "oz", "ex", "ey", "ez")] == [0, 50, 78, 99, 48, 19]
    assert sum(r.volume for r in rows.values()) == 99 * 98 * 97


def test_no_shard_beyond_the_grid(spark):
    s = g.Scale("n1", (1471 * 64, 1224 * 64, 2103 * 64), (64, 64, 64), 9, 6, 19)
    x, y = 1472, 1248
    code = one(spark, g.shard_number(s, g.morton(s, F.lit(x), F.lit(y), F.lit(0))).alias("n")).n
    assert one(spark, g.chunks_per_shard(s, F.lit(code)))[0] == 0


def test_shift_guard(spark):
    assert one(spark, g.shifted(F.lit(8).cast("long"), 64))[0] == 0
    assert one(spark, g.masked(F.lit(-1).cast("long"), 64))[0] == -1


def test_chunks_and_children_agree(spark):
    parent, child = g.Scale("p", (700, 500, 300), (16, 16, 16), 1, 3, 20), g.Scale("c", (350, 250, 150), (16, 16, 16), 2, 1, 20)
    shards = g.all_shards(parent, spark)
    chunks = g.chunk_coordinates(parent, shards)
    assert chunks.count() == chunks.select("cx", "cy", "cz").distinct().count() == parent.grid[0] * parent.grid[1] * parent.grid[2]
    half = [F.least(F.shiftright(c, 1), F.lit(n - 1)) for c, n in zip(("cx", "cy", "cz"), child.grid)]
    want = {r[0] for r in chunks.select(g.shard_number(child, g.morton(child, *half))).distinct().collect()}
    assert {r.shard for r in g.child_shards(parent, child, shards).collect()} == want


def test_axis_that_stays(spark):
    s0, s1 = g.Scale("0", (102400, 57344, 10254), (64, 64, 32)), g.Scale("1", (51200, 28672, 10254), (64, 64, 32))
    assert g.axis_factors(s0, s1) == (2, 2, 1)


def test_decimation_must_divide():
    with pytest.raises(ValueError):
        g.check_stride(2)
    assert g.check_stride(3) == 4


def test_bit_helpers(spark):
    want = {0: 0, 1: 0, 2: 1, 4: 2, 8: 3, 16: 4, 17: 5}
    for n, b in want.items():
        assert one(spark, bits.bits_for(F.lit(n)))[0] == b
    enc = {1: 0, 2: 1, 3: 2, 4: 2, 5: 4, 16: 4, 17: 8, 256: 8, 257: 16, 512: 16}
    for n, b in enc.items():
        assert one(spark, bits.encoding_bits(F.lit(n)))[0] == b
    assert str(one(spark, bits.unsigned(F.lit(-1).cast("long")))[0]) == str((1 << 64) - 1)
    rows = spark.createDataFrame([(1,), (-1,), (0,)], "v long").orderBy(bits.unsigned_order(F.col("v"))).collect()
    assert [r.v for r in rows] == [0, 1, -1]


def test_models(spark):
    gib = one(spark, models.export_gib(F.lit(1 << 30), F.lit(1000), F.lit(0)).alias("g")).g
    assert gib == pytest.approx(1 + 2 * 1000 * 13932 / (1 << 30) + 2)
    assert [one(spark, models.pick_tier(F.lit(v)))[0] for v in (1.0, 4.0, 4.1, 99.0)] == [4, 4, 8, 32]
    assert one(spark, models.pick_tier(F.lit(1.0), 16))[0] == 16
    parts = models.downres(F.lit(4), F.lit(64), F.lit(10**8))
    r = one(spark, *(v.alias(k) for k, v in parts.items()))
    assert r.estimate_model == "label_aware" and r.label_readback_gib == pytest.approx(8e9 / (1 << 30)) and r.raw_batch_gib == pytest.approx(int(64 ** (2 / 3)) * 2 / 1024)


def test_text(spark):
    got = {m: one(spark, text.error_class(F.lit(m)))[0] for m in ("ZSTD broke", "CURL error 3", "curl error", "x Not Found", "TIMEOUT", "oom", "fine")}
    assert list(got.values()) == ["zstd_decompression", "curl_gcs", "other", "file_not_found", "timeout", "memory_pressure", "other"]
    assert one(spark, text.embedded_json(F.lit('INFO x {"k": 3}'), "k long"))[0].k == 3
    assert one(spark, text.embedded_json(F.lit("no json"), "k long"))[0] is None
    assert [one(spark, text.elapsed(F.lit(v)))[0] for v in (3.4, 123.0, 3723.0)] == ["3s", "2m03s", "1h02m03s"]
    assert one(spark, text.memory_gib(F.lit("512Mi")))[0] == 0.5 and one(spark, text.memory_gib(F.lit("x")))[0] is None
    assert one(spark, text.tier_of(F.lit("a/tier-16gi/task-3.json")))[0] == 16
    assert one(spark, text.labels_url(F.lit("http://h/api/"), F.lit("u"), F.lit("seg"), F.lit(2), True, F.lit("[]")))[0] == "http://h/api/node/u/seg/labels?scale=2&hash=d751713988987e9331980363e24189ce&supervoxels=true"
