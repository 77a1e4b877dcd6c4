"""Export, pyramid and verification over a synthetic 2 x 2 x 4 chunk source."""

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale
from lamellar.operators import chunked, codecs, volume
from lamellar.plans import pipelines, runs
from lamellar.sources import shards
from test_volume import brute_mode


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    d = tmp_path_factory.mktemp("src") / "s0"
    d.mkdir()
    rng = np.random.default_rng(4)
    whole = np.zeros((256, 128, 128), np.uint64)
    whole[:128, :64] = rng.integers(1, 4, (128, 64, 128), dtype=np.uint64)
    whole[64:192, 64:, 10:90] = np.uint64((1 << 63) + 5)
    rows = []
    for x, y, z in np.ndindex(2, 2, 4):
        cube = whole[z * 64 : z * 64 + 64, y * 64 : y * 64 + 64, x * 64 : x * 64 + 64]
        own = np.unique(cube).tolist()
        plain = codecs.encode_block(cube)
        rows.append({"chunk_x": x, "chunk_y": y, "chunk_z": z, "labels": own, "supervoxels": own, shards.BLOCK_COLUMN: zstandard.ZstdCompressor().compress(plain), "uncompressed_size": len(plain)})
    (d / "0_0_0.arrow").write_bytes(shards.write_shard(rows))
    return str(d), whole


def assembled(df, size):
    out = np.zeros(size[::-1], np.uint64)
    for r in df.collect():
        cube = np.frombuffer(bytes(r.voxels), "<u8").reshape(64, 64, 64)
        z, y, x = r.chunk_z * 64, r.chunk_y * 64, r.chunk_x * 64
        part = out[z : z + 64, y : y + 64, x : x + 64]
        part[:] = cube[: part.shape[0], : part.shape[1], : part.shape[2]]
    return out


@pytest.mark.parametrize("z_compress", [0, 1])
def test_run(spark, source, tmp_path, z_compress):
    path, whole = source
    plain = whole[:: z_compress + 1]
    size = (101, 128, len(plain) - 3)
    half = tuple(-(-n // 2) for n in size)
    scales = [Scale("s0", size, shard=2, preshift=4), Scale("s1", half, shard=2, preshift=4)]
    out = str(tmp_path / "out")
    assert pipelines.export(spark, path, out, scales[0], z_compress=z_compress).count() == 0
    want = plain[: size[2], : size[1], : size[0]]
    assert (assembled(pipelines.read_level(spark, out, 0), size) == want).all()
    pipelines.pyramid(spark, out, scales)
    got = assembled(pipelines.read_level(spark, out, 1), half)
    assert {(x, y, z): int(got[z, y, x]) for z, y, x in zip(*np.nonzero(got))} == brute_mode(want.transpose(2, 1, 0))
    p = pipelines.profile(spark, out, 1, scales[1]).agg(F.sum("total_labels")).head()[0]
    assert p == sum(len(set(np.unique(np.frombuffer(bytes(r.voxels), "<u8"))) - {0}) for r in pipelines.read_level(spark, out, 1).collect())
    r = pipelines.verify(spark, path, out, scales[0], 0, z_compress).head()
    assert r.expected_shards == 1 and r.missing_count == 0
    assert pipelines.empty_shards(spark, path).count() == 0


def test_chunk_and_voxel_downsampling_agree(spark, source):
    path, whole = source
    a, b = Scale("a", (128, 128, 250)), Scale("b", (64, 64, 125))
    chunks = chunked.clip(codecs.decode(shards.read_shards(spark, path)), a)
    by_chunk = volume.explode_voxels(chunked.downsample(chunks, a, b), b)
    by_voxel = volume.downsample(volume.explode_voxels(chunks, a), a.size)
    assert by_chunk.count() == by_voxel.count() and by_chunk.exceptAll(by_voxel.select("x", "y", "z", "label")).count() == 0


def test_encoded(spark, source):
    path, whole = source
    e = chunked.encode(codecs.decode(shards.read_shards(spark, path)).limit(3), Scale("s", (128, 128, 256)), gzipped=False)
    for r in e.collect():
        cube = whole[r.chunk_z * 64 :, r.chunk_y * 64 :, r.chunk_x * 64 :][:64, :64, :64]
        assert (codecs.decode_segmentation(bytes(r.encoded), cube.shape) == cube).all()


def test_anisotropic_vote():
    v = np.zeros((2, 4, 4), np.uint64)
    v[0, 0, :2] = 7
    assert chunked.vote(v, (2, 4, 4), (1, 2, 2))[0, 0, 0] == 0  # two against two: the smaller label
    assert chunked.vote(v, (1, 1, 4), (1, 2, 2))[0, 0, 0] == 7 and not chunked.vote(v, (0, 4, 4), (1, 2, 2)).any()


def test_modes(spark, source, tmp_path):
    path, whole = source
    scales = [Scale("s0", (128, 128, 256), shard=2, preshift=4), Scale("s1", (64, 64, 128), shard=2, preshift=4)]
    out = str(tmp_path / "run")
    with pytest.raises(ValueError, match="mode"):
        runs.run(spark, path, out, scales, "other")
    dry = runs.run(spark, path, out, scales, dry_run=True)
    assert [r.level for r in dry] == [0] and sum(dry[0].planned.values()) == 1 and not (tmp_path / "run").exists()
    first = runs.run(spark, path, out, scales, runs.EXPORT)
    assert [(r.level, r.missing, r.orphaned, r.shards_failed, r.chunks_failed) for r in first] == [(0, 0, 0, 0, 0)]
    then = runs.run(spark, path, out, scales, runs.PYRAMID)
    assert [r.level for r in then] == [1] and then[0].missing == 0 and sum(then[0].planned.values()) >= 1
    again = runs.run(spark, path, out, scales, runs.RETRY)  # nothing of the first scale is missing
    assert [r.level for r in again] == [0, 1] and again[0].planned == {}
    with pytest.raises(runs.RunStopped, match="no time"):
        runs.run(spark, path, out, scales, limit_minutes=-1)


def test_a_run_stops_where_outputs_are_missing(spark, source, tmp_path):
    """A source shard whose chunks all lie outside the volume writes nothing: the scale is not complete."""
    path, _ = source
    scales = [Scale("s0", (128, 128, 256), shard=2, preshift=4), Scale("s1", (64, 64, 128), shard=2, preshift=4)]
    far = tmp_path / "far" / "s0"
    far.mkdir(parents=True)
    (far / "0_0_0.arrow").write_bytes(open(f"{path}/0_0_0.arrow", "rb").read())
    cube = np.full((64, 64, 64), 3, np.uint64)
    plain = codecs.encode_block(cube)
    row = {"chunk_x": 9, "chunk_y": 0, "chunk_z": 0, "labels": [3], "supervoxels": [3], shards.BLOCK_COLUMN: zstandard.ZstdCompressor().compress(plain), "uncompressed_size": len(plain)}
    (far / "64_64_0.arrow").write_bytes(shards.write_shard([row]))
    for name in ("0_0_0", "64_64_0"):
        (far / f"{name}.csv").write_text("x,y,z,rec\n0,0,0,0\n")
    scales[0] = Scale("s0", (128, 128, 256), shard=4, preshift=0)
    with pytest.raises(runs.RunStopped) as e:
        runs.run(spark, str(far), str(tmp_path / "out"), scales)
    assert e.value.results[-1].shards_failed == 1 and len(e.value.results) == 1


def test_patience():
    waits, calls = [], []

    def work():
        calls.append(1)
        if len(calls) < 4:
            raise OSError("busy")
        return "done"

    assert shards.patiently(work, sleep=waits.append) == "done" and waits == [1.0, 2.0, 4.0]
    with pytest.raises(OSError):
        shards.patiently(lambda: (_ for _ in ()).throw(OSError("gone")), attempts=2, sleep=waits.append)
    with pytest.raises(shards.ShardError):
        shards.patiently(lambda: (_ for _ in ()).throw(shards.ShardError("broken")), sleep=lambda s: pytest.fail("waited"))


def test_label_service_checks_lengths(spark):
    from lamellar.sources.labels import service_labels

    p = spark.createDataFrame([(i, i, 2 * i, 3) for i in range(7)], "point_id long, x long, y long, z long")
    got = service_labels(p, "http://h/api", "u", "seg", 1, True, lambda url, body: b"[1,2]", batch=2)
    with pytest.raises(Exception, match="2 labels for 1 points"):
        got.collect()
