"""Sharded volume files: the format byte by byte, pruning by counted reads, committed writes, resumed runs, seeking scans."""

import gzip
import json
import struct

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

from lamellar.functions.geometry import Scale
from lamellar.operators import chunked, codecs, ranks
from lamellar.plans import pipelines, runs
from lamellar.sources import files, shards, volumes

SCALE = Scale("s0", (100, 70, 50), (8, 8, 8), 2, 3, 6)


def chunk_rows(n=60, seed=1):
    rng = np.random.default_rng(seed)
    at = {tuple(int(v) for v in rng.integers(0, SCALE.grid)) for _ in range(n)}
    return [(*a, bytearray(gzip.compress(bytes(rng.integers(0, 255, int(rng.integers(1, 400)), dtype=np.uint8))))) for a in sorted(at)]


@pytest.fixture(scope="module")
def volume(spark, tmp_path_factory):
    path, rows = str(tmp_path_factory.mktemp("volume")), chunk_rows()
    volumes.write_volume(spark.createDataFrame([*rows, (*rows[0][:3], rows[0][3] + b"longer")], "chunk_x int, chunk_y int, chunk_z int, encoded binary"), path, SCALE)
    return path, rows


def test_files_follow_the_format(volume):
    """Read with nothing but the format's rules."""
    path, rows = volume
    want = {volumes.code_of(SCALE, r[:3]): bytes(r[3]) for r in rows}
    assert [volumes.codes_at(SCALE, np.array([c]))[:, 0].tolist() for c in want] == [list(r[:3]) for r in rows]
    got = {}
    for name in {volumes.file_name(c >> 5 & 63, 6) for c in want}:
        data = open(f"{path}/s0/{name}", "rb").read()
        number, body = int(name.split(".")[0], 16), data[16 * 8 :]
        for k in range(8):
            start, end = struct.unpack_from("<2Q", data, 16 * k)
            if start == end:
                continue
            words = np.frombuffer(gzip.decompress(body[start:end]), "<u8").reshape(3, -1)
            code = at = 0
            for delta, gap, size in words.T.tolist():
                code, at = code + delta, at + gap
                assert code >> 5 & 63 == number and code >> 2 & 7 == k
                got[code] = body[at : at + size]
                at += size
    assert got == want
    info = json.load(open(f"{path}/info"))
    assert info["scales"][0]["sharding"] | {"preshift_bits": 2, "minishard_bits": 3, "shard_bits": 6} == info["scales"][0]["sharding"] and volumes.scales_at(path) == [SCALE]


class Counted:
    def __init__(self, f, log):
        self.f, self.log = f, log

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.f.close()

    def read_at(self, n, at):
        self.log.append(n)
        return self.f.read_at(n, at)

    def __getattr__(self, name):
        return getattr(self.f, name)


def counted(monkeypatch, module):
    opened, read = [], []

    def open_input(path):
        opened.append(path)
        return Counted(files.open_input(path), read)

    monkeypatch.setattr(module, "open_input", open_input)
    return opened, read


def read_with(reader, filters):
    assert list(reader.pushFilters(filters)) == filters
    return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


def test_filters_reach_the_files(volume, monkeypatch):
    path, rows = volume
    opened, read = counted(monkeypatch, volumes)
    assert len(read_with(volumes.VolumeReader(path, SCALE), [])) == len(rows)
    every, size = len(opened), sum(read)
    opened.clear(), read.clear()
    x, y, z, data = rows[7]
    at = [EqualTo((f"chunk_{a}",), v) for a, v in zip("xyz", (x, y, z), strict=True)]
    assert [r["encoded"] for r in read_with(volumes.VolumeReader(path, SCALE), at)] == [bytes(data)]
    assert len(opened) == 1 < every and sum(read) < 128 + 200 + len(data) < size
    opened.clear()
    got = read_with(volumes.VolumeReader(path, SCALE), [GreaterThanOrEqual(("chunk_x",), 9), LessThan(("chunk_y",), 4)])
    assert {(r["chunk_x"], r["chunk_y"], r["chunk_z"]) for r in got} == {r[:3] for r in rows if r[0] >= 9 and r[1] < 4} and len(opened) < every
    opened.clear()
    number = volumes.code_of(SCALE, rows[0][:3]) >> 5
    assert {r["shard"] for r in read_with(volumes.VolumeReader(path, SCALE), [In(("shard",), (number, 10_000))])} == {number} and len(opened) == 1


def test_files_are_split_by_minishards(volume, monkeypatch):
    path, rows = volume
    monkeypatch.setattr(volumes, "SPLIT_BYTES", 100)
    monkeypatch.setattr(volumes, "GAP_BYTES", 0)
    reader = volumes.VolumeReader(path, SCALE)
    assert len(reader.partitions()) > len({p.path for p in reader.partitions()})
    assert sorted((r["chunk_x"], r["chunk_y"], r["chunk_z"]) for r in read_with(reader, [])) == sorted(r[:3] for r in rows)


def test_read_by_spark(spark, volume):
    path, rows = volume
    v = volumes.read_volume(spark, path)
    assert v.where("chunk_x = 3 or chunk_y is null").count() == sum(r[0] == 3 for r in rows) and v.where("chunk_x > 1000").count() == 0
    some = volumes.volume_files(spark, path).where("shard % 2 = 0")
    assert {r.shard % 2 for r in volumes.read_files(some, SCALE).select("shard").collect()} == {0}


def test_only_committed_files_are_seen(spark, volume, tmp_path):
    _, rows = volume
    chunks = spark.createDataFrame(rows, "chunk_x int, chunk_y int, chunk_z int, encoded binary")
    path = str(tmp_path / "out")
    volumes.write_info(path, SCALE, 0)
    staged = volumes.ordered(chunks, SCALE).toArrow().to_batches()
    writer = volumes.VolumeWriter(path, SCALE.key, SCALE.shard, SCALE.minishard)
    lost, kept = writer.write(iter(staged)), writer.write(iter(staged))  # an attempt that was lost, and the one that counts
    assert len(lost.files) == len(kept.files) > 3 and volumes.volume_files(spark, path).count() == 0
    writer.commit([kept])
    assert volumes.read_volume(spark, path).count() == len(rows) and [p.name for p in sorted((tmp_path / "out").iterdir())] == ["info", "s0"]
    before = {p.name: p.read_bytes() for p in (tmp_path / "out" / "s0").iterdir()}
    broken = chunks.withColumn("encoded", F.when(F.col("chunk_x") == rows[-1][0], F.expr("cast(raise_error('lost') as binary)")).otherwise(F.lit(b"new")))
    with pytest.raises(Exception, match="lost"):
        volumes.write_volume(broken, path, SCALE)
    again = volumes.VolumeWriter(path, SCALE.key, SCALE.shard, SCALE.minishard)
    again.write(iter(staged))
    again.abort([])
    assert {p.name: p.read_bytes() for p in (tmp_path / "out" / "s0").iterdir()} == before and not (tmp_path / "out" / "_staging").exists()
    with pytest.raises(volumes.VolumeError, match="did not come"):
        again.write(iter([staged[0].slice(0, 1)]))


def test_replaced_and_other_shards(spark, volume, tmp_path):
    _, rows = volume
    path, schema = str(tmp_path / "out"), "chunk_x int, chunk_y int, chunk_z int, encoded binary"
    volumes.write_volume(spark.createDataFrame(rows, schema), path, SCALE)
    number = volumes.code_of(SCALE, rows[0][:3]) >> 5
    own = [(*r[:3], bytearray(b"new")) for r in rows if volumes.code_of(SCALE, r[:3]) >> 5 == number][:1]
    volumes.write_volume(spark.createDataFrame(own, schema), path, SCALE)
    found = volumes.read_volume(spark, path).collect()
    assert [bytes(r.encoded) for r in found if r.shard == number] == [b"new"]
    assert {r[:3] for r in rows if volumes.code_of(SCALE, r[:3]) >> 5 != number} == {(r.chunk_x, r.chunk_y, r.chunk_z) for r in found if r.shard != number}
    volumes.write_volume(spark.createDataFrame([], schema), str(tmp_path / "none"), SCALE)
    assert volumes.read_volume(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(volumes.VolumeError, match="before scale"):
        volumes.write_info(path, SCALE, 3)
    with pytest.raises(ValueError, match="exceed"):
        volumes.write_volume(spark.createDataFrame(own, schema), path, Scale("s", (100, 100, 100), (8, 8, 8)))


def source_shard(folder, name, chunks, index=True, batch=1):
    rows = []
    for (x, y, z), cube in chunks.items():
        plain, own = codecs.encode_block(cube), np.unique(cube).tolist()
        rows.append({"chunk_x": x, "chunk_y": y, "chunk_z": z, "labels": own, "supervoxels": own, shards.BLOCK_COLUMN: zstandard.ZstdCompressor().compress(plain), "uncompressed_size": len(plain)})
    data = shards.write_shard(rows, batch)
    (folder / f"{name}.arrow").write_bytes(data)
    if index:
        size, at = shards.scan_offsets(data)
        lines = [f"# schema_size={size}", "x,y,z,offset,size,batch_idx"] + [f"{r['chunk_x']},{r['chunk_y']},{r['chunk_z']},{at[k // batch][1]},{at[k // batch][2]},{k // batch}" for k, r in enumerate(rows)]
        (folder / f"{name}.csv").write_text("\n".join(lines))


def test_a_retry_reads_only_what_is_missing(spark, tmp_path):
    """Sources of shards that are there have been spoilt: whoever opened them would fail."""
    scale = Scale("s0", (64, 8, 8), (8, 8, 8), 0, 1, 2)
    src, out = tmp_path / "s0", str(tmp_path / "out")
    src.mkdir()
    for k in range(4):
        source_shard(src, f"{k * 16}_0_0", {(2 * k + i, 0, 0): np.full((8, 8, 8), k + 1, np.uint64) for i in range(2)})
    runs.run(spark, str(src), out, [scale], runs.EXPORT)
    whole = {p.name: p.read_bytes() for p in (tmp_path / "out" / "s0").iterdir()}
    assert len(whole) == 4
    (tmp_path / "out" / "s0" / "2.shard").unlink()
    for k in (0, 1, 3):
        (src / f"{k * 16}_0_0.arrow").write_bytes(b"spoilt")
    runs.run(spark, str(src), out, [scale], runs.RETRY)
    assert {p.name: p.read_bytes() for p in (tmp_path / "out" / "s0").iterdir()} == whole
    (tmp_path / "out" / "s0" / "1.shard").write_bytes(b"spoilt")
    done = spark.createDataFrame([(1,)], "shard long")
    assert {r.shard: r.total_labels for r in pipelines.profile(spark, out, 0, scale, done).collect()} == {0: 2, 2: 2, 3: 2}


def test_a_resumed_run_does_what_is_new(spark, tmp_path):
    """By the ledger: nothing at first, then a changed source with the others of its file, then a file that is gone; broken sources stay open."""
    scale = Scale("s0", (64, 8, 8), (8, 8, 8), 0, 1, 2)
    src, out = tmp_path / "s0", str(tmp_path / "out")
    src.mkdir()
    put = lambda k, label: source_shard(src, f"{k * 8}_0_0", {(k, 0, 0): np.full((8, 8, 8), label, np.uint64)})
    for k in range(8):
        put(k, k + 1)
    times = lambda: {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out" / "s0").iterdir()}
    value = lambda: {r.chunk_x: int(np.frombuffer(bytes(r.voxels), "<u8")[0]) for r in pipelines.read_level(spark, out, 0).collect()}
    first = runs.run(spark, str(src), out, [scale], runs.EXPORT)
    assert sum(first[0].planned.values()) == 8 and value() == {k: k + 1 for k in range(8)}
    before = times()
    assert runs.run(spark, str(src), out, [scale], runs.RESUME)[0].planned == {} and times() == before
    put(2, 77)
    (tmp_path / "out" / "s0" / "3.shard").unlink()
    again = runs.run(spark, str(src), out, [scale], runs.RESUME)
    assert sum(again[0].planned.values()) == 4 and value() == {k: 77 if k == 2 else k + 1 for k in range(8)}
    assert {n for n, t in times().items() if before[n] == t} == {"0.shard", "2.shard"}
    row = {"chunk_x": 1, "chunk_y": 0, "chunk_z": 0, "labels": [1], "supervoxels": [1], shards.BLOCK_COLUMN: b"broken", "uncompressed_size": 9}
    (src / "8_0_0.arrow").write_bytes(shards.write_shard([row]))
    (src / "8_0_0.csv").unlink()
    for _ in range(2):
        assert runs.run(spark, str(src), out, [scale], runs.RESUME)[0].chunks_failed == 1


def test_filters_reach_source_shards(spark, tmp_path, monkeypatch):
    for k in range(3):
        source_shard(tmp_path, f"{k}_0_0", {(4 * k + i, i % 2, 0): np.full((8, 8, 8), i, np.uint64) for i in range(4)}, index=k < 2)
    opened, read = counted(monkeypatch, shards)
    where = lambda r: {(x["chunk_x"], x["chunk_y"]) for x in r}
    assert len(read_with(shards.ShardReader(str(tmp_path)), [])) == 12 and len(opened) == 3
    opened.clear()
    assert where(read_with(shards.ShardReader(str(tmp_path)), [EqualTo(("chunk_x",), 5)])) == {(5, 1)}
    assert len(opened) == 2 and len(read) == 2  # one indexed file, by its schema and one batch of four, and the file without an index
    opened.clear()
    assert len(read_with(shards.ShardReader(str(tmp_path)), [EqualTo(("shard",), "1_0_0")])) == 4 and len(opened) == 1
    assert shards.read_shards(spark, str(tmp_path)).where("chunk_x between 2 and 9 and chunk_y = 1").count() == 4


def test_scans_skip_bodies(tmp_path, monkeypatch):
    """A file beyond 2 GB (sparse) whose second batch has a huge body: a few hundred bytes a message are read."""
    cube = {(i, 0, 0): np.full((8, 8, 8), i, np.uint64) for i in range(3)}
    source_shard(tmp_path, "0_0_0", cube)
    data = (tmp_path / "0_0_0.arrow").read_bytes()
    schema, at = shards.scan_offsets(data)
    reader, messages = pa.BufferReader(data), []
    while True:
        try:
            m = pa.ipc.read_message(reader)
        except EOFError:
            break
        messages.append((m.type, reader.tell()))
    assert [t for t, _ in messages] == ["schema"] + ["record batch"] * 3 and [o + s for _, o, s in at] == [e for t, e in messages[1:]] and schema == messages[0][1]
    _, first, size = at[1]
    (n,) = struct.unpack_from("<i", data, first + 4)
    meta, body, huge = data[first : first + 8 + n], size - 8 - n, 3 << 30
    assert meta.count(struct.pack("<q", body)) >= 1
    k = meta.index(struct.pack("<q", body))
    with open(tmp_path / "big.arrow", "wb") as f:
        f.write(data[:first] + meta[:k] + struct.pack("<q", huge) + meta[k + 8 :])
        f.seek(first + 8 + n + huge)
        f.write(data[first + size :])
    opened, read = counted(monkeypatch, shards)
    found = shards.scan_offsets(shards.open_input(str(tmp_path / "big.arrow")))
    assert found == (schema, [at[0], (1, first, 8 + n + huge), (2, at[2][1] + huge - body, at[2][2])]) and sum(read) < 8000
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, pa.schema([("a", pa.int64())])) as w:
        w.write(pa.record_batch([pa.array([1, 2])], names=["a"]))
    schema, at = shards.scan_offsets(sink.getvalue().to_pybytes())
    assert schema > 8 and len(at) == 1 and shards.scan_offsets(b"") == (0, [])


def test_encoded_and_plain_chunks_agree(spark):
    """Decimation and votes on encoded pieces are those on voxels."""
    rng = np.random.default_rng(2)
    a, b = Scale("a", (29, 17, 21), (8, 8, 8)), Scale("b", (15, 9, 11), (8, 8, 8))
    cubes = {tuple(map(int, at)): rng.integers(0, 3, (8, 8, 8), dtype=np.uint64) for at in np.ndindex(4, 3, 6)}
    rows = [(*at, "s", [0, 1, 2], [0, 1, 2], bytearray(zstandard.ZstdCompressor().compress(codecs.encode_block(c)))) for at, c in cubes.items()]
    chunks = spark.createDataFrame(rows, "chunk_x int, chunk_y int, chunk_z int, shard string, labels array<long>, supervoxels array<long>, block binary")
    plain = codecs.decode(chunks, shape=(8, 8, 8))
    for z in (0, 1):
        pieces = chunked.encode_source(chunks, a, z_compress=z)
        got = chunked.decoded(chunked.put_together(chunked.pieces_of(pieces, a, z), a) if z else pieces.where("encoded is not null"), a)
        want = chunked.clip(chunked.decimate(plain, a, z), a)
        key = lambda df: {(r.chunk_x, r.chunk_y, r.chunk_z): bytes(r.voxels) for r in df.collect()}
        assert key(got) == key(want)
    halves = chunked.decoded(chunked.put_together(chunked.halved(chunked.encode_source(chunks, a).where("encoded is not null"), a, b), b), b)
    assert key(halves) == key(chunked.downsample(chunked.clip(plain, a), a, b))


@pytest.mark.parametrize("parts", ["1", "7"])
def test_running_sums(spark, parts):
    rng = np.random.default_rng(3)
    rows = [(int(k), None if k % 17 == 0 else int(k % 4), int(rng.integers(0, 50)), None if k % 13 == 0 else int(k)) for k in rng.permutation(400)]
    df = spark.createDataFrame(rows, "id long, part int, at int, w long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.id: (r.low, r.high) for r in ranks.running(df, ["at", "id"], [F.col("part")], "w").collect()}
        places = {r.id: r.low for r in ranks.running(df, ["at", "id"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    total, want = {}, {}
    for k, part, _, w in sorted(rows, key=lambda r: (r[2], r[0])):
        low = total.get(part, 0)
        total[part] = low + (w or 0)
        want[k] = (low, total[part])
    assert got == want and places == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    assert ranks.running(df.where("false"), ["at"], weight="w").count() == 0
