"""Sharded volume files: the on-disk form of an output volume, as a Spark source and a committed sink.

A volume is a folder with an ``info`` spec and a folder per scale, which holds one file per output shard.  A file begins
with the *shard index*: for each of its 2 ** minishard_bits minishards the byte range of that minishard's index.  A *minishard
index* is gzipped and holds three rows of unsigned 64-bit numbers, one column per chunk: the chunk's Morton code less the one
before, its offset less the end of the chunk before, and its size.  All ranges count from the end of the shard index.  A chunk
is a gzipped segmentation, cut at the volume's end.

``spark.read.format("sharded_volume")`` reads chunks as stored.  Filters on ``shard`` and ``chunk_x``, ``chunk_y``, ``chunk_z`` reach
the files: shards and minishards that lie outside are not opened, and of the others only the ranges of chunks inside are
read.  Large files are split by minishards.

Writing streams.  Index sizes follow from chunk sizes alone, so a first pass over the sizes gives every file its indexes, which
are put before the chunks; a task then holds one batch of chunks, whatever the size of a file.  Tasks write to a folder of
their own attempt; the driver moves finished files to their names when all tasks are done, so lost or repeated attempts and
failed jobs leave nothing that a reader sees.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, Filter, InputPartition, WriterCommitMessage

from lamellar.functions.geometry import Scale, minishard_number, morton, shard_number
from lamellar.session import ship

from .files import AXES, STAGING, Bounds, open_input, patiently, store
from .specs import SPEC_TYPE, parse_spec

SCHEMA = "shard long, chunk_x int, chunk_y int, chunk_z int, encoded binary"
#: Bytes of a file that one split covers, of a read at once, and of a gap that a read runs over.
SPLIT_BYTES, READ_BYTES, GAP_BYTES = 64 << 20, 8 << 20, 64 << 10


class VolumeError(ValueError):
    """A volume or shard file without the format's parts."""


# --- the format -------------------------------------------------------------------------------------------


def file_name(number: int, bits: int) -> str:
    return f"{number:0{max(1, -(-bits // 4))}x}.shard"


def codes_at(scale: Scale, codes: np.ndarray) -> np.ndarray:
    """Chunk coordinates (3 x n) of Morton codes."""
    out = np.zeros((3, len(codes)), np.int64)
    for place, (axis, level) in enumerate(scale.plan):
        out[axis] |= (codes >> place & 1) << level
    return out


def code_of(scale: Scale, at: tuple[int, int, int]) -> int:
    return sum((at[axis] >> level & 1) << place for place, (axis, level) in enumerate(scale.plan))


def minishard_index(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    """The stored index of chunks in ascending order of codes."""
    ends = np.r_[0, (starts + sizes)[:-1]]
    return gzip.compress(np.stack([np.diff(codes, prepend=0), starts - ends, sizes]).astype("<u8").tobytes(), mtime=0)


def parse_minishard(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, starts, sizes) of a stored minishard index; ``raw`` ones are not gzipped."""
    plain = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    if len(plain) % 24:
        raise VolumeError(f"a minishard index of {len(plain)} bytes")
    deltas, gaps, sizes = np.frombuffer(plain, "<u8").reshape(3, -1).astype(np.int64)
    return np.cumsum(deltas), np.cumsum(gaps) + np.cumsum(sizes) - sizes, sizes


def head(minishards: np.ndarray, codes: np.ndarray, sizes: np.ndarray, bits: int) -> bytes:
    """Shard index and minishard indexes of a file whose chunks follow them, ordered by minishard and code.

    The indexes' own sizes depend on the offsets they hold, which depend on the indexes' sizes: only the first chunk's
    offset of each minishard does, so the indexes are made again, from the sizes found, until these no longer change.
    """
    cuts = np.flatnonzero(np.diff(minishards, prepend=-1)) if len(codes) else np.zeros(0, np.int64)
    ends = np.r_[cuts[1:], len(codes)].astype(np.int64)
    before = np.cumsum(sizes) - sizes
    room = 0
    while True:
        made = [minishard_index(codes[a:b], before[a:b] + room, sizes[a:b]) for a, b in zip(cuts, ends, strict=True)]
        total = sum(map(len, made))
        if total <= room:
            break
        room = total
    index = np.zeros((1 << bits, 2), "<u8")
    at = 0
    for k, data in zip(minishards[cuts], made, strict=True):
        index[k] = at, at + len(data)
        at += len(data)
    return index.tobytes() + b"".join(made) + bytes(room - at)  # readers go by the ranges, not by the gap


# --- reading ----------------------------------------------------------------------------------------------


def shard_meets(scale: Scale, number: int, bounds: Bounds) -> bool:
    if bounds.shards is not None and number not in bounds.shards:
        return False
    return bounds.meet(codes_at(scale, np.array([number << scale.low]))[:, 0], scale.shard_shape)


def _ranges(f, base: int, starts: np.ndarray, sizes: np.ndarray) -> Iterator[bytes]:
    """The bytes of ascending ranges; neighbours, and those with small gaps between, travel together."""
    i = 0
    while i < len(starts):
        j = i + 1
        while j < len(starts) and 0 <= starts[j] - starts[j - 1] - sizes[j - 1] <= GAP_BYTES and starts[j] + sizes[j] - starts[i] <= READ_BYTES:
            j += 1
        first, last = int(starts[i]), int(starts[j - 1] + sizes[j - 1])
        data = patiently(lambda a=first, b=last: f.read_at(b - a, base + a)) if last > first else b""
        if len(data) != last - first:
            raise VolumeError("a range lies beyond the file's end")
        for k in range(i, j):
            yield data[starts[k] - first : starts[k] - first + sizes[k]]
        i = j


def read_file(path: str, scale: Scale, bounds: Bounds | None = None, first: int = 0, last: int | None = None) -> Iterator[pa.RecordBatch]:
    """Chunks of one shard file that lie within the bounds, of its minishards first to last (exclusive)."""
    bounds = bounds or Bounds()
    number, base = int(path.rsplit("/", 1)[-1].removesuffix(".shard"), 16), 16 << scale.minishard
    with open_input(path) as f:
        raw = f.read_at(base, 0)
        if len(raw) != base:
            raise VolumeError(f"{path}: {len(raw)} bytes of a shard index of {base}")
        index = np.frombuffer(raw, "<u8").reshape(-1, 2).astype(np.int64)
        numbers = np.arange(len(index))
        origins = codes_at(scale, number << scale.low | numbers << scale.preshift)
        wanted = [k for k in range(first, len(index) if last is None else last) if index[k, 1] > index[k, 0] and bounds.meet(origins[:, k], scale.minishard_shape)]
        wanted = np.array(sorted(wanted, key=lambda k: index[k, 0]), np.int64)
        for data in _ranges(f, base, index[wanted, 0], index[wanted, 1] - index[wanted, 0]):
            codes, starts, sizes = parse_minishard(data)
            at = codes_at(scale, codes)
            keep = np.flatnonzero(bounds.inside(at))
            for a in range(0, len(keep), 64):
                own = keep[a : a + 64]
                chunks = list(_ranges(f, base, starts[own], sizes[own]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), number)), *(pa.array(at[k, own], pa.int32()) for k in range(3)), pa.array(chunks, pa.binary())], names=["shard", *AXES, "encoded"])


def scales_at(path: str) -> list[Scale]:
    """The scales of a volume's ``info``; none if it has none."""
    fs, root = store(path)
    if fs.get_file_info(f"{root}/info").type != FileType.File:
        return []
    with fs.open_input_file(f"{root}/info") as f:
        return parse_spec(f.read())


def scale_at(path: str, level: int) -> Scale:
    scales = scales_at(path)
    if level >= len(scales):
        raise VolumeError(f"{path}: no scale {level} in its info")
    return scales[level]


@dataclass
class _Split(InputPartition):
    path: str
    first: int = 0
    last: int | None = None


class ShardedVolume(DataSource):
    """Options: path, level (0); written only through :func:`write_volume`, which orders the rows."""

    @classmethod
    def name(cls) -> str:
        return "sharded_volume"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return VolumeReader(self.options["path"], scale_at(self.options["path"], int(self.options.get("level", "0"))))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return VolumeWriter(self.options["path"], self.options["key"], int(self.options["shard"]), int(self.options["minishard"]))


class VolumeReader(DataSourceReader):
    def __init__(self, path: str, scale: Scale):
        self.path, self.scale, self.bounds = path, scale, Bounds()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            self.bounds.take(f)
            yield f  # bounds are a box: Spark still applies every filter

    def partitions(self) -> list[InputPartition]:
        fs, root = store(self.path)
        found = fs.get_file_info(FileSelector(f"{root}/{self.scale.key}", allow_not_found=True))
        files = sorted((f.path, f.size) for f in found if f.type == FileType.File and f.path.endswith(".shard"))
        out, minishards = [], 1 << self.scale.minishard
        prefix = self.path.split("://")[0] + "://" if "://" in self.path else ""
        for path, size in files:
            if not shard_meets(self.scale, int(path.rsplit("/", 1)[-1].removesuffix(".shard"), 16), self.bounds):
                continue
            parts = min(minishards, -(-size // SPLIT_BYTES))
            where = f"{prefix}{path}"
            out += [_Split(where, minishards * k // parts, minishards * (k + 1) // parts) for k in range(parts)]
        return out or [_Split("")]

    def read(self, partition: _Split) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from read_file(partition.path, self.scale, self.bounds, partition.first, partition.last)


def read_volume(spark: SparkSession, path: str, level: int = 0) -> DataFrame:
    """Chunks of a scale as stored: shard, chunk_x, chunk_y, chunk_z, encoded.  Filters on all but the last prune what is read."""
    register(spark)
    return spark.read.format("sharded_volume").option("level", level).load(path)


def volume_files(spark: SparkSession, path: str, level: int = 0) -> DataFrame:
    """shard, file, bytes and path of a scale's files, from file metadata alone."""
    scale = scale_at(path, level)
    fs, root = store(path)
    if fs.get_file_info(f"{root}/{scale.key}").type == FileType.NotFound:
        return spark.createDataFrame([], "shard long, file string, bytes long, path string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.shard").load(f"{path}/{scale.key}")
    name = F.regexp_extract("path", r"([0-9a-f]+)\.shard$", 1)
    return files.select(F.conv(name, 16, 10).cast("long").alias("shard"), F.concat(name, F.lit(".shard")).alias("file"), F.col("length").alias("bytes"), "path")


def read_files(files: DataFrame, scale: Scale) -> DataFrame:
    """Chunks of the files (path) that a table lists, as when finished ones have been left out; others are never opened."""
    ship(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                yield from read_file(path, scale)

    return files.select("path").repartition("path").mapInArrow(run, SCHEMA)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(ShardedVolume)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# --- writing ----------------------------------------------------------------------------------------------


@dataclass
class _Done(WriterCommitMessage):
    files: list[tuple[str, str]]  # staged, name


class VolumeWriter(DataSourceArrowWriter):
    """Rows come by file: one with the list of the file's chunks and their sizes, then the chunks in that order."""

    def __init__(self, path: str, key: str, shard_bits: int, minishard_bits: int):
        self.path, self.key, self.shard_bits, self.minishard_bits = path, key, shard_bits, minishard_bits
        self.job = uuid.uuid4().hex

    @property
    def _folder(self) -> tuple[FileSystem, str, str]:
        fs, root = store(self.path)
        return fs, f"{root}/{self.key}", f"{root}/{STAGING}/{self.job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, _, staging = self._folder
        own, files = f"{staging}/{uuid.uuid4().hex}", []
        fs.create_dir(own, recursive=True)
        out, expected, at, last = None, [], 0, None

        def close() -> None:
            if out is not None:
                out.close()
                if at != len(expected):
                    raise VolumeError(f"{len(expected) - at} chunks of {files[-1][1]} did not come")

        try:
            for b in batches:
                for number, k, code, size, data, entries in zip(*(b.column(c) for c in ("file_shard", "minishard", "code", "bytes", "encoded", "entries")), strict=True):
                    if entries.is_valid:
                        close()
                        expected = [(e["minishard"], e["code"], e["bytes"]) for e in entries.as_py()]
                        name, at, last = file_name(number.as_py(), self.shard_bits), 0, None
                        files.append((f"{own}/{name}", name))
                        out = fs.open_output_stream(files[-1][0], compression=None)
                        out.write(head(*np.array(expected, np.int64).reshape(-1, 3).T, self.minishard_bits))
                        continue
                    row = (k.as_py(), code.as_py(), size.as_py())
                    if row[:2] == last:
                        continue  # a repeated chunk: the smallest one is there
                    if at == len(expected) or row != expected[at]:
                        raise VolumeError(f"chunk {row} is not the one expected")
                    out.write(data.as_buffer())
                    at, last = at + 1, row[:2]
            close()
            out = None
        finally:
            if out is not None:
                out.close()
        return _Done(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, folder, staging = self._folder
        fs.create_dir(folder, recursive=True)
        for m in messages:
            for staged, name in m.files if m else []:
                fs.move(staged, f"{folder}/{name}")
        self._clear(fs, staging)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, _, staging = self._folder
        self._clear(fs, staging)

    @staticmethod
    def _clear(fs: FileSystem, staging: str) -> None:
        if fs.get_file_info(staging).type == FileType.Directory:
            fs.delete_dir(staging)
        above = staging.rsplit("/", 1)[0]
        if not fs.get_file_info(FileSelector(above, allow_not_found=True)) and fs.get_file_info(above).type == FileType.Directory:
            fs.delete_dir(above)


def ordered(chunks: DataFrame, scale: Scale) -> DataFrame:
    """Chunks (chunk_x.., encoded) as rows of the sink: a file's list of sizes first, then its chunks by minishard and code."""
    code = morton(scale, *(F.col(a) for a in AXES))
    rows = chunks.select(code.alias("code"), F.octet_length("encoded").cast("long").alias("bytes"), "encoded")
    rows = rows.select(shard_number(scale, F.col("code")).alias("file_shard"), minishard_number(scale, F.col("code")).alias("minishard"), "code", "bytes", "encoded")
    each = rows.groupBy("file_shard", "minishard", "code").agg(F.min("bytes").alias("bytes"))
    heads = each.groupBy("file_shard").agg(F.sort_array(F.collect_list(F.struct("minishard", "code", "bytes"))).alias("entries"))
    none = lambda t: F.lit(None).cast(t)
    heads = heads.select("file_shard", F.lit(-1).cast("long").alias("minishard"), F.lit(-1).cast("long").alias("code"), F.lit(0).cast("long").alias("bytes"), none("binary").alias("encoded"), "entries")
    whole = rows.withColumn("entries", none(heads.schema["entries"].dataType)).unionByName(heads)
    return whole.repartition("file_shard").sortWithinPartitions("file_shard", "minishard", "code", "bytes")


def write_volume(chunks: DataFrame, path: str, scale: Scale, level: int = 0) -> None:
    """Write encoded chunks (a stored table, as it is read twice) as shard files of a scale, all at once when all are there.

    Files of shards that are written again are replaced, others stay.  Of repeated chunks the smallest stays.  The scale's
    entry in ``info`` is made or replaced; scales are written in order.
    """
    scale.shard_shape  # noqa: B018  refuses a sharding that the grid's bits exceed
    register(chunks.sparkSession)
    write_info(path, scale, level)
    ordered(chunks, scale).write.format("sharded_volume").mode("append").options(key=scale.key, shard=scale.shard, minishard=scale.minishard).save(path)


def write_info(path: str, scale: Scale, level: int) -> None:
    """Put a scale into a volume's ``info``."""
    fs, root = store(path)
    text = {"@type": SPEC_TYPE, "type": "segmentation", "data_type": "uint64", "num_channels": 1, "scales": []}
    if scales_at(path):
        with fs.open_input_file(f"{root}/info") as f:
            text = json.loads(f.read())
    if level > len(text["scales"]):
        raise VolumeError(f"scale {level} before scale {len(text['scales'])}")
    sharding = {"@type": "neuroglancer_uint64_sharded_v1", "preshift_bits": scale.preshift, "hash": "identity", "minishard_bits": scale.minishard, "shard_bits": scale.shard, "minishard_index_encoding": "gzip", "data_encoding": "gzip"}
    own = {"key": scale.key, "size": list(scale.size), "chunk_sizes": [list(scale.chunk)], "resolution": [2**level] * 3, "voxel_offset": [0, 0, 0], "encoding": "compressed_segmentation", "compressed_segmentation_block_size": [8, 8, 8], "sharding": sharding}
    if level < len(text["scales"]):
        own = text["scales"][level] | own if text["scales"][level]["key"] == scale.key else own
    text["scales"][level : level + 1] = [own]
    fs.create_dir(root, recursive=True)
    staged = f"{root}/info.{uuid.uuid4().hex}"
    with fs.open_output_stream(staged, compression=None) as f:
        f.write(json.dumps(text, indent=1).encode())
    fs.move(staged, f"{root}/info")
