"""Arrow IPC shards as a Spark source.

``spark.read.format("label_shards")`` reads files with one row per chunk.  A file is an IPC *file* or *stream*.
Unsigned columns come as int64 bit patterns, since Spark has no unsigned types.  With an index (a CSV of byte
ranges) files are read by batch ranges: a job over the indexes plans them, neighbouring ranges travel together up to
``SPLIT_BYTES``, and an index filtered by chunk coordinates leaves only the ranges that hold them.
"""

from __future__ import annotations

import io
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc as ipc
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, InputPartition

from .files import AXES, Bounds, ShardError, open_input, patiently, store

SCHEMA = "shard string, chunk_x int, chunk_y int, chunk_z int, labels array<long>, supervoxels array<long>, block binary, uncompressed_size long"
#: Fixed value: the block column's name in the files.
BLOCK_COLUMN = "dvid_compressed_block"
REQUIRED = ("chunk_x", "chunk_y", "chunk_z", "labels", "supervoxels", BLOCK_COLUMN, "uncompressed_size")
#: Bytes of a file that one planned split covers; a whole multiple of batches is read at once.
SPLIT_BYTES = 64 << 20
#: Message kinds of the Arrow format.
_SCHEMA, _RECORD_BATCH = 1, 3
INDEX_COLUMNS = {"new": ("x", "y", "z", "offset", "size", "batch_idx"), "old": ("x", "y", "z", "rec")}


class ChunkNotFound(ShardError):
    """No chunk at the coordinates asked for."""


def open_table(data: bytes) -> pa.Table:
    """All batches of an IPC file or, failing that, stream."""
    try:
        return ipc.open_file(pa.BufferReader(data)).read_all()
    except pa.ArrowInvalid:
        try:
            return ipc.open_stream(pa.BufferReader(data)).read_all()
        except pa.ArrowInvalid as e:
            raise ShardError(f"neither an Arrow file nor a stream: {e}") from e


def _signed(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """64-bit patterns kept, smaller unsigned numbers widened."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks) if a.num_chunks else pa.array([], a.type)
    if pa.types.is_list(a.type):
        values = a.values.view(pa.int64()) if a.type.value_type == pa.uint64() else pc.cast(a.values, pa.int64())
        return pa.ListArray.from_arrays(a.offsets, values)
    return a.view(pa.int64()) if a.type == pa.uint64() else pc.cast(a, pa.int64()) if a.type == pa.uint32() else a


def to_batches(table: pa.Table, shard: str) -> Iterator[pa.RecordBatch]:
    """Rows in the source's schema, few per batch because blocks are large."""
    missing = set(REQUIRED) - set(table.column_names)
    if missing:
        raise ShardError(f"{shard}: columns {sorted(missing)} are missing")
    names = ("chunk_x", "chunk_y", "chunk_z", "labels", "supervoxels", "block", "uncompressed_size")
    arrays = [_signed(table[c]) for c in REQUIRED]
    arrays = [pc.cast(a, pa.int32()) if k < 3 else a for k, a in enumerate(arrays)]
    whole = pa.table([pa.array([shard] * len(table)), *arrays], names=["shard", *names])
    yield from whole.to_batches(max_chunksize=64)


def _message(metadata: bytes) -> tuple[int, int]:
    """(kind of header, body's length) of a message's metadata: two fields of its flatbuffer table."""
    (root,) = struct.unpack_from("<I", metadata)
    fields = root - struct.unpack_from("<i", metadata, root)[0]
    length = struct.unpack_from("<H", metadata, fields)[0]
    at = lambda slot: struct.unpack_from("<H", metadata, fields + 4 + 2 * slot)[0] if 4 + 2 * slot < length else 0
    kind, body = at(1), at(3)
    return metadata[root + kind] if kind else 0, struct.unpack_from("<q", metadata, root + body)[0] if body else 0


def scan_offsets(source: bytes | pa.NativeFile) -> tuple[int, list[tuple[int, int, int]]]:
    """Schema size, and (batch, offset, size) of each record batch of an IPC stream or file.

    Of every message only the length and the metadata are read; bodies are skipped by their length.
    """
    f = pa.BufferReader(source) if isinstance(source, bytes) else source
    size, schema, out = f.size(), 0, []
    at = 8 if f.read_at(6, 0) == b"ARROW1" else 0
    while at + 8 <= size:
        mark, n = struct.unpack("<Ii", f.read_at(8, at))
        prefix = 8
        if mark != 0xFFFFFFFF:  # written before the format had a continuation mark
            prefix, n = 4, mark
        if n <= 0 or at + prefix + n > size:
            break
        kind, body = _message(f.read_at(n, at + prefix))
        whole = prefix + n + body
        if at + whole > size:
            break
        if kind == _SCHEMA:
            schema = at + whole
        elif kind == _RECORD_BATCH:
            out.append((len(out), at, whole))
        at += whole
    return schema, out


def stream_batches(f: pa.NativeFile) -> Iterator[pa.RecordBatch]:
    """Batches of an IPC file or, failing that, stream, one at a time."""
    try:
        reader = ipc.open_file(f)
    except pa.ArrowInvalid:
        f.seek(0)
        try:
            reader = ipc.open_stream(f)
        except pa.ArrowInvalid as e:
            raise ShardError(f"neither an Arrow file nor a stream: {e}") from e
        yield from reader
        return
    for k in range(reader.num_record_batches):
        yield reader.get_batch(k)


def parse_index(data: bytes) -> tuple[dict[tuple[int, int, int], tuple[int, int, int]], int]:
    """Chunk -> (offset, size, batch) and the schema's size; old indexes have offset and size -1 and a schema size only if stated."""
    lines = data.decode().splitlines()
    stated = [int(x.partition("=")[2]) for x in lines if re.match("# schema_size=", x)]
    rows = [x.split(",") for x in lines if x and not x.startswith("#")]
    header = [c.strip() for c in rows[0]] if rows else []
    form = next((k for k, own in INDEX_COLUMNS.items() if set(own) <= set(header)), None)
    if form is None:
        raise ShardError(f"index columns {header} are neither {INDEX_COLUMNS['new']} nor {INDEX_COLUMNS['old']}")
    at = {c: header.index(c) for c in INDEX_COLUMNS[form]}
    value = lambda r, c: int(r[at[c]])
    where = (lambda r: (value(r, "offset"), value(r, "size"), value(r, "batch_idx"))) if form == "new" else (lambda r: (-1, -1, value(r, "rec")))
    return {(value(r, "x"), value(r, "y"), value(r, "z")): where(r) for r in rows[1:]}, stated[0] if stated else 0


def _index_rows(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    facts = lines.groupBy("path").agg(F.max(F.when(F.col("value").rlike("^x,y,z,"), F.col("value"))).alias("header"), F.max(F.regexp_extract("value", r"^# schema_size=(\d+)", 1).try_cast("long")).alias("schema_size"))
    rows = lines.where(F.col("value").rlike(r"^\d")).withColumn("v", F.split("value", ","))
    rows = rows.join(facts, "path").withColumn("h", F.split("header", ","))
    get = lambda c, default: F.coalesce(F.get("v", F.array_position("h", c).cast("int") - 1).cast("long"), F.lit(default))
    new = F.array_contains("h", "batch_idx") & F.array_contains("h", "offset") & F.array_contains("h", "size")
    first = [F.get("v", F.lit(k)).cast("long").alias(a) for k, a in enumerate("xyz")]
    return rows.select(
        "path", F.regexp_extract("path", r"([^/]+)\.csv$", 1).alias("shard"), *first, F.when(new, get("offset", -1)).otherwise(-1).alias("offset"), F.when(new, get("size", -1)).otherwise(-1).alias("size"),
        F.when(new, get("batch_idx", -1)).otherwise(get("rec", -1)).alias("batch_idx"), F.coalesce("schema_size", F.lit(0)).alias("schema_size"),
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index CSVs under a path as rows: shard, x, y, z, offset, size, batch_idx (offset and size -1 in old ones)."""
    return _index_rows(spark, path).drop("path", "schema_size")


def list_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shard files under ``path``: scale (of a directory "s0"), shard, bytes, from file metadata alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.arrow").load(path)
    return files.select(F.regexp_extract("path", r"/s(\d+)/[^/]+$", 1).try_cast("int").alias("scale"), F.regexp_extract("path", r"([^/]+)\.arrow$", 1).alias("shard"), F.col("length").alias("bytes"), F.col("path"))


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """file, bytes and path of everything under ``path`` that a pattern names, from file metadata alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), "path")


def list_outputs(spark: SparkSession, path: str) -> DataFrame:
    """Output shard files: file, number, bytes."""
    return list_files(spark, path, "*.shard").select("file", F.conv(F.regexp_extract("file", r"^([0-9a-f]+)\.", 1), 16, 10).cast("long").alias("number"), "bytes")


def list_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Label profiles "{shard}-labels.csv": shard and bytes."""
    return list_files(spark, path, "*-labels.csv").select(F.regexp_extract("file", r"^(.*)-labels\.csv$", 1).alias("shard"), "bytes")


def list_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Partial predictions "{shard}-*predicted*.csv" of parents: file and bytes."""
    return list_files(spark, path, "*predicted*.csv").select("file", "bytes")


def estimated_chunks(index_bytes) -> object:
    """Rows of an index guessed from its size (15 bytes a row, less a header, at least 0)."""
    return F.greatest(F.lit(0), F.floor(index_bytes / 15) - 1)


@dataclass
class _Split(InputPartition):
    path: str


class LabelShards(DataSource):
    """Option: path (file or directory).  A file is a partition, read batch by batch.

    Filters on ``shard`` choose the files.  Those on ``chunk_x``, ``chunk_y``, ``chunk_z`` choose, by the index beside a file, the
    batches whose ranges are read; without one, batches are still looked through one at a time, and rows outside go at once.
    """

    @classmethod
    def name(cls) -> str:
        return "label_shards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ShardReader(self.options["path"])


class ShardReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.bounds = path, Bounds()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            self.bounds.take(f)
            yield f  # bounds are a box and batches come whole: Spark still applies every filter

    def partitions(self) -> list[InputPartition]:
        fs, root = store(self.path)
        found = [fs.get_file_info(root)]
        if found[0].type == FileType.NotFound:
            raise FileNotFoundError(self.path)
        if found[0].type == FileType.Directory:
            found = fs.get_file_info(FileSelector(root, recursive=True))
        prefix = self.path.split("://")[0] + "://" if "://" in self.path else ""
        files = sorted(f.path for f in found if f.type == FileType.File and f.path.endswith(".arrow"))
        if self.bounds.shards is not None:
            files = [f for f in files if _shard_of(f) in self.bounds.shards]
        return [_Split(f"{prefix}{f}") for f in files] or [_Split("")]

    def read(self, partition: _Split) -> Iterator[pa.RecordBatch]:
        path = partition.path
        if not path:
            return
        for batch in self._batches(path):
            for rows in to_batches(pa.Table.from_batches([batch]), _shard_of(path)):
                at = np.stack([rows.column(c).to_numpy() for c in AXES])
                keep = self.bounds.inside(at)
                if keep.any():
                    yield rows if keep.all() else rows.filter(pa.array(keep))

    def _batches(self, path: str) -> Iterator[pa.RecordBatch]:
        ranges = None if self.bounds.everywhere else self._ranges(path)
        if ranges is None:
            with open_input(path) as f:
                yield from stream_batches(f)
            return
        schema_size, own = ranges
        if not own:
            return
        with open_input(path) as f:
            head = patiently(lambda: f.read_at(schema_size, 0))
            for offset, size in own:
                data = patiently(lambda a=offset, n=size: f.read_at(n, a))
                yield from stream_batches(pa.BufferReader(head + data))

    def _ranges(self, path: str) -> tuple[int, list[tuple[int, int]]] | None:
        """The ranges of batches that hold chunks inside the bounds; None without an index that knows them."""
        fs, name = store(path.removesuffix(".arrow") + ".csv")
        if fs.get_file_info(name).type != FileType.File:
            return None
        with fs.open_input_file(name) as f:
            entries, schema_size = parse_index(f.read())
        if not schema_size or any(offset < 0 for offset, _, _ in entries.values()):
            return None
        at = np.array(list(entries), np.int64).reshape(-1, 3).T
        where = list(entries.values())
        return schema_size, sorted({where[k][:2] for k in np.flatnonzero(self.bounds.inside(at))})


def _shard_of(path: str) -> str:
    return path.rsplit("/", 1)[-1].removesuffix(".arrow")


def register(spark: SparkSession) -> None:
    from lamellar.session import ship

    ship(spark)
    spark.dataSource.register(LabelShards)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_shards(spark: SparkSession, path: str, indexed: bool = False) -> DataFrame:
    """Chunks of the shards under a path; ``indexed``: by the byte ranges of the CSV beside each file."""
    if indexed:
        return read_ranges(spark, index_entries(spark, path))
    register(spark)
    return spark.read.format("label_shards").load(path)


def index_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the indexes under a path with the file they are of: path, x, y, z, offset, size, schema_size.

    Entries of old indexes, which know no ranges, have offset and size -1.
    """
    rows = _index_rows(spark, path)
    known = (F.col("offset") >= 0) & (F.col("schema_size") > 0)
    of = F.regexp_replace("path", r"\.csv$", ".arrow").alias("path")
    return rows.select(of, "shard", "x", "y", "z", F.when(known, F.col("offset")).otherwise(-1).alias("offset"), F.when(known, F.col("size")).otherwise(-1).alias("size"), "schema_size")


def source_entries(spark: SparkSession, path: str) -> DataFrame:
    """:func:`index_entries` of every shard file under a path; files without an index have one entry of unknown range."""
    files = list_shards(spark, path).select("path", "shard")
    known = index_entries(spark, path).drop("path")
    unknown = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("offset", "size")]
    return files.join(known, "shard", "left").select("path", "shard", "x", "y", "z", *unknown, F.coalesce("schema_size", F.lit(0)).alias("schema_size"))


def read_ranges(spark: SparkSession, entries: DataFrame, apart: bool = False) -> DataFrame:
    """Chunks of the batches that index entries (see :func:`index_entries`, perhaps filtered) name.

    Ranges are gathered by stretches of a file, so a task reads neighbouring batches at once, and none the whole file
    unless its index knows no ranges.  A batch comes whole, with chunks that no entry names.  ``apart``: every range is read
    by itself, and its ``offset`` is one more column.
    """
    from lamellar.session import ship

    ship(spark)
    ranges = entries.select("path", "offset", "size", "schema_size").distinct()
    stretch = F.expr(f"offset div {SPLIT_BYTES}")
    splits = ranges.groupBy("path", "schema_size", stretch.alias("stretch")).agg(F.sort_array(F.collect_set(F.struct("offset", "size"))).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, schema_size, ranges_ in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                for own in [[r] for r in ranges_] if apart else [ranges_]:
                    for table in _tables(path, schema_size, own):
                        for rows in to_batches(table, _shard_of(path)):
                            yield rows.append_column("offset", pa.array([own[0]["offset"]] * len(rows), pa.int64())) if apart else rows

    return splits.select("path", "schema_size", "ranges").mapInArrow(run, f"{SCHEMA}, offset long" if apart else SCHEMA)


def _tables(path: str, schema_size: int, ranges: list[dict]) -> Iterator[pa.Table]:
    """The schema and the ranges of a stream, neighbouring ones in one read; for an unknown range the file, batch by batch."""
    with open_input(path) as f:
        if ranges[0]["offset"] < 0:
            yield from (pa.Table.from_batches([b]) for b in stream_batches(f))
            return
        parts, at = [patiently(lambda: f.read_at(schema_size, 0))], None
        for r in ranges:
            if at and at[1] == r["offset"]:
                at[1] += r["size"]
            else:
                if at:
                    parts.append(patiently(lambda a=at: f.read_at(a[1] - a[0], a[0])))
                at = [r["offset"], r["offset"] + r["size"]]
        parts.append(patiently(lambda a=at: f.read_at(a[1] - a[0], a[0])))
    yield open_table(b"".join(parts))


def read_chunk(chunks: DataFrame, x: int, y: int, z: int) -> DataFrame:
    """The chunk at integer, non-negative coordinates."""
    if not all(isinstance(v, int) and not isinstance(v, bool) and v >= 0 for v in (x, y, z)):
        raise ValueError("chunk coordinates are integers of at least 0")
    return chunks.where((F.col("chunk_x") == x) & (F.col("chunk_y") == y) & (F.col("chunk_z") == z))


def find_chunk(spark: SparkSession, path: str, x: int, y: int, z: int) -> DataFrame:
    """The chunk at these coordinates of the indexed shards under a path; only the batches that hold it are read."""
    entries = index_entries(spark, path).where((F.col("x") == x) & (F.col("y") == y) & (F.col("z") == z))
    return read_chunk(read_ranges(spark, entries), x, y, z)


def chunk_info(chunks: DataFrame) -> DataFrame:
    """List and byte sizes of chunks; blocks are only measured."""
    return chunks.select("chunk_x", "chunk_y", "chunk_z", F.size("labels").alias("num_labels"), F.size("supervoxels").alias("num_supervoxels"), F.octet_length("block").alias("compressed_size"), "uncompressed_size")


def indexed_chunks(index: DataFrame, chunks: DataFrame) -> DataFrame:
    """Index rows with their chunks, the index deciding what exists; rows only in the file go unseen.

    ``index``: shard, x, y, z.  Of repeated chunk rows one stays.
    """
    own = chunks.dropDuplicates(["shard", "chunk_x", "chunk_y", "chunk_z"]).withColumnRenamed("shard", "__shard")
    on = F.col("shard") == F.col("__shard")
    for a in "xyz":
        on = on & (F.col(a) == F.col(f"chunk_{a}"))
    return index.join(own, on).drop("__shard")


def missing_chunks(index: DataFrame, chunks: DataFrame) -> DataFrame:
    """Index rows without a chunk."""
    own = chunks.select(F.col("shard"), *(F.col(f"chunk_{a}").cast("long").alias(a) for a in "xyz"))
    return index.join(own, ["shard", "x", "y", "z"], "left_anti")


def batch_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(shard, schema_size, batch_idx, offset, size) of every batch of the shard files under a path; bodies are never read."""
    from lamellar.session import ship

    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                with open_input(path) as f:
                    schema, rows = scan_offsets(f)
                if rows:
                    k, o, s = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([_shard_of(path)] * len(rows)), pa.array([schema] * len(rows), pa.int64()), pa.array(k, pa.int64()), pa.array(o, pa.int64()), pa.array(s, pa.int64())], names=["shard", "schema_size", "batch_idx", "offset", "size"])

    files = list_shards(spark, path).select("path").repartition("path")
    return files.mapInArrow(run, "shard string, schema_size long, batch_idx long, offset long, size long")


def with_offsets(index: DataFrame, offsets: DataFrame) -> DataFrame:
    """An old index with its batches' byte ranges: records are batch ordinals; unmatched ones go."""
    return index.select("shard", "x", "y", "z", "batch_idx").join(offsets, ["shard", "batch_idx"]).select("shard", "x", "y", "z", "offset", "size", "batch_idx", "schema_size")


def write_shards(chunks: DataFrame, folder: str, batch_size: int = 1, ranges: bool = True) -> DataFrame:
    """Write chunk rows (shard, chunk_x.., labels, supervoxels, block, uncompressed_size) as source shards.

    A file per shard, an IPC stream of ``batch_size`` chunks a batch in z, y, x order, and its index beside it, with byte
    ranges or, without ``ranges``, in the old form.  A shard is one task's, as a source shard is one file.  Returns shard,
    chunks and bytes; the files are there once that is computed, and a repeated task writes the same.
    """
    from lamellar.session import ship

    ship(chunks.sparkSession)

    def put(key: tuple, rows: pa.Table) -> pa.Table:
        name = key[0].as_py()
        own = sorted(rows.to_pylist(), key=lambda r: (r["chunk_z"], r["chunk_y"], r["chunk_x"]))
        unsigned = lambda v: [x + (1 << 64) if x < 0 else x for x in v]
        data = write_shard([{**{k: r[k] for k in ("chunk_x", "chunk_y", "chunk_z", "uncompressed_size")}, "labels": unsigned(r["labels"]), "supervoxels": unsigned(r["supervoxels"]), BLOCK_COLUMN: r["block"]} for r in own], batch_size)
        schema_size, at = scan_offsets(data)
        lines = [f"# schema_size={schema_size}"] if ranges else []
        lines.append("x,y,z,offset,size,batch_idx" if ranges else "x,y,z,rec")
        for i, r in enumerate(own):
            k, offset, size = at[i // batch_size]
            lines.append(",".join(map(str, (r["chunk_x"], r["chunk_y"], r["chunk_z"], *((offset, size, k) if ranges else (k,))))))
        fs, root = FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        fs.create_dir(root, recursive=True)
        for suffix, content in (("arrow", data), ("csv", ("\n".join(lines) + "\n").encode())):
            with fs.open_output_stream(f"{root}/{name}.{suffix}", compression=None) as f:
                f.write(content)
        return pa.table({"shard": pa.array([name]), "chunks": pa.array([len(own)], pa.int64()), "bytes": pa.array([len(data)], pa.int64())})

    return chunks.groupBy("shard").applyInArrow(put, "shard string, chunks long, bytes long")


def write_offsets(spark: SparkSession, source: str, out: str) -> DataFrame:
    """Byte ranges of every chunk of the old-style indexed streams under ``source``, by shard, under ``out``.

    Shards that ``out`` has already are left alone, so a repeated run does what is missing.  Returns the work done:
    shard, status ("ok" or "exists").
    """
    from lamellar.session import materialize

    shards = list_shards(spark, source).select("shard")
    # The folder lists what is done; a first run finds none.
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = list_files(spark, out, "*.csv").select(F.regexp_extract("path", r"/shard=([^/]+)/", 1).alias("shard")).distinct() if fs.exists(path) else shards.limit(0)
    state = done.select("shard", F.lit(True).alias("there"))
    status = materialize(shards.join(state, "shard", "left").select("shard", F.when(F.col("there"), "exists").otherwise("ok").alias("status")), "offsets-status")
    found = with_offsets(read_index(spark, source), batch_offsets(spark, source)).join(status.where("status = 'ok'"), "shard", "left_semi")
    found.repartition("shard").sortWithinPartitions("shard", "batch_idx").write.mode("append").partitionBy("shard").option("header", True).csv(out)
    return status


def write_shard(rows: list[dict], batch_size: int = 1) -> bytes:
    """An IPC stream of chunk rows (for tests and small exports)."""
    schema = pa.schema([*(pa.field(f"chunk_{a}", pa.int32(), False) for a in "xyz"), pa.field("labels", pa.list_(pa.uint64()), False), pa.field("supervoxels", pa.list_(pa.uint64()), False), pa.field(BLOCK_COLUMN, pa.binary(), False), pa.field("uncompressed_size", pa.uint32(), False)])
    out = io.BytesIO()
    with ipc.new_stream(out, schema) as w:
        w.write_table(pa.Table.from_pylist(rows, schema), max_chunksize=batch_size)
    return out.getvalue()
