"""WARC archives with a two-level capture index.

Writing.  Pages become gzip members of WARC/1.1 files, one file per task.  Of pages with equal payloads the
one with the smallest id is a response, the others are revisits that refer to it.  A file's name is unique
to the task attempt and only the rows of attempts that Spark commits name it, so lost or repeated attempts
leave at most files that nothing refers to.

Index.  Capture lines are sorted by URL key, the reversed host and then the rest, and packed into compressed
blocks; the upper level is a sparse directory with each block's first key, offset and length.  A lookup bisects
the list of index shards (one per partition), the shard's directory and the block, then reads the record's byte
range.  Lookups arrive sorted, so a task holds one directory and one block at a time.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamellar.session import materialize, scratch, ship, table

#: Lines of one compressed index block.
BLOCK_LINES = 500
#: Parts that the rows of one payload are dealt over when joined with their response.
SALTS = 64
#: Pages carry no time; records need one.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURES = "key string, page_id long, file string, offset long, length long"
RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("url", T.StringType()),
])


def url_key(url: Column) -> Column:
    """Sort key of a URL: "com,example,www)/path?query"; control characters and spaces are escaped, null is ""."""
    u = F.coalesce(url, F.lit(""))
    authority = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)"
    host = F.lower(F.regexp_extract(u, authority, 1))
    turned = F.array_join(F.reverse(F.split(F.regexp_replace(host, r":\d*$", ""), r"\.")), ",")
    rest = F.regexp_replace(u, authority, "")
    key = F.concat(turned, F.regexp_extract(host, r"(:\d+)$", 1), F.lit(")"), rest)
    return F.regexp_replace(F.regexp_replace(key, "%", "%25"), r"[\x00-\x20]", "%20")


def capture_key(url: Column, page_id: Column) -> Column:
    """The URL's key and the page's id, so that every page has a key of its own."""
    return F.concat(url_key(url), F.lit(" "), F.coalesce(page_id.cast("string"), F.lit("-")))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, uncompressed.  A revisit keeps the HTTP header, with the length of the full payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")), ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def compressed(data: bytes) -> bytes:
    """One gzip member."""
    z = zlib.compressobj(5, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields (names in lower case) and payload of an uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}


class Store:
    """Files of the shared folder, by any URI that pyarrow knows; a few stay open for range reads."""

    def __init__(self, folder: str):
        self.fs, self.root = FileSystem.from_uri(folder)
        self._open: dict[str, object] = {}

    def create(self, name: str):
        self.fs.create_dir(self.root, recursive=True)
        return self.fs.open_output_stream(f"{self.root}/{name}", compression=None)

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self._open:
            if len(self._open) >= 32:
                self._open.pop(next(iter(self._open))).close()
            self._open[name] = self.fs.open_input_file(f"{self.root}/{name}")
        return self._open[name].read_at(length, offset)

    def whole(self, name: str) -> bytes:
        with self.fs.open_input_stream(f"{self.root}/{name}", compression=None) as f:
            return f.read()


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write every page as a record under ``folder``; the captures, as a table in the shared folder.

    Null html is an empty payload, a null url an empty one.  Payloads of fewer than ``min_bytes`` bytes are all
    responses.  Rows that repeat the smallest id of a payload are responses too; rows without an id are
    revisits of a payload that has one and responses otherwise.  Other columns are not read.
    """
    ship(pages.sparkSession)
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    groups = p.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"), F.collect_set("salt").alias("salts"))
    groups = groups.where((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first", F.explode("salts").alias("salt"))
    joined = p.join(groups, ["digest", "salt"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = joined.select(capture_key(F.col("url"), F.col("page_id")).alias("key"), "page_id", "url", "html", "first", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                out = Store(folder).create(name)
                info = b"software: lamellar\r\nformat: WARC File Format 1.1\r\n"
                at = out.write(compressed(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n"))
            offsets, lengths = [], []
            for page_id, url, html, first, revisit in zip(*(b.column(k) for k in range(1, 6)), strict=True):
                data = compressed(record(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8", "surrogatepass"), first.as_py(), revisit.as_py()))
                out.write(data)
                offsets.append(at)
                lengths.append(len(data))
                at += len(data)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([name] * b.num_rows), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return materialize(rows.mapInArrow(run, CAPTURES), "captures")


def index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Build both index levels; one row per shard: first_key, blocks_file, directory_file."""
    ship(captures.sparkSession)
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(n, "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, lines, directory, out, at = uuid.uuid4().hex, [], [], None, 0

        def flush() -> None:
            nonlocal at
            data = zlib.compress("".join(x[1] for x in lines).encode(), 5)
            out.write(data)
            directory.append((lines[0][0], at, len(data)))
            at += len(data)
            lines.clear()

        store = Store(folder)
        for b in batches:
            for row in b.to_pylist():
                out = out or store.create(f"{name}.cdx")
                key = row.pop("key")
                lines.append((key, f"{key}\t{json.dumps(row, separators=(',', ':'))}\n"))
                if len(lines) == block_lines:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
            with store.create(f"{name}.idx") as f:
                f.write("".join(f"{k}\t{a}\t{n}\n" for k, a, n in directory).encode())
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([f"{name}.cdx"]), pa.array([f"{name}.idx"])], names=["first_key", "blocks_file", "directory_file"])

    return materialize(ordered.mapInArrow(run, "first_key string, blocks_file string, directory_file string"), "shards")


class Reader:
    """Lookups in both index levels; holds one directory and one block."""

    def __init__(self, folder: str, shards: list[tuple[str, str, str]]):
        self.store, self.shards = Store(folder), shards
        self.first = [s[0] for s in shards]
        self._directory: tuple[str, list[str], list[tuple[int, int]]] = ("", [], [])
        self._block: tuple[str, int, list[str], list[str]] = ("", -1, [], [])

    def _load_directory(self, name: str) -> None:
        if self._directory[0] != name:
            rows = [x.rsplit("\t", 2) for x in self.store.whole(name).decode().split("\n")[:-1]]
            self._directory = (name, [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows])

    def _load_block(self, name: str, offset: int, length: int) -> None:
        if self._block[:2] != (name, offset):
            lines = zlib.decompress(self.store.read(name, offset, length)).decode().split("\n")[:-1]
            self._block = (name, offset, [x.partition("\t")[0] for x in lines], lines)

    def find(self, key: str) -> Iterator[dict]:
        """Captures with exactly this key, by bisecting shards, directory and blocks."""
        s = bisect.bisect_right(self.first, key) - 1
        if s < 0:
            return
        _, blocks, directory = self.shards[s]
        self._load_directory(directory)
        _, keys, ranges = self._directory
        k = max(bisect.bisect_left(keys, key) - 1, 0)  # equal keys may begin in the block before
        while k < len(keys) and keys[k] <= key:
            self._load_block(blocks, *ranges[k])
            own, lines = self._block[2:]
            at = bisect.bisect_left(own, key)
            while at < len(own) and own[at] == key:
                yield json.loads(lines[at].partition("\t")[2])
                at += 1
            if at < len(own):
                return
            k += 1

    def fetch(self, capture: dict) -> tuple[dict[str, str], dict[str, str], bytes]:
        """The record in a capture's byte range."""
        return parse(zlib.decompress(self.store.read(capture["file"], capture["offset"], capture["length"]), 31))


def lookup(requests: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """The records of every page asked for (columns url, page_id), found through the index.

    A page asked for repeatedly is looked up once; one that was archived repeatedly gives each record.
    The shard list has one row per index partition and goes to every task.
    """
    spark = requests.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast([tuple(r) for r in shards.orderBy("first_key").collect()])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = requests.select(capture_key(F.col("url"), F.col("page_id")).alias("key")).distinct()
    ordered = materialize(keys, "requests").repartitionByRange(n, "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(folder, known.value)
        for b in batches:
            rows = []
            for key in b.column(0).to_pylist():
                for capture in reader.find(key):
                    fields, http, payload = reader.fetch(capture)
                    size, digest, kind = int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
                    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"{capture}: the payload does not match its digest")
                    to = fields.get("x-refers-to-page-id")
                    own = fields.get("x-page-id")
                    rows.append((own and int(own), size, digest, kind, to and int(to), fields["warc-target-uri"]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=RECORDS.names)

    return ordered.mapInArrow(run, RECORDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: archive all pages, index them, and read every one back through the index."""
    pages = table(spark, sf_dir, "pages")
    folder = scratch(spark, "warc")
    shards = index(write(pages, folder), folder)
    return lookup(pages, shards, folder)
