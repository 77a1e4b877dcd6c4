"""Scales side by side: chunk tables of all scales, bucketed so that a chunk, its parents and what they become share a bucket.

A row's ``home`` is the Morton number of its chunk's ancestor a few scales up, so it is a prefix of the places of everything
below that ancestor.  Every scale's table is bucketed by it into equally many buckets: votes, unions of label sets and joins from
one scale to the next read bucket by bucket and exchange nothing.  The ancestor is at most ``span`` scales up, so a home is a
block of at most 8^span chunks, whatever the data; at a border of spans, once in ``span`` scales, rows are exchanged.

Tables are Parquet folders below a path, and ``scales.json`` beside them says which is whose.  A scale that is written again
gets a new folder and appears with the move of that file; :meth:`Colocated.vacuum` deletes folders that it no longer names.
"""

from __future__ import annotations

import contextlib
import dataclasses
import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow.fs import FileSelector, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale, axis_factors, div, morton, settled
from lamellar.operators import chunked, labelsets
from lamellar.session import fresh

from .files import store

AT = ("chunk_x", "chunk_y", "chunk_z")
ABOVE = ("parent_x", "parent_y", "parent_z")
HOME = "home"
_META = "scales.json"
_SUBSET = "spark.sql.requireAllClusterKeysForCoPartition"


@contextlib.contextmanager
def subset_keys(spark: SparkSession) -> Iterator[None]:
    """Joins that run within may use a partitioning by some of their keys, as :meth:`Colocated.pairs` needs for its buckets."""
    before = spark.conf.get(_SUBSET)
    spark.conf.set(_SUBSET, "false")
    try:
        yield
    finally:
        spark.conf.set(_SUBSET, before)


@dataclass(frozen=True)
class Colocated:
    """The scales at a path; made by :func:`create`, found again, by any session, by :func:`attach`.

    Rows have chunk_x, chunk_y, chunk_z inside the scale's grid and any other columns but ``home``; rows outside the grid or with a
    null coordinate are refused when they are written.  Repeated rows stay.
    """

    spark: SparkSession
    path: str
    scales: tuple[Scale, ...]
    buckets: int
    span: int

    def anchor(self, level: int) -> int:
        """The scale whose chunks are the homes of a scale's rows."""
        return min((level // self.span + 1) * self.span, len(self.scales) - 1)

    def _exchanged(self, rows: DataFrame, level: int, anchor: int) -> DataFrame:
        """Rows with a scale's chunk_x.., with their ancestor at scale ``anchor`` as home, exchanged by it.

        The ancestor is settled and has no nulls: copied into every bit of its number, its divisions would cost more than all the rest.
        """
        at, names = [F.col(a) for a in AT], fresh(rows, "__x", "__y", "__z")
        for k in range(level, anchor):
            at = [div(a, f) for a, f in zip(at, axis_factors(self.scales[k], self.scales[k + 1]), strict=True)]
        own = settled(rows, **{n: F.coalesce(a.cast("long"), F.lit(0).cast("long")) for n, a in zip(names, at, strict=True)})
        return own.withColumn(HOME, morton(self.scales[anchor], *(F.col(n) for n in names))).drop(*names).repartition(self.buckets, HOME)

    def placed(self, rows: DataFrame, level: int) -> DataFrame:
        """A scale's rows with their home, exchanged once by it."""
        if HOME in {c.lower() for c in rows.columns}:
            raise ValueError(f"{HOME} is a name of these tables")
        inside = [F.col(a).isNotNull() & (F.col(a) >= 0) & (F.col(a) < g) for a, g in zip(AT, self.scales[level].grid, strict=True)]
        right = F.when(inside[0] & inside[1] & inside[2], F.col(AT[0])).otherwise(F.raise_error(F.lit("a chunk lies outside the grid")).cast(rows.schema[AT[0]].dataType))
        return self._exchanged(rows.withColumn(AT[0], right), level, self.anchor(level))

    def write(self, rows: DataFrame, level: int) -> None:
        """Write a scale's rows, exchanged once by home."""
        self._store(self.placed(rows, level), level)

    def write_sets(self, words: DataFrame, level: int) -> None:
        """Write a scale's label sets from a row per chunk and label (:func:`labelsets.words`), repeats allowed, merged in their buckets."""
        self._store(labelsets.merged(self.placed(words, level), [HOME, *AT]), level)

    def _store(self, rows: DataFrame, level: int) -> None:
        """Store rows that have their home.  Rows partitioned by home, into as many partitions as buckets, give a file a bucket."""
        folder = f"level_{level}_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(self.buckets, HOME).sortBy(HOME, *AT).option("path", f"{self.path}/{folder}").saveAsTable(_table(folder))
        meta = _read_meta(self.path)
        meta["levels"][str(level)] = {"folder": folder, "columns": rows.schema.toDDL()}
        _write_meta(self.path, meta)

    def levels(self) -> list[int]:
        """Scales that are written."""
        return sorted(map(int, _read_meta(self.path)["levels"]))

    def read(self, level: int) -> DataFrame:
        """A scale's rows with their ``home``, by which they are partitioned where that saves an exchange."""
        own = _read_meta(self.path)["levels"].get(str(level))
        if own is None:
            raise ValueError(f"{self.path}: scale {level} is not written")
        if not self.spark.catalog.tableExists(_table(own["folder"])):
            where = f"{self.path}/{own['folder']}".replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {_table(own['folder'])} ({own['columns']}) USING parquet CLUSTERED BY ({HOME}) SORTED BY ({HOME}, {', '.join(AT)}) INTO {self.buckets} BUCKETS LOCATION '{where}'")
        return self.spark.table(_table(own["folder"]))

    def homed(self, level: int, rows: DataFrame | None = None) -> DataFrame:
        """Rows of the scale before ``level``, by default all of its table, with the home that their children at ``level`` have."""
        rows = self.read(level - 1) if rows is None else rows
        if self.anchor(level - 1) == self.anchor(level):
            return rows
        return self._exchanged(rows, level - 1, self.anchor(level))

    def raise_chunks(self, level: int) -> None:
        """Write a scale's encoded chunks (chunk_x.., encoded) from those of the scale before, by majority."""
        self._store(chunked.downsampled(self.homed(level), self.scales[level - 1], self.scales[level], HOME), level)

    def raise_sets(self, level: int) -> None:
        """Write a scale's label sets (chunk_x.., bucket, bits; :mod:`lamellar.operators.labelsets`), the unions of the scale before."""
        rows = self.homed(level)
        up = [F.expr(f"cast({a} div {f} as {rows.schema[a].dataType.simpleString()})").alias(a) for a, f in zip(AT, axis_factors(self.scales[level - 1], self.scales[level]), strict=True)]
        self._store(labelsets.merged(rows.select(HOME, *up, "bucket", "bits"), [HOME, *AT]), level)

    def pairs(self, level: int, parents: DataFrame | None = None, children: DataFrame | None = None, how: str = "inner") -> DataFrame:
        """Chunks of a scale with those of the scale before that they were made from.

        chunk_x.. (the child's), parent_x.., and the other columns as parent_* and child_*.  ``parents`` and ``children`` are
        tables of the two scales by default, or rows made from them that still have ``home`` and chunk_x...; ``how`` is any
        outer or inner join (left: of the parents).  Run it within :func:`subset_keys`, else Spark exchanges both sides; the
        rows are the same.
        """
        low = self.homed(level, parents)
        children = self.read(level) if children is None else children
        factors = axis_factors(self.scales[level - 1], self.scales[level])
        keys = [F.expr(f"{a} div {f}").alias(a) for a, f in zip(AT, factors, strict=True)]
        low = low.select(HOME, *keys, *(F.col(a).alias(n) for a, n in zip(AT, ABOVE, strict=True)), *_others(low, "parent"))
        high = children.select(HOME, *(F.col(a).cast("long").alias(a) for a in AT), *_others(children, "child"))
        return low.hint("merge").join(high, [HOME, *AT], how).drop(HOME)

    def forget(self) -> None:
        """Take this session's entries of the scales out of its catalog; the files stay, and :func:`attach` finds them."""
        for own in _read_meta(self.path)["levels"].values():
            self.spark.sql(f"DROP TABLE IF EXISTS {_table(own['folder'])}")

    def vacuum(self) -> int:
        """Delete folders of scales written again, once nothing reads them; how many."""
        fs, root = store(self.path)
        named = {own["folder"] for own in _read_meta(self.path)["levels"].values()}
        old = [f.path for f in fs.get_file_info(FileSelector(root)) if f.type == FileType.Directory and f.base_name.startswith("level_") and f.base_name not in named]
        for path in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {_table(path.rsplit('/', 1)[1])}")
            fs.delete_dir(path)
        return len(old)


def create(spark: SparkSession, path: str, scales: list[Scale], buckets: int | None = None, span: int = 3) -> Colocated:
    """Begin co-located scales at a path.

    ``buckets`` should make a bucket of the first scale a task's work (``spark.sql.shuffle.partitions`` by default); all scales
    have the same number.  ``span``: see the module; homes must be several times as many as buckets to fill them evenly.
    """
    if span < 1 or not scales:
        raise ValueError("a span is one scale at least, and there must be scales")
    own = Colocated(spark, path, tuple(scales), buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), span)
    _write_meta(path, {"buckets": own.buckets, "span": span, "scales": [dataclasses.asdict(s) for s in scales], "levels": {}})
    return own


def attach(spark: SparkSession, path: str) -> Colocated:
    """The co-located scales that an earlier session made at a path."""
    meta = _read_meta(path)
    scales = [Scale(**{k: tuple(v) if isinstance(v, list) else v for k, v in s.items()}) for s in meta["scales"]]
    return Colocated(spark, path, tuple(scales), meta["buckets"], meta["span"])


def buckets_for(size: int, bucket: int = 1 << 28) -> int:
    """Buckets of about ``bucket`` bytes for a first scale of ``size`` bytes, or of rows if both are numbers of rows."""
    return max(1, math.ceil(size / bucket))


def _others(rows: DataFrame, side: str) -> list[F.Column]:
    return [F.col(c).alias(f"{side}_{c}") for c in rows.columns if c not in (HOME, *AT)]


def _table(folder: str) -> str:
    return f"lamellar_{folder}"


def _read_meta(path: str) -> dict:
    fs, root = store(path)
    with fs.open_input_file(f"{root}/{_META}") as f:
        return json.loads(f.read())


def _write_meta(path: str, meta: dict) -> None:
    fs, root = store(path)
    fs.create_dir(root, recursive=True)
    staged = f"{root}/{_META}.{uuid.uuid4().hex}"
    with fs.open_output_stream(staged, compression=None) as f:
        f.write(json.dumps(meta, indent=1).encode())
    fs.move(staged, f"{root}/{_META}")
