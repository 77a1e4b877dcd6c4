"""Files of any store, patient opening, and the boxes of chunks that filters leave."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual

from lamellar.session import ship

#: Folder, within a target, of files that are not finished.
STAGING = "_staging"
AXES = ("chunk_x", "chunk_y", "chunk_z")
_FAR = 1 << 40


class ShardError(ValueError):
    """A shard or index that doesn't have the format's parts."""


def patiently(work: Callable, attempts: int = 5, first: float = 1.0, sleep: Callable[[float], None] = time.sleep):
    """``work()``, tried again after 1, 2, 4, ... seconds when storage fails; what is wrong with the data fails at once."""
    for attempt in range(attempts):
        try:
            return work()
        except ShardError:
            raise
        except OSError:
            if attempt == attempts - 1:
                raise
            sleep(first * 2**attempt)
    return None


def store(path: str) -> tuple[FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


def open_input(path: str) -> pa.NativeFile:
    fs, name = store(path)
    return patiently(lambda: fs.open_input_file(name))


@dataclass
class Bounds:
    """What filters leave of chunks: lowest and highest coordinate of each axis, and shards (None: all)."""

    low: list[int] = field(default_factory=lambda: [0, 0, 0])
    high: list[int] = field(default_factory=lambda: [_FAR] * 3)
    shards: set | None = None

    def take(self, f: Filter) -> None:
        """Narrow the bounds by a filter, if it is one of those that can."""
        name, value = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else "", getattr(f, "value", None)
        if name == "shard" and isinstance(f, EqualTo | EqualNullSafe | In):
            own = {v for v in (value if isinstance(f, In) else [value]) if v is not None}
            self.shards = own if self.shards is None else self.shards & own
        if name not in AXES:
            return
        k = AXES.index(name)
        own = [v for v in value if v is not None] if isinstance(f, In) else [value]
        if isinstance(f, EqualTo | EqualNullSafe | In):
            if not own or own == [None]:
                self.high[k] = -1
            else:
                self.low[k], self.high[k] = max(self.low[k], min(own)), min(self.high[k], max(own))
        elif value is None:
            return
        elif isinstance(f, GreaterThan | GreaterThanOrEqual):
            self.low[k] = max(self.low[k], value + isinstance(f, GreaterThan))
        elif isinstance(f, LessThan | LessThanOrEqual):
            self.high[k] = min(self.high[k], value - isinstance(f, LessThan))

    def meet(self, origin: np.ndarray, shape: tuple[int, int, int]) -> bool:
        return all(o <= h and o + n > low for o, n, low, h in zip(origin, shape, self.low, self.high, strict=True))

    def inside(self, at: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([(at[k] >= self.low[k]) & (at[k] <= self.high[k]) for k in range(3)])

    @property
    def everywhere(self) -> bool:
        return self.low == [0, 0, 0] and self.high == [_FAR] * 3


def write_files(contents: DataFrame, folder: str) -> DataFrame:
    """One file per row (name, content: text or bytes) under a folder, written by tasks; returns name and bytes.

    A file appears whole: it is written under a name of the attempt's own and then moved, so a repeated task writes the same again.
    The files are there once the result is computed.
    """
    ship(contents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = store(folder)
        for b in batches:
            sizes = []
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at, own = f"{root}/{name}", f"{root}/{STAGING}/{uuid.uuid4().hex}"
                for path in (at, own):
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(own, compression=None) as f:
                    f.write(content)
                fs.move(own, at)
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=["name", "bytes"])

    return contents.select("name", F.col("content").cast("binary")).mapInArrow(run, "name string, bytes long")
