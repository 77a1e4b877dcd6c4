"""Labels of points from a remote label service: batched requests inside tasks, answers checked."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .shards import patiently

#: Points of one request.
BATCH = 1000


class LabelServiceError(ValueError):
    """An answer that doesn't fit its request."""


def get(url: str, body: bytes) -> bytes:
    """One GET request with a JSON body."""
    import urllib.request

    request = urllib.request.Request(url, data=body, method="GET", headers={"Content-Type": "application/json", "Accept": "application/json"})
    with urllib.request.urlopen(request) as answer:
        return answer.read()


def address(base: str, uuid: str, instance: str, scale: int, supervoxels: bool, body: bytes) -> str:
    """The same address as :func:`lamellar.functions.text.labels_url`, for one body."""
    root = base.rstrip("/").removesuffix("/api")
    return f"{root}/api/node/{uuid}/{instance}/labels?scale={scale}&hash={hashlib.md5(body).hexdigest()}" + "&supervoxels=true" * supervoxels


def service_labels(points: DataFrame, base: str, uuid: str, instance: str, scale: int, supervoxels: bool = False, ask: Callable[[str, bytes], bytes] = get, batch: int = BATCH) -> DataFrame:
    """``points`` (point_id, x, y, z) with the label that the service has there.

    Tasks ask for up to ``batch`` points at a time, again after storage or network errors; an answer of another length
    than its request is an error.  Labels over 2**63 come as int64 bit patterns.
    """
    from lamellar.session import ship

    ship(points.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                at_points = list(zip(*(part.column(k).to_pylist() for k in (1, 2, 3)), strict=True))
                body = json.dumps(at_points, separators=(",", ":")).encode()
                values = json.loads(patiently(lambda body=body: ask(address(base, uuid, instance, scale, supervoxels, body), body)))
                if len(values) != len(at_points):
                    raise LabelServiceError(f"{len(values)} labels for {len(at_points)} points at scale {scale}")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([v - (1 << 64) if v >> 63 else v for v in map(int, values)], pa.int64())], names=["point_id", "x", "y", "z", "label"])

    return points.select("point_id", *(points[a].cast("long").alias(a) for a in "xyz")).mapInArrow(run, f"point_id {points.schema['point_id'].dataType.simpleString()}, x long, y long, z long, label long")
