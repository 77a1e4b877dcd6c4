"""Session settings, the shared work folder and shipping of this package to executors."""

from __future__ import annotations

import atexit
import contextlib
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine is written for.  A session that already exists keeps its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`DEFAULTS`; ``conf`` (dots as ``__``) wins over them."""
    builder = SparkSession.builder.appName("lamellar")
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data directory; only Spark's reader ever touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    A local session (tests) that names none gets a temporary one, which goes at exit; on a cluster that would be
    a folder of each machine's own, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="lamellar-shared-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        found = f"file://{own}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for intermediate files; :func:`clear_scratch` and the session's end delete what is still there."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    if not hasattr(sc, "_lamellar_scratch"):
        sc._lamellar_scratch = set()
        atexit.register(_forget, spark)
    sc._lamellar_scratch.add(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete one scratch path that nothing reads any more."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)
    getattr(spark.sparkContext, "_lamellar_scratch", set()).discard(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate files of this application, once the results that read them are stored elsewhere.

    Results are lazy, so a query can't do this itself; an application that runs many calls it between them.
    """
    for path in sorted(getattr(spark.sparkContext, "_lamellar_scratch", ())):
        discard(spark, path)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at its end, the intermediate files made within; what is kept of the results must be stored by then."""
    before = set(getattr(spark.sparkContext, "_lamellar_scratch", ()))
    yield
    for path in sorted(getattr(spark.sparkContext, "_lamellar_scratch", set()) - before):
        discard(spark, path)


def _forget(spark: SparkSession) -> None:
    try:
        clear_scratch(spark)
    except Exception:  # noqa: BLE001  the JVM may be gone already; the folder is scratch
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    The files survive lost executors, unlike a local checkpoint, and the reread table is a plain
    scan, so that adaptive execution can split skewed join partitions above it.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.materialized_at = path
    return out


def remove(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`materialize` that nothing reads any more."""
    discard(df.sparkSession, df.materialized_at)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores if it has fewer splits than there are cores, for work that costs far more.

    A file of one row group is one task however many cores wait.  Tables of enough splits stay as they are, and so
    do results of exchanges, whose partitions adaptive execution chooses.
    """
    cores, run = df.sparkSession.sparkContext.defaultParallelism, df._jdf.queryExecution()
    if run.executedPlan().getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return df
    return df.repartition(cores) if run.toRdd().getNumPartitions() < cores else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, made from ``names``; columns are told apart without regard to case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application (they share no local folder)."""
    sc = spark.sparkContext
    if getattr(sc, "_lamellar_shipped", False):
        return
    root = Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    target = os.path.join(tempfile.mkdtemp(prefix="lamellar-ship-"), "lamellar_ship.zip")
    Path(target).write_bytes(buffer.getvalue())
    sc.addPyFile(target)
    sc._lamellar_shipped = True
