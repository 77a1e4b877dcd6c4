"""What exports have finished: an append-only table beside a volume, so that a repeated run does only what is new or changed.

A row says that a source shard, as it then was (bytes and time of change), went into an output file that was committed.  The
latest row of a shard counts.  An output file is made from all of its sources, so one that is new, changed or unrecorded brings
the file's others with it; a file that is gone brings all of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale, shard_filename, shard_of_name
from lamellar.operators import telemetry

from . import pipelines

FOLDER = "_ledger"
_SCHEMA = "level int, shard string, file string, bytes long, changed timestamp, finished timestamp"


def source_states(spark: SparkSession, source: str, scale: Scale, z_compress: int = 0) -> DataFrame:
    """shard, file (the output it leads to), bytes, changed: the source shards as they are, from file metadata alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.arrow").load(source)
    own = files.select(F.regexp_extract("path", r"([^/]+)\.arrow$", 1).alias("shard"), F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))
    return own.select("shard", shard_filename(shard_of_name(scale, F.col("shard"), z_compress), scale.shard).alias("file"), "bytes", "changed")


def read(spark: SparkSession, out: str, level: int) -> DataFrame:
    """The latest row of every source shard of a scale; none before the first."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{FOLDER}")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], _SCHEMA)
    rows = spark.read.schema(_SCHEMA).parquet(f"{out}/{FOLDER}").where(F.col("level") == level)
    return telemetry.latest(rows, ["shard"], "finished", "changed")


def record(states: DataFrame, out: str, level: int) -> None:
    """Append that these source shards' files are there; called once they are."""
    rows = states.select(F.lit(level).cast("int").alias("level"), "shard", "file", "bytes", "changed", F.current_timestamp().alias("finished"))
    rows.write.mode("append").parquet(f"{out}/{FOLDER}")


def unfinished(spark: SparkSession, states: DataFrame, out: str, level: int) -> DataFrame:
    """Those of the source states that a run has to do."""
    done = read(spark, out, level).select("shard", "file", "bytes", "changed", F.lit(True).alias("__done"))
    there = pipelines.written_files(spark, out, level).distinct().withColumn("__there", F.lit(True))
    known = states.join(done, ["shard", "file", "bytes", "changed"], "left").join(there, "file", "left")
    open_ = F.max(F.col("__done").isNull() | F.col("__there").isNull()).over(Window.partitionBy("file"))
    return known.withColumn("__open", open_).where("__open").select(states.columns)
