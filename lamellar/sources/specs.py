"""Volume specs, manifests, label profiles, log events and settings as DataFrames; and their writers."""

from __future__ import annotations

import base64
import json
import os
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale
from lamellar.functions.text import embedded_json, tier_of
from lamellar.session import fresh

from .files import write_files
from .shards import list_files

#: Fixed value: the spec format's type tag.
SPEC_TYPE = "neuroglancer_multiscale_volume"
SCALES = "array<struct<key:string,size:array<long>,chunk_sizes:array<array<long>>,resolution:array<double>,voxel_offset:array<long>,encoding:string,compressed_segmentation_block_size:array<int>,sharding:struct<preshift_bits:int,minishard_bits:int,shard_bits:int,hash:string,minishard_index_encoding:string,data_encoding:string>>>"
SPEC = f"`@type` string, type string, data_type string, num_channels int, scales {SCALES}"


class SpecError(ValueError):
    """A volume spec without what it needs."""


def read_spec(spark: SparkSession, path: str) -> DataFrame:
    """One row per scale: scale, key, size, chunk, sharding and so on; only a scale's first chunk size counts."""
    spec = spark.read.option("multiLine", True).schema(SPEC).json(path)
    return spec.select(F.col("`@type`").alias("spec_type"), F.posexplode("scales").alias("scale", "s")).select("spec_type", "scale", "s.*").withColumn("chunk", F.col("chunk_sizes")[0])


def scales_of(spec: DataFrame) -> list[Scale]:
    """Driver-side scales; a spec has about ten."""
    return [Scale(r["key"], tuple(r["size"]), tuple(r["chunk"]), r["sharding"]["preshift_bits"] or 0, r["sharding"]["minishard_bits"] or 0, r["sharding"]["shard_bits"] or 0) for r in spec.orderBy("scale").collect()]


def parse_spec(text: str | bytes, validate: bool = False) -> list[Scale]:
    """Scales of a spec's JSON; validation wants the type tag and at least one scale."""
    spec = json.loads(text)
    if validate and (spec.get("@type") != SPEC_TYPE or not spec.get("scales")):
        raise SpecError("not a multiscale volume with scales")
    out = []
    for s in spec["scales"]:
        sharding = s.get("sharding") or {}
        out.append(Scale(str(s["key"]), tuple(s["size"]), tuple(s["chunk_sizes"][0]), *(sharding.get(f"{k}_bits", 0) for k in ("preshift", "minishard", "shard"))))
    return out


def encoded_spec(text: str) -> str:
    return base64.b64encode(text.encode()).decode()


def destination_info(text: str, encoding: str = "compressed_segmentation", block: tuple[int, int, int] = (8, 8, 8)) -> str:
    """The spec to write beside an output volume: one encoding for all scales, its block size where it has one."""
    spec = json.loads(text)
    for s in spec["scales"]:
        s["encoding"] = encoding
        if encoding == "compressed_segmentation":
            s.setdefault("compressed_segmentation_block_size", list(block))
        else:
            s.pop("compressed_segmentation_block_size", None)
    return json.dumps(spec, indent=2)


# --- manifests --------------------------------------------------------------------------------------------


def write_manifests(tasks: DataFrame, path: str) -> None:
    """Assigned shards (tier_gib, task_id, ...) as JSON by tier and task; what was there before goes."""
    tasks.repartition("tier_gib", "task_id").write.mode("overwrite").partitionBy("tier_gib", "task_id").json(path)


def read_manifests(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Manifests written by :func:`write_manifests`; tier and task come from the path."""
    return spark.read.schema(f"{schema}, tier_gib int, task_id int").json(path)


def read_task_files(spark: SparkSession, path: str, entry: str = "struct<scale:int,shard:string>") -> DataFrame:
    """Manifests of the form tier-{N}gi/task-{i}.json, each one JSON array: tier_gib, task_id and the entry's fields."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "task-*.json").text(path, wholetext=True)
    rows = files.select(F.input_file_name().alias("f"), F.explode(F.from_json("value", f"array<{entry}>")).alias("e"))
    return rows.select(tier_of(F.col("f")).alias("tier_gib"), F.regexp_extract("f", r"task-(\d+)\.json$", 1).cast("int").alias("task_id"), "e.*")


def manifest_summary(tasks: DataFrame) -> DataFrame:
    """Shards and tasks of each tier, and of all (tier_gib null)."""
    return tasks.rollup("tier_gib").agg(F.count(F.lit(1)).alias("shards"), F.countDistinct("task_id").alias("tasks"))


#: A tier's or, with no tier, the whole plan's line of a written summary.
SUMMARY = "tier_gib int, shards long, tasks long"


def write_summary(tasks: DataFrame, path: str) -> None:
    """The summary of manifests beside them: a line of JSON per tier and one for all."""
    manifest_summary(tasks).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """A summary written by :func:`write_summary`."""
    return spark.read.schema(SUMMARY).json(path)


def with_tier_totals(rows: DataFrame, label: str, summary: DataFrame) -> DataFrame:
    """Rows (jobs, say) with the planned shards and tasks of the tier that their label names; nulls without one."""
    tier, shards, tasks = fresh(rows, "__tier", "tier_shards", "tier_tasks")
    totals = summary.where("tier_gib is not null").select(F.col("tier_gib").alias(tier), F.col("shards").alias(shards), F.col("tasks").alias(tasks))
    return rows.withColumn(tier, tier_of(F.col(label))).join(totals, tier, "left").select(*rows.columns, shards, tasks)


def write_task_files(tasks: DataFrame, path: str, fields: tuple[str, ...] = ("scale", "shard"), order: tuple[str, ...] = ()) -> DataFrame:
    """Assigned shards (tier_gib, task_id and ``fields``) as tier-{N}gi/task-{i}.json, each one JSON array, to be replayed by :func:`read_task_files`.

    The entries of a task stand in the order of ``order`` and the fields.  A task's list is one file, as a worker reads it whole.
    Returns name and bytes; the files are there once that is computed.
    """
    entry = F.sort_array(F.collect_list(F.struct(F.struct(*(order or fields)).alias("o"), F.struct(*fields).alias("e"))))
    own = tasks.groupBy("tier_gib", "task_id").agg(F.to_json(F.transform(entry, lambda x: x["e"])).alias("content"))
    name = F.concat(F.lit("tier-"), F.col("tier_gib").cast("string"), F.lit("gi/task-"), F.col("task_id").cast("string"), F.lit(".json"))
    return write_files(own.select(name.alias("name"), "content"), path)


def write_report(rows: DataFrame, path: str, order: list[str], form: str = "csv") -> None:
    """A report as one sorted CSV (with a header) or JSON file; reports have a line per shard, scale or class."""
    w = rows.repartitionByRange(1, *order).sortWithinPartitions(*order).write.mode("overwrite")
    (w.option("header", True).csv if form == "csv" else w.json)(path)


# --- label profiles ---------------------------------------------------------------------------------------

PROFILE = "x long, y long, z long, num_labels long, num_supervoxels long, unique_labels long"


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Per-chunk label counts of all CSVs under a path, with shard; without unique_labels, num_labels stands for it."""
    rows = spark.read.schema(PROFILE).option("header", True).option("enforceSchema", True).option("recursiveFileLookup", True).csv(path)
    return rows.select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:-labels)?\.csv$", 1).alias("shard"), "x", "y", "z", "num_labels", "num_supervoxels", F.coalesce("unique_labels", "num_labels").alias("unique_labels"))


def shard_labels(spark: SparkSession, path: str) -> DataFrame:
    """(shard, total_labels) of a scale: its labels-summary.json, one JSON object, if there is one, else its profiles."""
    found = list_files(spark, path, "labels-summary.json").limit(1).select("path").head()
    if found is None:
        return read_profiles(spark, path).groupBy("shard").agg(F.sum("unique_labels").alias("total_labels"))
    text = spark.read.text(found["path"], wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string, long>")).alias("shard", "total_labels"))


def write_label_summary(totals: DataFrame, path: str) -> None:
    """(shard, total_labels) of a scale, a row per shard, as labels-summary.json in ``path``, which :func:`shard_labels` reads first."""
    found = totals.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("shard", "total_labels"))))).alias("value")).head()
    put_text(totals.sparkSession, f"{path}/labels-summary.json", found["value"] or "{}")


def put_text(spark: SparkSession, path: str, content: str) -> None:
    """One small file (a spec, a summary, a manifest) at exactly this path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(content.encode()))
    out.close()


def write_profiles(profile: DataFrame, path: str) -> None:
    profile.write.mode("overwrite").partitionBy("scale", "shard").option("header", True).csv(path)


# --- logs and settings ------------------------------------------------------------------------------------


def read_events(spark: SparkSession, path: str, schema: str, event: str | None = None, limit: int | None = None, job: str | None = None, execution: str | None = None) -> DataFrame:
    """Events in log lines, from each line's first brace on; broken lines go, ``limit`` + 1 rows tell of more.

    ``event`` is a pattern; ``job`` and ``execution`` are values of the schema's columns of these names.
    """
    out = parse_events(spark.read.text(path).select(F.col("value").alias("line")), schema, event, job, execution)
    return out if limit is None else out.limit(limit + 1)


def parse_events(lines: DataFrame, schema: str, event: str | None = None, job: str | None = None, execution: str | None = None) -> DataFrame:
    out = lines.select("line", embedded_json(F.col("line"), schema).alias("e")).where("e is not null").select("line", "e.*")
    for column, value in (("job", job), ("execution", execution)):
        out = out if value is None else out.where(F.col(column) == value)
    return out if event is None else out.where(F.col("event").rlike(event))


def read_env(text: str) -> dict[str, str]:
    """Settings of an env file: NAME=value lines, quotes around values dropped."""
    out = {}
    for line in text.splitlines():
        m = re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line)
        if m and not line.lstrip().startswith("#"):
            value = m[2]
            out[m[1]] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def setting(name: str, given: str | None = None, env: dict[str, str] | None = None, default: str | None = None) -> str | None:
    """A setting given outright, else from the environment, else the default."""
    return given or (os.environ if env is None else env).get(name) or default


@dataclass(frozen=True)
class ExportConfig:
    """What an export run needs; z_compress is one number for all of its geometry."""

    source: str
    destination: str
    spec: str
    label_type: str = "labels"
    z_compress: int = 0
    scales: tuple[int, ...] = (0,)
    downres_scales: tuple[int, ...] = ()
    only_missing: bool = False
    max_tasks: int = 5000
    staging: str = ""
    memory_gib: float = 4.0
    manifests: str = ""
    limit_minutes: int = 1440
    polling_seconds: int = 10


def config_from_env(env: dict[str, str]) -> ExportConfig:
    """The settings' names and defaults are fixed by the format; without a staging path intermediate files go to scratch."""
    numbers = lambda text: tuple(int(x) for x in text.split(",") if x.strip())
    spec = base64.b64decode(env.get("NG_SPEC", "")).decode() or "{}"
    return ExportConfig(
        env["SOURCE_PATH"], env["DEST_PATH"], spec, env.get("LABEL_TYPE", "labels"), int(env.get("Z_COMPRESS", "0")), numbers(env.get("SCALES", "0")), numbers(env.get("DOWNRES_SCALES", "")),
        env.get("ONLY_MISSING", "") == "1", int(env.get("MAX_TASKS", "5000")), env.get("STAGING_PATH", ""), float(env.get("WORKER_MEMORY_GIB", "4")), env.get("MANIFEST_URI", ""), int(env.get("MAX_PROCESSING_TIME", "1440")), int(env.get("POLLING_INTERVAL", "10")),
    )


def resolve_label_type(given: Column, env: Column) -> Column:
    return F.coalesce(given, env, F.lit("labels"))
