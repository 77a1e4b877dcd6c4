"""Text, time and path helpers as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def error_class(message: Column) -> Column:
    """Category of an error message; the first rule that holds."""
    low = F.lower(message)
    return (
        F.when(F.contains(low, F.lit("zstd")), "zstd_decompression")
        .when(F.contains(message, F.lit("CURL error")), "curl_gcs")
        .when(F.contains(low, F.lit("not found")), "file_not_found")
        .when(F.contains(low, F.lit("timeout")), "timeout")
        .when(F.contains(low, F.lit("memory")) | F.contains(low, F.lit("oom")), "memory_pressure")
        .otherwise("other")
    )


def embedded_json(line: Column, schema: str) -> Column:
    """The JSON object from a line's first brace on; null if there is none or it is broken."""
    at = F.instr(line, "{")
    bad = "_broken"
    parsed = F.from_json(F.substring(line, at, F.length(line)), f"{schema}, {bad} string", {"columnNameOfCorruptRecord": bad})
    return F.when((at > 0) & parsed[bad].isNull(), parsed.dropFields(bad))


def stem(path: Column) -> Column:
    """File name without directories and its last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def suffix(path: Column) -> Column:
    return F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"(\.[^.]*)$", 1)


def bucket_and_key(uri: Column) -> tuple[Column, Column]:
    """Bucket and key of an object URI."""
    rest = F.regexp_replace(uri, r"^[a-z0-9]+://", "")
    return F.substring_index(rest, "/", 1), F.regexp_replace(rest, r"^[^/]*/?", "")


def tier_of(path: Column) -> Column:
    """Tier in a "tier-16gi" path part or job name; null without one."""
    return F.nullif(F.regexp_extract(path, r"tier-?(\d+)gi", 1), F.lit("")).cast("int")


def memory_gib(text: Column) -> Column:
    """GiB of "16Gi" or "512Mi"; null for other forms."""
    n = F.regexp_extract(text, r"^([0-9.]+)(Gi|Mi)$", 1)
    value = F.when(n != "", n).cast("double")
    return F.when(text.endswith("Gi"), value).when(text.endswith("Mi"), value / 1024)


def elapsed(seconds: Column) -> Column:
    """"1h02m03s", "2m03s" or "3s", of rounded seconds."""
    s = F.bround(seconds).cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(s >= 3600, F.format_string("%dh%02dm%02ds", h, m, r)).when(s >= 60, F.format_string("%dm%02ds", m, r)).otherwise(F.format_string("%ds", r))


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds between two ISO time texts."""
    return F.unix_micros(F.to_timestamp(end)) / 1e6 - F.unix_micros(F.to_timestamp(start)) / 1e6


def percent(done: Column, total: Column) -> Column:
    """Percentage of a total, at most 100; 0 for an empty total."""
    return F.when(total > 0, F.least(F.lit(100.0), 100.0 * done / total)).otherwise(0.0)


def labels_url(base: Column, uuid: Column, instance: Column, scale: Column, supervoxels: bool, body: Column) -> Column:
    """Address of a batch label request: scale and md5 of the body as its query."""
    root = F.regexp_replace(F.regexp_replace(base, "/+$", ""), "/api$", "")
    tail = "&supervoxels=true" if supervoxels else ""
    return F.concat(root, F.lit("/api/node/"), uuid, F.lit("/"), instance, F.lit("/labels?scale="), scale.cast("string"), F.lit("&hash="), F.md5(body), F.lit(tail))


def point_body(points: Column) -> Column:
    """The JSON body of a batch of points (array of arrays), as the label service wants it."""
    return F.to_json(points)


def short_digest(text: Column, n: int = 12) -> Column:
    return F.substring(F.sha2(text, 256), 1, n)


def valid_name(name: Column) -> Column:
    """Lower-case names of letters, digits and hyphens that start with a letter."""
    return name.rlike(r"^[a-z][a-z0-9-]{0,62}$")
