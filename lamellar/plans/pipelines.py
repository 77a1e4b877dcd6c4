"""End-to-end runs: export of source shards, the downsampled pyramid, and verification.

A scale is shard files of encoded chunks (:mod:`lamellar.sources.volumes`), committed together before the next scale reads them;
they are the restart point.  Voxels exist only within a stage: what is exchanged or stored is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale, morton, shard_filename, shard_number, shard_of_name
from lamellar.operators import chunked, codecs, labels, planning, verification
from lamellar.session import discard, materialize, remove, scratch
from lamellar.sources import colocated, volumes
from lamellar.sources.shards import list_shards, read_ranges, source_entries


def shard_column(scale: Scale) -> F.Column:
    """Output shard of chunk coordinates."""
    return shard_number(scale, morton(scale, F.col("chunk_x"), F.col("chunk_y"), F.col("chunk_z")))


def source_rows(spark: SparkSession, source: str, empty: DataFrame | None = None, only: DataFrame | None = None) -> DataFrame:
    """Chunks of the source shards under a path, by the byte ranges of their indexes where these know them.

    ``empty`` (shard): shards to leave out; ``only`` (shard): the shards to take, all by default.  The ranges are chosen
    before anything is read, so that files of other shards are not opened.
    """
    entries = source_entries(spark, source)
    if empty is not None:
        entries = planning.without(entries, empty, ["shard"])
    if only is not None:
        entries = entries.join(only.select("shard").distinct(), "shard", "left_semi")
    return read_ranges(spark, entries)


def encode_source(spark: SparkSession, source: str, scale: Scale, label_type: str = codecs.LABELS, z_compress: int = 0, empty: DataFrame | None = None, only: DataFrame | None = None) -> DataFrame:
    """Encoded pieces of the source shards (see :func:`chunked.encode_source`), stored in scratch: they are read more than once."""
    return materialize(chunked.encode_source(source_rows(spark, source, empty, only), scale, label_type, z_compress), "encoded")


def export(spark: SparkSession, source: str, out: str, scale: Scale, level: int = 0, label_type: str = codecs.LABELS, z_compress: int = 0, empty: DataFrame | None = None, only: DataFrame | None = None) -> DataFrame:
    """Convert the source shards under a path; the failed chunks (shard, chunk_x.., error) are returned.

    Failures don't stop a run: their rows are the result, the others are written to ``out``.  Every block is decoded once;
    ``empty`` and ``only`` are those of :func:`source_rows`.
    """
    encoded = encode_source(spark, source, scale, label_type, z_compress, empty, only)
    write_encoded(encoded, out, scale, level, z_compress)
    failed = materialize(failures(encoded), "failed")
    remove(encoded)
    return failed


def write_encoded(encoded: DataFrame, out: str, scale: Scale, level: int, z_compress: int = 0) -> None:
    """Write the pieces of :func:`encode_source` as a scale's shard files."""
    if not z_compress:
        volumes.write_volume(encoded.where("encoded is not null").select(*codecs.KEYS, "encoded"), out, scale, level)
        return
    whole = materialize(chunked.put_together(chunked.pieces_of(encoded, scale, z_compress), scale), "chunks")
    volumes.write_volume(whole, out, scale, level)
    remove(whole)


def failures(encoded: DataFrame) -> DataFrame:
    return encoded.where("error is not null").select("shard", *codecs.KEYS, "error")


def pyramid(spark: SparkSession, out: str, scales: list[Scale], first: int = 0) -> dict[int, DataFrame]:
    """Write scales first + 1, ... from the one before; by level, the shards (shard) that its chunks lie in."""
    made = {}
    for level in range(first + 1, len(scales)):
        pieces = chunked.halved(volumes.read_volume(spark, out, level - 1), scales[level - 1], scales[level])
        whole = materialize(chunked.put_together(pieces, scales[level]), "chunks")
        volumes.write_volume(whole, out, scales[level], level)
        made[level] = materialize(whole.select(shard_column(scales[level]).alias("shard")).distinct(), "made")
        remove(whole)
    return made


def pyramid_in_place(spark: SparkSession, out: str, scales: list[Scale], first: int = 0, buckets: int | None = None, span: int = 3) -> dict[int, DataFrame]:
    """The files and result of :func:`pyramid`, made by way of co-located tables (:mod:`lamellar.sources.colocated`) in scratch.

    The first scale is read and exchanged once; each further one is voted and joined bucket by bucket, and only the writing of
    its shard files, which are another order, exchanges it.  ``buckets`` and ``span`` are those of the tables.
    """
    own = colocated.create(spark, scratch(spark, "colocated"), scales[first:], buckets, span)
    own.write(volumes.read_volume(spark, out, first).select(*codecs.KEYS, "encoded"), 0)
    made = {}
    for level in range(first + 1, len(scales)):
        own.raise_chunks(level - first)
        whole = own.read(level - first)
        volumes.write_volume(whole, out, scales[level], level)
        made[level] = materialize(whole.select(shard_column(scales[level]).alias("shard")).distinct(), "made")
    own.forget()
    discard(spark, own.path)
    return made


def read_level(spark: SparkSession, out: str, level: int, where: str | None = None) -> DataFrame:
    """Decoded chunks of one scale: shard, chunk_x.., voxels.  ``where``, on all but the voxels, prunes what is read."""
    rows = volumes.read_volume(spark, out, level)
    return chunked.decoded(rows.where(where) if where else rows, volumes.scale_at(out, level), ("shard", *codecs.KEYS))


def profile(spark: SparkSession, out: str, level: int, scale: Scale, done: DataFrame | None = None) -> DataFrame:
    """Chunks and label totals of every shard of a written scale; files of shards in ``done`` (shard) are not opened."""
    files = volumes.volume_files(spark, out, level)
    if done is not None:
        files = files.join(done.select(F.col("shard").cast("long")).distinct(), "shard", "left_anti")
    return labels.totals_by_shard(chunked.label_profile(chunked.decoded(volumes.read_files(files, scale), scale)), scale)


def profile_to(spark: SparkSession, out: str, level: int, scale: Scale, path: str) -> dict[str, int]:
    """Append the profiles of a scale's shards that ``path`` lacks; how many were made and how many were there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    done = materialize(spark.read.parquet(path).select("shard").distinct(), "profiled") if there else None
    made = materialize(profile(spark, out, level, scale, done), "profiles")
    made.write.mode("append").parquet(path)
    return {"ok": made.count(), "skipped": done.count() if done is not None else 0}


def empty_shards(spark: SparkSession, source: str, only: DataFrame | None = None) -> DataFrame:
    """Shards, of all or of those in ``only``, whose label lists hold background only."""
    return labels.nonempty(source_rows(spark, source, only=only), ["shard"]).where("not nonempty").select("shard")


def compare(spark: SparkSession, source: str, out: str, scale: Scale, level: int = 0, z_compress: int = 0) -> DataFrame:
    """Every output file of a scale with its state and the source shards that lead to it."""
    expected = list_shards(spark, source).select("shard", shard_filename(shard_of_name(scale, F.col("shard"), z_compress), scale.shard).alias("file"))
    return verification.compare_outputs(expected, written_files(spark, out, level))


def written_files(spark: SparkSession, out: str, level: int) -> DataFrame:
    """Names of a scale's files; none before it is written."""
    return volumes.volume_files(spark, out, level).select("file")


def verify(spark: SparkSession, source: str, out: str, scale: Scale, level: int = 0, z_compress: int = 0) -> DataFrame:
    """The one-row completeness report of a scale against its source shards."""
    return verification.report(compare(spark, source, out, scale, level, z_compress), level, scale.key)


def empty_of_report(spark: SparkSession, compared: DataFrame, source: str) -> DataFrame:
    """Of the source shards that a comparison misses, those that hold background only: no output is right for them.

    Only the missing ones are read.
    """
    return empty_shards(spark, source, verification.missing_sources(compared, 0).select("shard").distinct())
