"""Exact label sets of chunks as bitmaps, which merge up a pyramid without its lists being exploded again.

Labels get dense numbers once, in the order of the first chunk (by Morton code) that has them, so that what lies together shares
words.  A set is a row per 64 numbers it has any of, its bits one long: a set of one label is as small as the label's own row, and
no set has more rows than labels.  A level up is an OR of at most eight sets by bucket, a hash aggregate over numbers; counts are
counts of bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamellar.functions.geometry import Scale, axis_factors, morton

from . import ranks

AT = ("chunk_x", "chunk_y", "chunk_z")


def numbered(rows: DataFrame, scale: Scale) -> DataFrame:
    """(label, number): numbers from 1 on for the labels of ``rows`` (chunk_x.., label); null labels have none."""
    first = rows.where("label is not null").groupBy("label").agg(F.min(morton(scale, *(F.col(a) for a in AT))).alias("first"))
    return ranks.running(first, ["first", "label"]).select("label", F.col("high").alias("number"))


def sets(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Sets (chunk_x.., bucket, bits) of chunks from a row per chunk and label, repeats and nulls allowed."""
    return merged(words(rows, numbers), list(AT))


def words(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """What :func:`sets` merges: the word (chunk_x.., bucket, bits) of each row's own label."""
    own = [F.expr("shiftright(number, 6)").alias("bucket"), F.expr("shiftleft(1L, cast(number & 63 as int))").alias("bits")]
    return rows.select(*AT, "label").join(numbers, "label").select(*AT, *own)


def merged(own: DataFrame, keys: list[str]) -> DataFrame:
    """The unions of sets by ``keys``, columns of theirs that are not ``bits``; ``bucket`` is kept."""
    return own.groupBy(*keys, "bucket").agg(F.bit_or("bits").alias("bits"))


def raised(own: DataFrame, parent: Scale, child: Scale) -> DataFrame:
    """Sets of the next scale's chunks: the unions over their parents' sets."""
    up = [F.expr(f"cast({a} div {f} as {own.schema[a].dataType.simpleString()})").alias(a) for a, f in zip(AT, axis_factors(parent, child), strict=True)]
    return merged(own.select(*up, "bucket", "bits"), list(AT))


def counts(own: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct labels of each set: keys (chunk_x.. by default), unique_labels."""
    return own.groupBy(*(keys or AT)).agg(F.sum(F.bit_count("bits")).alias("unique_labels"))
