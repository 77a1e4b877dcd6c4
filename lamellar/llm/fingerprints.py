"""Document fingerprints: bottom-k sketches of word shingle hashes, native Spark expressions only.

A sketch is the ascending array of the k smallest distinct 64-bit hashes of a text's five-word shingles (of
its whole word sequence, if shorter; empty without words).  Sketches of parts merge into the sketch of the
whole, and two sketches estimate resemblance, containment and the number of distinct shingles.  A sketch of
fewer than k hashes holds all of them, and estimates from it are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamellar.session import fresh, spread, table

from .expr import let, window_hashes, words
from .ordering import with_next

K = 128
SHINGLE = 5


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The bottom-k sketch of a text; empty for null and for texts without a word."""

    def hashes(h: Column) -> Column:
        short = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= shingle, window_hashes(h, shingle)).otherwise(short)

    h = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.slice(F.sort_array(F.array_distinct(let(h, hashes))), 1, k)


def union(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge(sketches: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of ``keys``.  Each task passes on at most k hashes of a group, however large."""
    h, place = fresh(sketches, "__h", "__rank")
    hashes = sketches.select(*keys, F.explode(column).alias(h)).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(h))
    kept = hashes.withColumn(place, rank).where(F.col(place) <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list(h)).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; two empty sketches are alike (1)."""
    shared = lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)).cast("double") / F.size(u)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).when(a == b, 1.0).otherwise(let(union(a, b, k), shared))


def distinct_count(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(s, -1).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too; 1 for an empty ``a``."""
    both = resemblance(a, b, k) * distinct_count(union(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def encoded(s: Column) -> Column:
    """A sketch as text: base64 of its hashes, eight bytes each."""
    return F.base64(F.unhex(F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points replaced by as many, or all, of the first of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: fingerprints of all documents, of their edited texts, and likeness to these and to the next one.

    Null texts count as empty.  The texts are dealt once, with their sketches, to buckets of consecutive ids.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("sketch", sketch(F.col("text")))
    both = with_next(docs, "doc_id", ["text", "sketch"], tie_by=("text",))
    both = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sketch", "next_sketch", edited(F.col("text"), F.col("next_text")).alias("edited"))
    both = both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch", sketch(F.col("edited")).alias("edited_sketch"))
    own, next_, changed = F.col("sketch"), F.col("next_sketch"), F.col("edited_sketch")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", encoded(own).alias("fingerprint"), encoded(changed).alias("edited_fingerprint"),
        resemblance(own, changed).alias("near_edited"), resemblance(own, next_).alias("near_next"), distinct_count(own).alias("n_shingles"),
    )
