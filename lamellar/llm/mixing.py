"""Mixing sources to target weights by Poisson replication, native Spark expressions only.

A source's rate is the copies that the target asks for over the documents it has.  A document's copies are
the inverse of that Poisson distribution at a uniform number hashed from the seed and its id, so the draw
depends on nothing else: not on partitioning, order or retries.  Rates above ``PART`` are the sum of equal
independent draws, which is the same distribution and keeps exp() in range.  Copies are dealt out by a hash
of (seed, id, copy) and sorted by it within partitions: a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.session import fresh, materialize

from .expr import upto

PART = 32.0
#: Sources up to which their rate table is broadcast (about 1 KB each); beyond, it is joined on a salted key.
BROADCAST_SOURCES = 5_000
SALTS = 64
SEED = 42


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _cdf(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, ... until they are 1 within a double's precision."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 24)
    term = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("s"))
    step = lambda a, j: F.struct((a["p"] * rate / j).alias("p"), (a["s"] + a["p"] * rate / j).alias("s"))
    return F.transform(upto(top), lambda k: F.aggregate(upto(k), term, lambda a, j: step(a, j + 1))["s"])


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, exponent: float = 0.5, total: float | None = None) -> DataFrame:
    """source, n, rate, parts, cdf.  ``weights``: a source's share of ``total`` rows (default: as many as there are).

    Without ``weights`` a source's share is proportional to its document count to the power ``exponent``.
    Sources missing from ``weights`` get none; null is a source of its own.
    """
    n = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is not None:
        rows = [(s, float(w)) for s, w in weights.items()]
        given = docs.sparkSession.createDataFrame(rows, "w_source string, w double")
        n = n.join(given, F.col("source").eqNullSafe(F.col("w_source")), "left").select("source", "n", F.coalesce("w", F.lit(0.0)).alias("w"))
    else:
        n = n.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(exponent)))
    sums = n.agg(F.sum("w").alias("w_all"), F.sum("n").alias("n_all"))
    size = F.lit(float(total)) if total is not None else F.col("n_all").cast("double")
    rate = F.when(F.col("w_all") > 0, size * F.col("w") / F.col("w_all") / F.col("n")).otherwise(0.0)
    out = n.join(F.broadcast(sums), F.col("n") > 0).select("source", "n", rate.alias("rate"))  # sums: one row
    out = out.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
    return out.withColumn("cdf", _cdf(F.col("rate") / F.col("parts")))


def replicate(docs: DataFrame, weights: dict[str | None, float] | None = None, exponent: float = 0.5, total: float | None = None, seed: int = SEED, keep_draw: bool = False) -> DataFrame:
    """``docs``, each row as often as drawn, globally shuffled; all columns stay.

    ``keep_draw`` adds n_copies, copy (from 0) and shuffle_key, in place of columns of these names; no other name
    clashes.  Rows that repeat an id are drawn alike but each for itself; a null id is drawn as an empty string;
    texts, however long, are not looked at; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    source, parts, cdf, salt, own, u, n, copy, key, deal = fresh(docs, "__source", "__parts", "__cdf", "__salt", "__own", "__u", "__n", "__copy", "__key", "__deal")
    found = materialize(rates(docs, weights, exponent, total), "mixing-rates")
    rated = found.select(F.col("source").alias(source), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    if found.count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(rated), F.col("source").eqNullSafe(F.col(source)))
    else:
        salted = rated.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = docs.withColumn(own, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, F.col("source").eqNullSafe(F.col(source)) & (F.col(own) == F.col(salt))).drop(own, salt)
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    draw = lambda k: F.size(F.filter(F.col(cdf), lambda c: c <= uniform(F.lit(str(seed)), id_, k.cast("string"))))
    single = F.col(u)
    joined = joined.withColumn(u, uniform(F.lit(str(seed)), id_, F.lit("0")))
    first = F.size(F.filter(F.col(cdf), lambda c: c <= single))
    copies = first + F.when(F.col(parts) > 1, F.aggregate(F.sequence(F.lit(1), F.col(parts) - 1), F.lit(0), lambda a, k: a + draw(k))).otherwise(0)
    # Rows that share an id (null ones, say) share a key; a row's place in its split deals them out all the same.
    drawn = joined.withColumn(deal, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).withColumn(n, copies).where(F.col(n) > 0).withColumn(copy, F.explode(upto(F.col(n))))
    drawn = drawn.withColumn(key, F.md5(F.concat_ws("|", F.lit(str(seed + 1)), id_, F.col(copy).cast("string"))))
    drawn = drawn.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key, deal).sortWithinPartitions(key)
    extra = [F.col(n).cast("long").alias("n_copies"), F.col(copy).cast("long").alias("copy"), F.col(key).alias("shuffle_key")] if keep_draw else []
    added = ("n_copies", "copy", "shuffle_key") if keep_draw else ()
    return drawn.select(*(c for c in docs.columns if c not in added), *extra)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: all documents mixed to square-root weights of their sources, as many rows as before on average."""
    from lamellar.session import table

    return replicate(table(spark, sf_dir, "documents"), keep_draw=True)


ORACLE = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, (SELECT sum(n) FROM n)::DOUBLE * sqrt(n) / (SELECT sum(sqrt(n)) FROM n) / n AS rate FROM n),
c AS (SELECT source, list_transform(range(0, 60), lambda k: list_sum(list_transform(range(0, k + 1), lambda j: exp(-rate + j * ln(rate) - lgamma(j + 1))))) AS cdf FROM r),
d AS (SELECT documents.*, len(list_filter(cdf, lambda p: p <= ('0x' || substr(md5('42|' || doc_id || '|0'), 1, 13))::BIGINT / 4503599627370496.0))::BIGINT AS n_copies
      FROM documents JOIN c ON documents.source IS NOT DISTINCT FROM c.source),
e AS (SELECT *, unnest(range(0, n_copies))::BIGINT AS copy FROM d)
SELECT *, md5('43|' || doc_id || '|' || copy) AS shuffle_key FROM e
"""
