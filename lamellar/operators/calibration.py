"""Size-model calibration: regressions through the origin, percentiles, model comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamellar.session import fresh, materialize


def fit_one(rows: DataFrame, y: str, x: str, keys: list[str]) -> DataFrame:
    """y = a x: slope, R2 about the mean, and n, from sums alone."""
    d = lambda c: F.col(c).cast("double")
    s = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(d(x) * d(x)).alias("xx"), F.sum(d(x) * d(y)).alias("xy"), F.sum(d(y) * d(y)).alias("yy"), F.sum(d(y)).alias("sy"))
    a = F.when(F.col("xx") > 0, F.col("xy") / F.col("xx")).otherwise(0.0)
    s = s.withColumn("a", a)
    res = F.col("yy") - 2 * F.col("a") * F.col("xy") + F.col("a") * F.col("a") * F.col("xx")
    tot = F.col("yy") - F.col("sy") * F.col("sy") / F.col("n")
    return s.select(*keys, "n", "a", F.when(tot > 0, 1 - res / tot).otherwise(0.0).alias("r2"))


def fit_two(rows: DataFrame, y: str, x1: str, x2: str, keys: list[str]) -> DataFrame:
    """y = a x1 + b x2 by the normal equations; null coefficients under three rows or when they are singular."""
    d = lambda c: F.col(c).cast("double")
    pairs = {"s11": (x1, x1), "s12": (x1, x2), "s22": (x2, x2), "s1y": (x1, y), "s2y": (x2, y)}
    s = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *(F.sum(d(p) * d(q)).alias(k) for k, (p, q) in pairs.items()))
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    ok = (F.col("n") >= 3) & (F.abs(det) >= 1e-10)
    return s.select(*keys, "n", F.when(ok, (F.col("s1y") * F.col("s22") - F.col("s2y") * F.col("s12")) / det).alias("a"), F.when(ok, (F.col("s2y") * F.col("s11") - F.col("s1y") * F.col("s12")) / det).alias("b"))


#: Bins of one pass of :func:`percentiles`.
BINS = 4096


def _bin(value: Column, low: Column, high: Column, exact: bool) -> Column:
    """Which of BINS equal parts of [low, high] a value lies in: 0 for low, the last for high, never falling in between."""
    part = (lambda c: c.cast("decimal(38,9)")) if exact else (lambda c: c.cast("double") / 2)
    share = (part(value) - part(low)).cast("double") / (part(high) - part(low)).cast("double")
    return F.when(value == high, BINS - 1).otherwise(F.least(F.floor(share * (BINS - 1)), F.lit(BINS - 2))).cast("int")


def percentiles(rows: DataFrame, value: str, keys: list[str], points: tuple[int, ...] = (50, 95, 100)) -> DataFrame:
    """Nearest-index percentiles: the sorted value at min(int(p / 100 * n), n - 1), exactly.  Nulls and NaN are left out.

    Selection by refined histograms: each pass counts the values of every group in equal bins between the bounds that are
    left for a point, and keeps the bin that holds the wanted rank, until it holds one value.  Nothing is sorted but at most
    BINS counts a group and point; some three passes over (keys, value) do for evenly spread values.
    """
    kind = rows.schema[value].dataType.typeName()
    exact = kind in ("byte", "short", "integer", "long", "decimal")
    wanted = F.col(value).isNotNull() if exact else F.col(value).isNotNull() & ~F.isnan(value)
    v, p, lo, hi, rank, n, b, *own_keys = fresh(rows.select(*keys), "__v", "__p", "__lo", "__hi", "__rank", "__n", "__bin", *(f"__{k}" for k in keys))
    own = materialize(rows.where(wanted).select(*keys, F.col(value).alias(v)), "values")
    ends = own.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.min(v).alias(lo), F.max(v).alias(hi))
    point = F.explode(F.array(*(F.struct(F.lit(k).alias(p), F.least(F.floor(F.lit(k / 100) * F.col(n)), F.col(n) - 1).cast("long").alias(rank)) for k in points)))
    found = None
    state = ends.withColumn("x", point).select(*keys, f"x.{p}", lo, hi, f"x.{rank}")
    while True:
        state = materialize(state, "bounds")
        done = state.where(F.col(lo) == F.col(hi)).select(*keys, p, lo)
        found = done if found is None else found.unionByName(done)
        left = state.where(F.col(lo) < F.col(hi))
        if left.isEmpty():
            break
        named = left.select(*(F.col(k).alias(o) for k, o in zip(keys, own_keys, strict=True)), p, lo, hi, rank)
        same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own_keys, strict=True)), F.col(v).between(F.col(lo), F.col(hi)))
        bins = own.join(named, same).groupBy(*keys, p, rank, _bin(F.col(v), F.col(lo), F.col(hi), exact).alias(b)).agg(F.count(F.lit(1)).alias(n), F.min(v).alias(lo), F.max(v).alias(hi))
        upto = F.sum(n).over(Window.partitionBy(*keys, p).orderBy(b))
        bins = bins.withColumn("upto", upto).where((F.col("upto") > F.col(rank)) & (F.col("upto") - F.col(n) <= F.col(rank)))
        state = bins.select(*keys, p, lo, hi, (F.col(rank) - F.col("upto") + F.col(n)).alias(rank))
    return found.groupBy(*keys).agg(*(F.max(F.when(F.col(p) == k, F.col(lo))).alias(f"p{k}") for k in points))


def correlate(sources: DataFrame, outputs: DataFrame, label_stats: DataFrame) -> DataFrame:
    """Source shards with their output's bytes (by number) and label totals (by scale, shard); nulls where unmatched."""
    out = sources.join(outputs.select(F.col("number"), F.col("bytes").alias("output_bytes")), "number", "left")
    return out.join(label_stats, ["scale", "shard"], "left")


def match_counts(correlated: DataFrame, label_column: str) -> DataFrame:
    """How many source shards matched on each side."""
    miss = lambda c: F.count(F.when(F.col(c).isNull(), 1))
    return correlated.groupBy("scale").agg(F.count(F.lit(1)).alias("sources"), miss("output_bytes").alias("no_output"), miss(label_column).alias("no_labels"))


def collisions(sources: DataFrame, key: str = "number") -> DataFrame:
    """Outputs that several sources lead to."""
    return sources.groupBy(key).agg(F.count(F.lit(1)).alias("sources")).where("sources > 1")


def bytes_per_chunk(rows: DataFrame) -> DataFrame:
    """Largest output bytes per chunk of each scale."""
    return rows.where("chunks > 0").groupBy("scale").agg(F.max(F.col("output_bytes") / F.col("chunks")).alias("max_bytes_per_chunk"))


def tier_histogram(rows: DataFrame, tiers: dict[str, Column], all_tiers: tuple[int, ...] = (4, 8, 16, 24, 32)) -> DataFrame:
    """Shards per tier under several models: one row per tier, one column per model."""
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(k).alias("model"), c.alias("tier")) for k, c in tiers.items()))).alias("t")).select("t.*")
    return long.groupBy("tier").pivot("model", sorted(tiers)).count().na.fill(0).where(F.col("tier").isin(*all_tiers))
