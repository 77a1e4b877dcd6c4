"""The next row in the order of an id, without one task that sees all rows."""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamellar.session import fresh

from .expr import let

#: Bounds looked at before the step within them; keeps the search short for thousands of buckets.
STEP = 64
#: Compressed bytes of the input for one bucket, and buckets at most: their bounds are literals of the plan.
BUCKET_BYTES, MOST = 16 << 20, 20_000
#: The optimizer's estimate for inputs of unknown size is near the largest long.
UNKNOWN = 1 << 60
_LEAST = -(1 << 63)


def bounds(df: DataFrame, key: Column, buckets: int) -> list[tuple[int, int]]:
    """Ascending first (key, tie) of about equal buckets: one scan of the id column, ``buckets`` pairs at most.

    A key that fills several buckets (null ids, say) is cut by equal ranges of its rows' ties, which are hashes.
    The first bound is the least of all, so bucket i starts with bound i.
    """
    shares = F.array(*(F.lit(i / buckets) for i in range(1, buckets))) if buckets > 1 else F.array(F.lit(0.5))
    row = df.agg(F.min(key).alias("least"), F.approx_percentile(key, shares, 10_000).alias("cuts")).head()
    if row is None or row["least"] is None:
        return []
    cuts = Counter(row["cuts"])
    spans = {row["least"]: [_LEAST]} | {k: [_LEAST + (j << 64) // n for j in range(n)] for k, n in cuts.items()}
    return [(k, t) for k in sorted(spans) for t in spans[k]]


def _literal(rows: list[dict], schema: str) -> Column:
    """An array of structs as one literal, folded before the query runs."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema.replace(' ', ':')}>>".replace(",:", ","))


def bucket_of(key: Column, tie: Column, at: list[tuple[int, int]]) -> Column:
    """Index of the bucket that holds (key, tie): two short searches over literal bounds."""
    coarse, fine = (_literal([{"k": k, "t": t} for k, t in x], "k long, t long") for x in (at[::STEP], at))
    level = lambda c, x: F.size(F.filter(c, lambda b: b <= x))
    own = F.struct(key.alias("k"), tie.alias("t"))
    return let(own, lambda x: let(level(coarse, x), lambda k: (k - 1) * STEP + level(F.slice(fine, (k - 1) * STEP + 1, STEP), x) - 1))


def bucket_count(df: DataFrame) -> int:
    """As many buckets as shuffles have partitions, and more for tables (by the optimizer's estimate) that need them."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    needed = size // BUCKET_BYTES if size < UNKNOWN else 1
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST, needed))


def with_next(df: DataFrame, id_column: str, carried: list[str], prefix: str = "next_", tie_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` plus the ``carried`` columns of the row with the next higher id; the last row gets the first's.

    Ids that repeat follow each other in the order of a hash of ``tie_by`` (else of what is carried); null ids come
    first.  Rows are dealt to buckets of consecutive (id, hash); a bucket's first row is also sent, as a ghost, to
    the bucket before.  Columns of any names are kept.
    """
    k, tie, b, ghost, to = fresh(df, "__key", "__tie", "__b", "__ghost", "__to")
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(_LEAST))
    at = bounds(df.select(id_column), key, bucket_count(df))
    if not at:
        return df.select("*", *(F.lit(None).cast(df.schema[c].dataType).alias(prefix + c) for c in carried))
    dealt = df.withColumns({k: key, tie: F.xxhash64(*(tie_by or carried))})
    dealt = dealt.withColumn(b, bucket_of(F.col(k), F.col(tie), at))
    known = _literal([{"to": p, "k": x, "t": t} for p, x, t in _firsts(dealt, at, k, tie, b)], "to int, k long, t long")
    own = F.element_at(known, F.col(b) + 1)
    place = lambda bucket, is_ghost: F.struct(bucket.cast("int").alias("b"), F.lit(is_ghost).alias("ghost"))
    is_first = (F.col(k) == own["k"]) & (own["t"].isNull() | (F.col(tie) == own["t"]))
    here = place(F.col(b), 0)
    dealt = dealt.withColumn(to, F.explode(F.when(is_first, F.array(here, place(own["to"], 1))).otherwise(F.array(here))))
    dealt = dealt.select(*df.columns, k, tie, F.col(f"{to}.b").alias(b), F.col(f"{to}.ghost").alias(ghost)).repartitionById(len(at), b)
    w = Window.partitionBy(b).orderBy(ghost, k, tie)
    out = dealt.select("*", *(F.lead(c).over(w).alias(prefix + c) for c in carried))
    return out.where(F.col(ghost) == 0).drop(b, ghost, k, tie)


def _firsts(dealt: DataFrame, at: list[tuple[int, int]], k: str, tie: str, b: str) -> list[tuple[int, int, int | None]]:
    """(bucket before, key, tie or null for any) of each bucket's first row.

    A bucket's own bound is its first key, except where one key fills several buckets: their first ties, and which of
    them have rows at all, come from one more scan.
    """
    often = {x for x, n in Counter(x for x, _ in at).items() if n > 1}
    first: list[tuple[int, int | None] | None] = [(x, None) for x, _ in at]
    cut = [i for i, (x, _) in enumerate(at) if x in often]
    if cut:
        found = dealt.where(F.col(b).isin(cut)).groupBy(b).agg(F.min(F.struct(F.col(k).alias("k"), F.col(tie).alias("t"))).alias("m"))
        least = {r[b]: (r["m"]["k"], r["m"]["t"]) for r in found.collect()}
        for i in cut:
            first[i] = least.get(i)
    full = [i for i, f in enumerate(first) if f]
    before = {i: full[j - 1] for j, i in enumerate(full)}
    return [(before[i], *f) if (f := first[i]) else (-1, _LEAST, _LEAST) for i in range(len(at))]
