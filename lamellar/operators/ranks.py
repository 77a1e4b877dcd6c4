"""Positions and running sums over a whole order, without one task that sees all rows.

Rows are dealt to sorted ranges of the order and written, so that ranges and the order in them are settled.  Each range's total
is one small row; the totals before a range, plus the sum within it, are a row's running sum.  Windows run over a range, or
over one row per range, never over the table or a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamellar.session import fresh, materialize


def running(rows: DataFrame, order: list[str], by: list[Column] | None = None, weight: str | None = None, low: str = "low", high: str = "high") -> DataFrame:
    """``rows`` plus ``low`` and ``high``, the sums of ``weight`` (1 by default) before and up to a row, within each group of ``by``.

    Rows of equal order may follow each other in any order; nulls come first, null weights count as 0, and null keys are a group.
    """
    row, part, first, before, value, *keys = fresh(rows, "__row", "__part", "__first", "__before", "__value", *(f"__by{k}" for k in range(len(by or []))))
    own = rows.withColumns(dict(zip(keys, by or [], strict=True)) | {value: F.coalesce(F.col(weight), F.lit(0)) if weight else F.lit(1).cast("long")})
    sort = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    dealt = materialize(own.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn(row, F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumn(part, F.shiftrightunsigned(row, 33))
    spans = dealt.groupBy(part, *keys).agg(F.min(row).alias(first), F.sum(value).alias(before))
    spans = spans.withColumn(before, F.sum(before).over(Window.partitionBy(*keys).orderBy(part)) - F.col(before))
    spans = materialize(spans.toDF(*(f"{c}_" for c in spans.columns)), "spans")
    same = F.col(part) == F.col(f"{part}_")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    if weight:
        within = Window.partitionBy(part, *keys).orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
        dealt = dealt.withColumn(high, F.sum(value).over(within))
    else:
        dealt = dealt.withColumn(high, F.col(row))
    found = dealt.join(spans, same)
    top = F.col(f"{before}_") + F.col(high) - (F.lit(0) if weight else F.col(f"{first}_") - 1)
    return found.select(*rows.columns, (top - F.col(value)).alias(low), top.alias(high))
