"""Connected components of a graph as DataFrames: random-order contraction.

Each round gives every vertex the neighbour (or itself) with the smallest round-seeded hash and replaces both
ends of every edge by it; loops and repeats go.  A random order shrinks paths and stars alike by a constant
factor a round, so the rounds grow with the logarithm of the longest path.  Neither edges, labels nor
components ever reach the driver; each round's tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamellar.session import materialize, remove


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every vertex in ``edges`` (columns a, b; loops are ignored): equal roots, one component."""
    now = materialize(edges.where("a <> b").select("a", "b").distinct(), "cc-edges")
    steps: list[DataFrame] = []
    while not now.isEmpty():
        seed = F.lit(len(steps))
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min_by("b", F.struct(F.xxhash64("b", seed), F.col("b"))).alias("b"))
        order = lambda c: F.struct(F.xxhash64(c, seed), F.col(c))
        step = materialize(best.select(F.col("a").alias("node"), F.when(order("b") < order("a"), F.col("b")).otherwise(F.col("a")).alias("to")), "cc-step")
        steps.append(step)
        left = now.join(step.withColumnsRenamed({"node": "a", "to": "x"}), "a").select("b", "x")
        right = left.join(step.withColumnsRenamed({"node": "b", "to": "y"}), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        after = materialize(right.where("a <> b").distinct(), "cc-edges")
        remove(now)
        now = after
    remove(now)
    if not steps:
        return materialize(edges.where("false").select(F.col("a").alias("node"), F.col("b").alias("root")), "cc-found")
    found = materialize(steps[0].select("node", F.col("to").alias("root")), "cc-found")
    for step in steps[1:]:
        moved = found.join(step.withColumnsRenamed({"node": "root", "to": "next"}), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        moved = materialize(moved, "cc-found")
        remove(found)
        found = moved
    for step in steps:
        remove(step)
    return found
