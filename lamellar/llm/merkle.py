"""Merkle manifest of a dataset: one root over all rows, a subroot per group, and a proof for every row.

A leaf is the hash of a row's columns.  Within a group the leaves stand in the order of a key; every ``fanout``
consecutive nodes (the last run may hold fewer) become the hash of their digests until one node, the subroot, is left;
the subroots, in the order of the groups (null first, by UTF-8 bytes), are reduced likewise to the root.

Superblock reduction: nodes are dealt to buckets of ``fanout ** levels`` consecutive indices; one ``applyInPandas`` call
collapses that many levels of a bucket and yields its root and the lower part of every node's proof.  The bucket roots
are the nodes of the next round.  The upper parts come down the same way: a node's proof is its own part within the
bucket followed by the proof of the bucket.  No task ever holds more than a bucket, and a group of a third of all rows
is as many buckets as its rows need.

Indices come without a window over a group: rows are sorted by ranges of (group, key, leaf) and written; a row's index
is its place in its range plus the rows of its group in the ranges before, known from one small row per range and group.

Texts are hashed by Spark and read once; what is shuffled afterwards are digests.  Rows of equal group and key follow
each other by leaf, so that equal rows are interchangeable; null keys come first; null groups are a group of their own;
an empty table has an empty manifest; columns that are not hashed are not read.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamellar.session import materialize, remove, ship, spread, table

FANOUT = 3
#: Levels that one bucket collapses: 3 ** 7 = 2187 nodes, some 200 KB.
LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """A value as hashed: ``-`` for null, else its UTF-8 byte count, a colon and the value as text."""
    s = c.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(*values: Column) -> Column:
    """The digest of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def parent(digests: bytes) -> bytes:
    """The digest of a run of digests, which are hashed as lowercase hex text."""
    return hashlib.sha256(hexlify(digests)).digest()


def height(size: int, fanout: int = FANOUT) -> int:
    """Levels above ``size`` nodes until one is left."""
    levels = 0
    while size > 1:
        size, levels = -(-size // fanout), levels + 1
    return levels


def collapse(nodes: list[bytes], levels: int, fanout: int = FANOUT) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """(nodes left after ``levels``, each first node's path, its siblings).

    A path has two bytes a level, the place in the run and the run's length; siblings are concatenated from below.
    """
    layers = []
    for _ in range(levels):
        layers.append([nodes[i : i + fanout] for i in range(0, len(nodes), fanout)])
        nodes = [parent(b"".join(run)) for run in layers[-1]]
    paths, siblings = [b""] * len(nodes), [b""] * len(nodes)
    for runs in reversed(layers):
        above = list(zip(runs, paths, siblings, strict=True))
        paths = [bytes((i, len(run))) + p for run, p, _ in above for i in range(len(run))]
        siblings = [b"".join(run[:i] + run[i + 1 :]) + s for run, _, s in above for i in range(len(run))]
    return nodes, paths, siblings


def fold(digest: bytes, path: bytes, siblings: bytes) -> bytes:
    """The root that a node and its proof lead to."""
    at = 0
    for i, width in zip(path[::2], path[1::2], strict=True):
        mid, end = at + 32 * i, at + 32 * (width - 1)
        digest = parent(siblings[at:mid] + digest + siblings[mid:end])
        at = end
    return digest


def numbered(nodes: DataFrame, order: list[str], group: str | None = None) -> DataFrame:
    """``nodes`` plus ``tree`` (the group's rank), ``place`` (0-based index within it) and ``size`` (its rows)."""
    held = [group] if group else []
    keys = [F.col(c).asc_nulls_first() for c in [*held, *order]]
    dealt = materialize(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("row", 33)
    spans = dealt.groupBy(part.alias("part"), *held).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(*held)
    spans = spans.select(*held, "part", "first", (F.sum("n").over(whole.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(whole).alias("size"))
    if group:
        spans = materialize(spans.withColumnRenamed(group, "of"), "merkle-spans")
        ranks = numbered(spans.select(F.col("of").alias("ranked")).distinct(), ["ranked"]).select("ranked", F.col("place").alias("tree"))
        spans = spans.join(ranks, F.col("of").eqNullSafe(F.col("ranked"))).drop("ranked")
    else:
        spans = spans.withColumn("tree", F.lit(0).cast("long"))
    spans = materialize(spans, "merkle-spans")
    same = (part == F.col("part")) & (F.col(group).eqNullSafe(F.col("of")) if group else F.lit(True))
    place = F.col("before") + F.col("row") - F.col("first")
    return dealt.join(spans, same).select(*nodes.columns, "tree", place.alias("place"), "size")


def _superblocks(nodes: DataFrame, carried: list[str], fanout: int, levels: int) -> DataFrame:
    """One round: every node's ``path`` and ``siblings`` within its bucket, and the bucket's ``top`` in its first row."""
    block = fanout**levels
    dealt = nodes.select("tree", F.expr(f"place div {block}").alias("bucket"), "place", "size", "digest", *carried)
    binary = [T.StructField(c, T.BinaryType()) for c in ("path", "siblings", "top")]
    schema = T.StructType([*dealt.schema.fields, *binary])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", ignore_index=True)
        tops, paths, siblings = collapse(list(map(bytes, rows["digest"])), min(levels, height(int(rows["size"].iat[0]), fanout)), fanout)
        return rows.assign(path=paths, siblings=siblings, top=[*tops, *[None] * (len(rows) - 1)])

    return dealt.groupBy("tree", "bucket").applyInPandas(run, schema)


def _rounds(nodes: DataFrame, carried: list[str], fanout: int, levels: int) -> list[DataFrame]:
    """All rounds of every tree; the last one's tops are the trees' roots."""
    tallest = nodes.agg(F.max("size")).head()[0] or 0
    rounds = []
    for k in range(max(1, -(-height(tallest, fanout) // levels))):
        rounds.append(materialize(_superblocks(nodes, [] if k else carried, fanout, levels), "merkle-round"))
        nodes = rounds[-1].where(F.col("top").isNotNull())
        nodes = nodes.select("tree", F.col("bucket").alias("place"), F.expr(f"(size + {fanout**levels - 1}) div {fanout**levels}").alias("size"), F.col("top").alias("digest"))
    return rounds


def _proofs(rounds: list[DataFrame], above: DataFrame, ends: list[str]) -> DataFrame:
    """Whole proofs of the first round's nodes: lower parts joined to ``above`` (tree, place, path, siblings, ends)."""
    for k, lower in reversed(list(enumerate(rounds))):
        upper = above.select(F.col("tree").alias("of"), F.col("place").alias("at"), F.col("path").alias("rest"), F.col("siblings").alias("more"), *ends)
        found = lower.join(upper, (F.col("tree") == F.col("of")) & (F.col("bucket") == F.col("at")))
        whole = [F.concat("path", "rest").alias("path"), F.concat("siblings", "more").alias("siblings")]
        above = found.select(*(c for c in lower.columns if c not in ("bucket", "path", "siblings", "top")), *whole, *ends)
        if k:
            above = materialize(above, "merkle-upper")
    return above


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", columns: tuple[str, ...] = COLUMNS, fanout: int = FANOUT, levels: int = LEVELS, carry: dict[str, Column] | None = None) -> DataFrame:
    """``key`` (an integer or a string), ``tree``, ``place``, ``leaf``, ``path``, ``siblings``, ``subroot``, ``root`` of every row.

    ``carry``: more binary columns computed from ``docs``, as an altered row's leaf.
    """
    if fanout < 2 or fanout > 255:
        raise ValueError("a run has 2 to 255 nodes")
    ship(docs.sparkSession)
    carry = carry or {}
    kept = ["key", *carry]
    known = [F.col(key).alias("key"), F.col(group).cast("string").alias("member"), leaf(*(F.col(c) for c in columns)).alias("digest")]
    leaves = materialize(spread(docs).select(*known, *(c.alias(n) for n, c in carry.items())), "merkle-leaves")
    nodes = numbered(leaves, ["key", "digest"], "member").withColumn("key", F.col("key").cast("string"))
    rounds = _rounds(nodes, kept, fanout, levels)
    remove(leaves)
    subroots = rounds[-1].where(F.col("top").isNotNull()).select("tree", F.col("top").alias("digest"))
    forest = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest")
    forest = forest.crossJoin(subroots.agg(F.count("*").alias("size")))  # one row on the right
    upper = _rounds(forest, [], fanout, levels)
    top = upper[-1].where(F.col("top").isNotNull()).select("tree", F.lit(0).cast("long").alias("place"), F.lit(b"").alias("path"), F.lit(b"").alias("siblings"), F.col("top").alias("root"))
    above = _proofs(upper, top, ["root"]).select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "path", "siblings", F.col("digest").alias("subroot"), "root")
    proofs = _proofs(rounds, materialize(above, "merkle-upper"), ["subroot", "root"])
    typed = F.col("key").cast(docs.schema[key].dataType).alias(key)
    return proofs.select(typed, "tree", "place", F.col("digest").alias("leaf"), "path", "siblings", "subroot", "root", *carry)


def folded(proofs: DataFrame, leaf_column: str = "leaf") -> DataFrame:
    """``proofs`` plus ``folded``, the root that ``leaf_column`` and the proof lead to; null for a null leaf."""
    ship(proofs.sparkSession)
    schema = T.StructType([*proofs.schema.fields, T.StructField("folded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in (leaf_column, "path", "siblings")), strict=True)
            ends = [None if d is None else fold(d, p, s) for d, p, s in rows]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends, pa.binary())], names=schema.names)

    return proofs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: manifest of all documents, proofs, and their check after some texts have lost their line ends.

    Rows with an even crc32 of the decimal doc_id are tampered with; a null id has none.
    """
    docs = table(spark, sf_dir, "documents")
    changed = leaf(*(F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in COLUMNS))
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = folded(manifest(docs, carry={"altered": F.when(even & F.contains("text", F.lit("\n")), changed)}).withColumn("shown", F.coalesce("altered", "leaf")), "shown")
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return found.select(
        "doc_id", text("leaf"), text("subroot"), text("root"), F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
