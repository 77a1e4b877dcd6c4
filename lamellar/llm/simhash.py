"""SimHash near-duplicates by anchor-point covering.

A text's 64-bit fingerprint has a bit set if more than half of its shingles' XXH64 hashes do.  Fingerprints
that differ in at most ``bits`` bits are linked.  The 64 bits are cut into blocks; of two linked fingerprints
at least one block differs in at most ``bits // blocks`` places.  In each block the anchors are a covering
code: the perfect Hamming [15, 11] code on its first 15 bits (every pattern is within one bit of exactly one
codeword) and all patterns on its other bits.  A fingerprint is at home at its nearest anchor, at distance 1
at most, and visits every anchor within 1 + bits // blocks, so a linked pair meets at the home of either.
Homes are compared with visitors anchor by anchor, in numpy.

A second fingerprint of remixed hashes can widen the first to 128 bits, of which ``all_bits`` may differ: too many
for few blocks.  These are cut into ``all_bits // 2 + 1`` blocks, so that one differs in one bit at most, and every
pattern of a block is an anchor, home of the fingerprints that have it.  Of two patterns one bit apart exactly one
has odd parity; only fingerprints with odd ones visit, at all patterns one bit away.

Only distinct fingerprints are replicated, so copies never form a group.  An anchor that still draws very
many is split: its homes are dealt over slots and its visitors sent to each slot, so every comparison is made
once.  In a slot homes come first and are held, a few thousand; visitors stream past them in Arrow batches, so no
task holds the whole group.  A task reports what it links as forests, one per slot and batch, not as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamellar.session import fresh, materialize, remove, ship, spread, table

from .components import components

SHINGLE, BITS, BLOCKS, SEED = 4, 4, 3, 42
#: Homes of one anchor that one slot compares; more are dealt over further slots.
SLOT_HOMES = 4_000
#: Pairs of one dense tile: its temporaries stay in a core's cache.
TILE = 65_536
_CODE = 15
#: What tells rows apart where ids repeat.
ROW = ("doc_id", "text")


def hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of a text; of its whole word sequence, if shorter; none without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if n < shingle:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    h = xxhash.xxh64_intdigest
    return np.array([h(line[a:b], SEED) for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)], dtype=np.uint64)


def majority(h: np.ndarray) -> int:
    """The 64 bits that more than half of the hashes set."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), 32_768):
        counts += np.unpackbits(h[k : k + 32_768].astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(h)).tobytes(), "big")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text; 0 without words."""
    return majority(hashes(text, shingle))


def remixed(h: np.ndarray) -> np.ndarray:
    """Other 64 bits of the same shingles, for the second half of wide fingerprints."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, wide: bool = False, keyed: bool = False) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number, of every whole text; null counts as empty.

    ``wide`` adds ``more``, a second fingerprint from remixed hashes (else it is 0); ``keyed`` adds :data:`ROW` as key.
    """
    keys = [T.StructField("key", T.LongType())] if keyed else []
    schema = T.StructType([docs.schema["doc_id"], *keys, T.StructField("fp", T.LongType()), T.StructField("more", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, second = [], []
            for x in b.column(1):
                h = hashes(x.as_py() or "", shingle)
                first.append(majority(h))
                second.append(majority(remixed(h)) if wide else 0)
            arrays = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (first, second)]
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], *arrays], names=schema.names)

    return spread(docs.select("doc_id", "text", *([F.xxhash64(*ROW).alias("key")] if keyed else []))).mapInArrow(run, schema)


def _syndrome(e: int) -> int:
    """Hamming syndrome of the low 15 bits: the xor of the set bits' positions, counted from 1."""
    s = 0
    for k in range(_CODE):
        if e >> k & 1:
            s ^= k + 1
    return s


def _errors(width: int, radius: int) -> list[list[int]]:
    """By syndrome: all patterns of at most ``radius`` set bits whose xor with a block gives a codeword."""
    out: list[list[int]] = [[] for _ in range(_CODE + 1)]
    for r in range(radius + 1):
        for places in combinations(range(width), r):
            e = sum(1 << p for p in places)
            out[_syndrome(e)].append(e)
    return out


def widths(blocks: int) -> list[int]:
    return [64 // blocks + (k < 64 % blocks) for k in range(blocks)]


def _visit(block: Column, home: Column, tag: Column):
    """An error pattern as the anchor it leads to, tagged with the block, and whether that is the home."""
    return lambda e: F.struct(block.bitwiseXOR(e).bitwiseOR(tag).alias("anchor"), (e == home).alias("home"))


def anchored(fps: DataFrame, bits: int, blocks: int, visits: bool = True) -> DataFrame:
    """(anchor, home, node, fp, more): every fingerprint at all anchors that it visits; ``home`` marks its own one.

    Without ``visits`` homes only.
    """
    radius = 1 + bits // blocks
    rows: list[Column] = []
    low = 0
    for k, width in enumerate(widths(blocks)):
        block = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        parity = [F.bit_count(block.bitwiseAND(F.lit(sum(1 << p for p in range(_CODE) if p + 1 >> j & 1)))) % 2 for j in range(4)]
        syndrome = parity[0] + parity[1] * 2 + parity[2] * 4 + parity[3] * 8
        table_ = F.array(*(F.array(*(F.lit(e).cast("long") for e in own)) for own in _errors(width, radius)))
        nearest = F.array(F.lit(0).cast("long"), *(F.lit(1 << p).cast("long") for p in range(_CODE)))
        home = F.element_at(nearest, syndrome.cast("int") + 1)
        own = F.element_at(table_, syndrome.cast("int") + 1) if visits else F.array(home)
        rows.append(F.transform(own, _visit(block, home, F.lit(k << 58))))
        low += width
    return fps.select("node", "fp", "more", F.explode(F.concat(*rows)).alias("at")).select("at.anchor", "at.home", "node", "fp", "more")


def anchored_wide(fps: DataFrame, all_bits: int, visits: bool = True) -> DataFrame:
    """Like :func:`anchored`, over all 128 bits of fp and more; without ``visits`` homes only."""
    blocks = all_bits // 2 + 1
    rows: list[Column] = []
    low = 0
    for k in range(blocks):
        width = 128 // blocks + (k < 128 % blocks)
        block = F.shiftrightunsigned("fp", low) if low < 64 else F.shiftrightunsigned("more", low - 64)
        if low < 64 < low + width:
            block = block.bitwiseOR(F.shiftleft("more", 64 - low))
        block = block.bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        own = F.array(F.lit(0).cast("long"))
        if visits:
            near = F.array(*(F.lit(e).cast("long") for e in (0, *(1 << p for p in range(width)))))
            own = F.when(F.bit_count(block) % 2 == 1, near).otherwise(own)
        rows.append(F.transform(own, _visit(block, F.lit(0).cast("long"), F.lit(k << 58))))
        low += width
    return fps.select("node", "fp", "more", F.explode(F.concat(*rows)).alias("at")).select("at.anchor", "at.home", "node", "fp", "more")


def _joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels (each the smallest row of its tree) after the trees of x and y are joined pair by pair."""
    while True:
        a, b = label[x], label[y]
        apart = a != b
        if not apart.any():
            return label
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


Rows = tuple[np.ndarray, np.ndarray, np.ndarray]


def _linked(homes: Rows, others: Rows, near) -> tuple[np.ndarray, np.ndarray]:
    """Stars that connect the linked rows of ``homes`` x ``others`` (node, fp, more), in dense tiles."""
    node, n, m = np.concatenate([homes[0], others[0]]), len(homes[0]), len(others[0])
    label = np.arange(n + m)
    step = max(1, TILE // m)
    for at in range(0, n, step):
        x, y = divmod(np.flatnonzero(near(homes[1][at : at + step, None], homes[2][at : at + step, None], others[1], others[2])), m)
        x, y = x + at, y + n
        new = label[x] != label[y]
        if new.any():
            label = _joined(label, x[new], y[new])
    own = np.flatnonzero((label != np.arange(n + m)) & (node != node[label]))
    return node[own], node[label[own]]


def _compared(batches: Iterator[tuple[np.ndarray, ...]], near) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of each slot's homes to all its rows.  Batches (slot, home, node, fp, more) come by slot, homes first."""
    now, held = None, []
    for slot, home, *rows in batches:
        bounds = np.r_[np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]), len(slot)].tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if slot[a] != now:
                now, held = slot[a], []
            cut = a + int(home[a:b].sum())
            if cut > a:
                held = [np.concatenate(x) for x in zip(held, (r[a:cut] for r in rows), strict=True)] if held else [r[a:cut] for r in rows]
            if held and not (len(held[0]) == b - a == 1 and cut == b):
                found = _linked(tuple(held), tuple(r[a:b] for r in rows), near)
                if len(found[0]):
                    yield found


def links(fps: DataFrame, bits: int = BITS, blocks: int = BLOCKS, all_bits: int | None = None) -> DataFrame:
    """(a, b): forests that connect exactly the linked rows of ``fps`` (node, fp, more: distinct fingerprints).

    Linked are rows that differ in ``bits`` bits of fp at most or, with ``all_bits``, in so many of fp and more
    together; then ``bits`` and ``blocks`` mean nothing.
    """
    # A few MB that each row's 45 (or 10) anchors make many times larger: all cores share that work.
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "node")
    at, homes = ((anchored(fps, bits, blocks, v) if all_bits is None else anchored_wide(fps, all_bits, v)) for v in (True, False))
    crowded = homes.groupBy("anchor").agg(F.count(F.lit(1)).alias("homes")).where(F.col("homes") > SLOT_HOMES)
    crowded = materialize(crowded.select("anchor", F.ceil(F.col("homes") / SLOT_HOMES).cast("int").alias("slots")), "simhash-crowded")
    rest = ["node", "fp", "more"]
    # Adaptive execution broadcasts the crowded anchors if their size allows.
    at = at.join(crowded, "anchor", "left")
    mine = F.pmod(F.xxhash64("node"), F.col("slots")).cast("int")
    # A home is compared in one slot; it visits the others.
    all_slots = F.transform(F.sequence(F.lit(0), F.col("slots") - 1), lambda s: F.struct(s.alias("slot"), (F.col("home") & (s == mine)).alias("home")))
    one = F.array(F.struct(F.lit(0).alias("slot"), F.col("home").alias("home")))
    at = at.select("anchor", *rest, F.explode(F.when(F.col("slots").isNull(), one).otherwise(all_slots)).alias("to"))
    at = at.select(F.xxhash64("anchor", "to.slot").alias("slot"), F.col("to.home").alias("home"), *rest)
    dealt = at.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "slot").sortWithinPartitions("slot", F.desc("home"))

    def near(fp, more, other_fp, other_more):
        apart = np.bitwise_count(fp ^ other_fp)
        if all_bits is None:
            return apart <= bits
        apart += np.bitwise_count(more ^ other_more)
        return apart <= all_bits

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for b in batches:
            if b.num_rows:
                slot, home, node, fp, more = (b.column(k).to_numpy(zero_copy_only=False) for k in range(5))
                yield slot, home, node, fp.view(np.uint64), more.view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in _compared(rows(batches), near):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, blocks: int = BLOCKS, all_bits: int | None = None) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that links lead to, of every row.

    ``all_bits`` widens fingerprints to 128 bits, of which linked ones may differ in so many, wherever they are;
    ``bits`` and ``blocks`` are those of 64-bit fingerprints.  Texts without
    words have fingerprint 0 and link like any other.  Rows that repeat an id each keep a row; null ids join
    their class and never name it unless it has no other.  Other columns are not read.
    """
    return _grouped(docs, shingle, bits, blocks, all_bits).select("doc_id", "fp", F.col("least").alias("component_id"))


def _grouped(docs: DataFrame, shingle: int, bits: int, blocks: int, all_bits: int | None, keyed: bool = False) -> DataFrame:
    """doc_id, fp and the class's least doc_id of every row; ``keyed``: also key, and least is (absent, doc_id, key), null ids last."""
    ship(docs.sparkSession)
    own = materialize(fingerprints(docs, shingle, all_bits is not None, keyed), "simhash-fps")
    first = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "key") if keyed else F.col("doc_id")
    distinct = own.groupBy("fp", "more").agg(F.min(first).alias("least"))
    node = F.col("fp") if all_bits is None else F.xxhash64("fp", "more")
    distinct = materialize(distinct.withColumn("node", node), "simhash-distinct")
    found = components(links(distinct, bits, blocks, all_bits))
    rooted = distinct.join(found, "node", "left").select("fp", "more", "least", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "simhash-roots")
    least = materialize(rooted.groupBy("root").agg(F.min("least").alias("least")), "simhash-least")
    named = materialize(rooted.drop("least").join(least, "root").select("fp", "more", "least"), "simhash-named")
    for done in (distinct, found, rooted, least):
        remove(done)
    return own.join(named, ["fp", "more"]).drop("more")


def keep_first(docs: DataFrame, shingle: int = 5, all_bits: int = 25) -> DataFrame:
    """One document of each class, that with the smallest id, all columns; a null id stays with no other to keep.

    Linked are texts whose 128-bit fingerprints agree in 0.8 of their bits and more.  Of rows that share the
    smallest id of their class the one with the smallest hash of id and text stays, and once if repeated.  Texts are
    read whole, null ones as empty; an empty table gives an empty one; columns may have any names.
    """
    found = _grouped(docs, shingle, BITS, BLOCKS, all_bits, keyed=True)
    id_, key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), F.xxhash64(*ROW)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("key") == F.col("least.key")))
    own = fresh(docs, "__id", "__key")
    kept = kept.select(id_.alias(own[0]), F.col("key").alias(own[1])).distinct()
    # One exchange by id and key serves the join and the removal of repeats.
    return docs.withColumns(dict(zip(own, (id_, key), strict=True))).join(kept, own, "left_semi").dropDuplicates(own).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: near-duplicate classes of all documents."""
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
