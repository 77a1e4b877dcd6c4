"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A byte goes if a ``depth``-byte string that covers it also starts anywhere else.  Suffixes are ordered only
through their first ``depth`` bytes, by most-significant-digit passes; each pass drops the suffixes that are
alone with their digits, and what is still together after the last pass are exactly the repeated windows.

A window's bytes are read outward from its *minimizer*, the leftmost of its ``GRAM``-byte grams with the smallest
hash.  Equal windows have it at the same offset, so this is one fixed order of digits, and it makes the first
digit common to all windows around one minimizer: the first pass sorts one row per minimizer (about one in 170
bytes) instead of one per byte.

A run of a short period (padding, a line over and over) would have a minimizer per period.  Its windows are copies of each
other, so the whole run goes, and only two periods of its windows at either end take part in the passes, to be found by
others.

1. First digit: the gram.  Minimizers whose gram occurs once are done.  Those whose whole surroundings
   (``depth`` bytes either way) occur twice are done too: all their windows are repeated.
2. Second digit, for one minimizer per distinct surroundings: offsets in blocks of ``BLOCK``.  The bytes common to
   all windows of a block must occur again at the same offsets; if the bytes of all of them together do, the
   block's windows are all repeated.
3. Third digit: single offsets of the blocks still undecided, that is, whole windows.

The gram only chooses candidates, by a 64-bit hash.  What decides that windows are equal is a 128-bit BLAKE2b digest
of their bytes: no text, however structured, makes two of them meet, and by chance 10^11 windows do so with a
probability of 10^-17.  A pass deals rows by their digit; equal ones need no order among them, so they are counted,
with map-side combining, and joined back between written tables, whose skewed partitions adaptive execution splits.
No pairs are formed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.session import materialize, remove, ship, table

DEPTH, GRAM, BLOCK = 400, 64, 32
#: Bytes of a text that are looked at together; longer texts go through in overlapping pieces.
PIECE = 1 << 20
#: Periods below this make a run that is taken as one unit.
PERIOD = 128

_ODD = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


class Rolling:
    """Hashes of any substring from prefix sums: polynomial over a random number per byte, modulo 2**64."""

    size = 0
    up: np.ndarray
    down: np.ndarray
    letters = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)

    @classmethod
    def grow(cls, n: int) -> None:
        if cls.size < n:
            cls.size = max(n, 1 << 14)
            powers = lambda x: np.multiply.accumulate(np.r_[np.uint64(1), np.full(cls.size - 1, np.uint64(x))])
            cls.up, cls.down = powers(_ODD), powers(pow(_ODD, -1, 1 << 64))

    def __init__(self, data: np.ndarray):
        self.grow(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        h ^= h >> _HALF
        h *= _MIX
        return h ^ (h >> _HALF)


def _slide_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours."""
    step = 1
    while step * 2 <= w:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[: len(h) - (w - step)], h[w - step :]) if step < w else h


def _agree(data: np.ndarray, x: int, p: int, step: int) -> int:
    """How far from ``x`` on, in the direction of ``step``, bytes equal those ``p`` after them."""
    done, size = 0, 1024
    while True:
        if step > 0:
            m = min(size, len(data) - p - x - done)
            own = data[x + done : x + done + m] != data[x + done + p : x + done + p + m]
        else:
            m = min(size, x - done)
            own = (data[x - done - m : x - done] != data[x - done - m + p : x - done + p])[::-1]
        if own.any():
            return done + int(own.argmax())
        done, size = done + m, min(2 * size, 1 << 20)
        if not m:
            return done


def periodic(data: np.ndarray, depth: int = DEPTH) -> list[tuple[int, int, int]]:
    """(start, end, period) of the text's runs of a short period that have more than ``depth`` windows to spare.

    Every PERIOD-th place is compared with the PERIOD - 1 after it, eight bytes at a time; what agrees there is checked and
    followed both ways byte by byte.
    """
    n, runs = len(data), []
    if n < 3 * depth:
        return runs
    words = np.ndarray((n - 7,), "<u8", data, strides=(1,))
    places = np.arange(0, n - 7 - PERIOD, PERIOD)
    for k in range(0, len(places), 8192):
        own = places[k : k + 8192]
        same = words[own[:, None] + np.arange(1, PERIOD)] == words[own][:, None]
        for i in np.flatnonzero(same.any(1)).tolist():
            x = int(own[i])
            if runs and x < runs[-1][1]:
                continue
            for p in (np.flatnonzero(same[i]) + 1).tolist():
                right = _agree(data, x, p, 1)
                if right < GRAM:
                    continue
                a, z = x - _agree(data, x, p, -1), x + right + p
                if z - a > 2 * depth + 4 * p:
                    runs.append((a, z, p))
                    break
    return runs


def minimizers(data: np.ndarray, depth: int = DEPTH, gram: int = GRAM, runs: list[tuple[int, int, int]] | None = None) -> tuple[np.ndarray, ...]:
    """Arrays (pos, low, high, key) for each minimizer of a text's windows.

    Window starts are pos - high to pos - low; ``key`` hashes the gram.  Of each periodic run (see :func:`periodic`) two
    periods of windows at either end take part: the others, which are their copies, are left out.
    """
    n, w = len(data), depth - gram + 1
    found: list[tuple[int, int, int, int]] = []
    last, spans = 0, []
    for a, z, p in runs or ():
        spans.append((last, a + 2 * p))
        last = z - depth - 2 * p
    spans.append((last, n - depth + 1))
    for begin, stop in ((b, stop) for start, stop in spans for b in range(start, stop, PIECE)):
        a, z = max(0, begin - depth), min(n, begin + PIECE + 2 * depth, stop + 2 * depth)
        roll = Rolling(data[a:z])
        starts = min(PIECE, stop - begin)
        grams = np.arange(begin - a, begin - a + starts + w - 1)
        h = roll.of(grams, grams + gram)
        least = _slide_min(h, w)
        change = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        until = np.r_[change[1:], starts]
        pos, first, last = [], [], []
        for p, q, v in zip(change.tolist(), until.tolist(), least[change], strict=True):
            while p < q:  # ties: the leftmost one at or after the window's start
                at = p + int(np.argmax(h[p : p + w] == v))
                end = min(q, at + 1)
                pos.append(at)
                first.append(p)
                last.append(end - 1)
                p = end
        own = np.array(pos) + begin
        rows = list(zip(own.tolist(), (np.array(pos) - last).tolist(), (np.array(pos) - first).tolist(), h[pos].tolist(), strict=True))
        if found and found[-1][0] == rows[0][0]:  # a minimizer whose windows lie in both pieces
            tail = found.pop()
            rows[0] = (tail[0], rows[0][1], tail[2], *rows[0][3:])
        found += rows
    return tuple(np.array(c, t) for c, t in zip(zip(*found, strict=True), (np.int32, np.int32, np.int32, np.uint64), strict=True)) if found else ()


def digest(data: bytes | memoryview, left: int = 0) -> bytes:
    """A digit: bytes that stand for ``data`` (and how many of them lie before its minimizer)."""
    return hashlib.blake2b(data, digest_size=16, salt=left.to_bytes(8, "little")).digest()


def _anchors(docs: DataFrame, depth: int, gram: int) -> DataFrame:
    """Minimizers, with a digest of their surroundings; and periodic runs, from ``pos`` to ``high``, with no ``low``."""
    names = ["doc", "uid", "pos", "low", "high", "key", "around"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts: list[list[np.ndarray]] = [[] for _ in range(6)]
            around: list[bytes] = []
            inside: list[tuple[int, int, int, int]] = []
            for doc, uid, text in zip(*b.columns, strict=True):
                data = text.as_buffer() or b""
                if len(data) >= depth:
                    bytes_, view = np.frombuffer(data, np.uint8), memoryview(data)
                    runs = periodic(bytes_, depth)
                    own = minimizers(bytes_, depth, gram, runs)
                    for a, z, _ in runs:
                        inside.append((doc.as_py(), uid.as_py(), a, z))
                    around += [digest(view[max(0, p - depth) : p + depth], min(p, depth)) for p in own[0].tolist()]
                    for k, x in enumerate((np.full(len(own[0]), doc.as_py()), np.full(len(own[0]), uid.as_py()), *own)):
                        parts[k].append(x)
            if parts[0]:
                c = [np.concatenate(x) for x in parts]
                yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in c), pa.array(around, pa.binary())], names=names)
            if inside:
                doc, uid, start, end = (list(c) for c in zip(*inside, strict=True))
                none = pa.nulls(len(inside))
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(uid, pa.int64()), pa.array(start, pa.int32()), none.cast(pa.int32()), pa.array(end, pa.int32()), none.cast(pa.int64()), none.cast(pa.binary())], names=names)

    return docs.select("doc", "uid", "text").mapInArrow(run, "doc long, uid long, pos int, low int, high int, key long, around binary")


def _surroundings(reps: DataFrame, docs: DataFrame, depth: int) -> DataFrame:
    """The bytes around each representative minimizer: id, doc, uid, pos, low, high, done, left, right."""
    lists = reps.groupBy("doc", "uid").agg(F.collect_list(F.struct("pos", "low", "high", "done")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, uid, text, at in zip(*(b.column(k) for k in range(4)), strict=True):
                data = text.as_buffer().to_pybytes()
                for x in at.as_py():
                    p = x["pos"]
                    rows.append((doc.as_py(), uid.as_py(), p, x["low"], x["high"], x["done"], data[max(0, p - depth) : p], data[p : p + depth]))
            if rows:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["doc", "uid", "pos", "low", "high", "done", "left", "right"])

    joined = docs.join(lists, ["doc", "uid"]).select("doc", "uid", "text", "at")
    return joined.mapInArrow(run, "doc long, uid long, pos int, low int, high int, done boolean, left binary, right binary")


def _digits(rows: DataFrame, width: int, depth: int) -> DataFrame:
    """Digits of offset blocks: doc, uid, pos, s, inner (bytes common to the block's windows), outer (all their bytes).

    Blocks are those that meet [low, high], or the starts in ``only`` cut to single offsets.
    """
    refine = width == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(4)]
            inner: list[bytes] = []
            outer: list[bytes | None] = []
            for doc, uid, pos, low, high, done, left, right, *only in zip(*b.columns, strict=True):
                a, c = left.as_buffer().to_pybytes(), right.as_buffer().to_pybytes()
                n_left, n = len(a), len(a) + len(c)
                low, high = low.as_py(), high.as_py()
                if refine:
                    s = (np.array(only[0].as_py())[:, None] + np.arange(BLOCK)).ravel()
                    s = s[(s >= low) & (s <= high)]
                else:
                    s = np.arange(low // width * width, high + 1, width)
                view = memoryview(a + c)
                for p in (n_left - s).tolist():  # the latest window start of the block's
                    q = p - width + 1
                    inner.append(digest(view[p : q + depth]))
                    if not refine:
                        outer.append(digest(view[q : p + depth]) if q >= 0 and p + depth <= n else None)
                k = len(s)
                for i, x in enumerate((np.full(k, doc.as_py()), np.full(k, uid.as_py()), np.full(k, pos.as_py(), np.int32), s.astype(np.int32))):
                    out[i].append(x)
            if out[0]:
                arrays = [*(pa.array(np.concatenate(x)) for x in out), pa.array(inner, pa.binary()), pa.array(outer or [None] * len(inner), pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc", "uid", "pos", "s", "inner", "outer"])

    return rows.mapInArrow(run, "doc long, uid long, pos int, s int, inner binary, outer binary")


def _again(rows: DataFrame, column: str) -> DataFrame:
    """Digits that occur more than once at an offset, written."""
    n = rows.where(F.col(column).isNotNull()).groupBy("s", column).agg(F.count(F.lit(1)).alias("n"))
    return materialize(n.where("n > 1").select("s", column), "digits")


def repeated_spans(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """(doc, uid, start, end): byte ranges, overlapping ones included, that repeated windows cover."""
    ship(docs.sparkSession)
    found = materialize(_anchors(docs, depth, gram), "minimizers")
    at = found.where("low is not null")
    rep = F.struct(F.min(F.struct("doc", "uid", "pos")).alias("at"), F.min("low").alias("low"), F.max("high").alias("high"))
    groups = materialize(at.groupBy("key", "around").agg(F.count(F.lit(1)).alias("n"), rep.alias("rep")), "surroundings")
    # First digit done: all windows of minimizers with repeated surroundings are repeated.
    same = materialize(groups.where("n > 1").select("key", "around"), "same")
    size = F.lit(depth)
    sure = at.join(same, ["key", "around"], "left_semi").select("doc", "uid", (F.col("pos") - size).alias("start"), (F.col("pos") + size).alias("end"))
    inside = found.where("low is null").select("doc", "uid", F.col("pos").alias("start"), F.col("high").alias("end"))
    sure = materialize(sure.union(inside), "sure")
    remove(found)
    remove(same)
    shared = materialize(groups.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key"), "shared")
    reps = groups.join(shared, "key").select("rep.at.*", "rep.low", "rep.high", (F.col("n") > 1).alias("done"))
    around = materialize(_surroundings(reps, docs, depth), "bytes")
    remove(groups)
    remove(shared)
    # Second digit: blocks of offsets.
    blocks = materialize(_digits(around, BLOCK, depth), "blocks")
    inner, outer = _again(blocks, "inner"), _again(blocks, "outer")
    seen = outer.select("s", "outer", F.lit(True).alias("all"))
    left = blocks.join(inner, ["s", "inner"]).join(seen, ["s", "outer"], "left").select("doc", "uid", "pos", "s", "inner", "outer", F.coalesce("all", F.lit(False)).alias("all"))
    left = materialize(left, "left")
    whole = left.where("all").select("doc", "uid", "pos", "s", (F.col("s") + BLOCK - 1).alias("t"))
    # Third digit: single offsets of undecided blocks.  Their windows may also occur in decided blocks with
    # the same inner bytes, of which one per distinct outer bytes takes part.
    undecided = left.where("not all")
    decided = left.where("all").groupBy("s", "inner", "outer").agg(F.min(F.struct("doc", "uid", "pos")).alias("one"))
    decided = decided.join(undecided.select("s", "inner").distinct(), ["s", "inner"], "left_semi").select("one.*", "s")
    open_ = undecided.select("doc", "uid", "pos", "s").union(decided).groupBy("doc", "uid", "pos").agg(F.sort_array(F.collect_list("s")).alias("only"))
    windows = materialize(_digits(around.join(open_, ["doc", "uid", "pos"]).select(*around.columns, "only"), 1, depth), "windows")
    twice = _again(windows, "inner")
    single = windows.join(twice, ["s", "inner"]).select("doc", "uid", "pos", "s", F.col("s").alias("t"))
    # All windows of a minimizer contain it, so their union is one range.
    edges = whole.union(single).groupBy("doc", "uid", "pos").agg(F.min("s").alias("s"), F.max("t").alias("t"))
    edges = edges.select("doc", "uid", (F.col("pos") - F.col("t")).alias("start"), (F.col("pos") - F.col("s") + size).alias("end"))
    edges = materialize(edges, "edges")
    for done in (around, blocks, inner, outer, left, windows, twice):
        remove(done)
    return sure.union(edges)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, its non-null form, an id of (id, text), and the text; null texts are empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64("doc_id", text).alias("uid"), text.alias("text"))


def union_of(spans: list[dict], n: int) -> list[tuple[int, int]]:
    """Maximal runs covered by spans, cut to [0, n)."""
    out: list[tuple[int, int]] = []
    for a, z in sorted((max(0, s["start"]), min(n, s["end"])) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def with_runs(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, text and ``runs``, the removed byte ranges (array of start, end structs; null for none), per row.

    Null texts count as empty.  Rows that repeat an id are told apart by their texts; rows that repeat both
    are texts like any other, so each repeats the other.  Texts under ``depth`` bytes keep everything; an
    empty table gives an empty one; other columns are not read.
    """
    keyed = _keyed(docs)
    spans = repeated_spans(keyed, depth).distinct().groupBy("doc", "uid").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    return keyed.join(spans, ["doc", "uid"], "left").select("doc_id", "text", "runs")


def remove_repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes, n_removed and n_spans per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_cut(t.as_buffer().to_pybytes(), r.as_py()) for t, r in zip(b.column(1), b.column(2), strict=True)]
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, types, strict=True))], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return with_runs(docs, depth).mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def _cut(data: bytes, runs: list[dict]) -> tuple[bytes, int, int, int]:
    gone = union_of(runs, len(data))
    kept, at = [], 0
    for a, z in gone:
        kept.append(data[at:a])
        at = z
    kept.append(data[at:])
    return b"".join(kept), len(data), sum(z - a for a, z in gone), len(gone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: all documents without their 400-byte repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_cut(t.as_buffer().to_pybytes(), r.as_py()) for t, r in zip(b.column(1), b.column(2), strict=True)]
            counts = [pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_runs(table(spark, sf_dir, "documents")).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
