"""N-gram language model with Katz backoff, trained on one fold of a corpus and scored on all of it.

Probabilities.  P1 is the add-one unigram distribution with one unknown word.  From there up, by recursion, a seen
n-gram has d(r) * r / T(context), with Good-Turing discounts d for counts up to ``K`` and 1 above.  An unseen one has
a(context) * P(w | shorter context), and the backoff weight a = (1 - seen mass of the context) / (1 - P of the words
seen after it under the shorter context), so that each context's distribution sums to one exactly.  A context without
discounted mass counts one more in T, which frees mass for the unseen.

Distribution.  One pass over the texts packs documents into *buckets* (token ids against the bucket's own
vocabulary), written to the shared folder.  Counting is an exchange per level: a bucket sends each of its distinct
n-grams once to the part that owns it; the part adds up and answers in the same order.  So an n-gram costs one entry
per bucket at most, however frequent, and nothing but a few totals reaches the driver.  Entries for one part travel
packed in a blob; the number of parts grows with the corpus, so a part's memory does not, and blobs, of which there
are never more than entries, shrink towards single entries.  N-grams belong to the part of their context; those of
contexts that occur over ``HOT_TOKENS`` times are dealt one by one instead, and their contexts' sums meet in a last
small exchange, which also answers backoff weights.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.session import materialize, remove, scratch, ship, table

from .warc import Store

K = 5
#: Longest n-gram.
ORDER = 2
#: Bytes of text in a bucket; bounds a task's memory.
BUCKET_BYTES = 18 << 20
#: Bytes of text for each part of an exchange.
PART_BYTES = 14 << 20
#: A context that occurs more often has its n-grams dealt one by one.
HOT_TOKENS = 500_000
END, BEGIN = np.uint64(1), np.uint64(0)
_ROWS = "kind string, part int, bucket string, blob binary, totals array<long>"
_KINDS = {"u8": np.uint64, "i8": np.int64, "f8": np.float64, "u4": np.uint32, "u1": np.uint8}


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as lengths and bytes, compressed; a blob of a single entry costs some tens of bytes."""
    data = struct.pack(f"<{len(arrays)}I", *map(len, arrays)) + b"".join(a.tobytes() for a in arrays)
    return b"\1" + zstandard.ZstdCompressor(level=3).compress(data) if len(data) > 512 else b"\0" + data


def unpack(blob: bytes, kinds: str) -> list[np.ndarray]:
    """The arrays of :func:`pack`; ``kinds`` names their types."""
    data = blob[1:] if not blob[0] else zstandard.ZstdDecompressor().decompress(blob[1:])
    types = [np.dtype(_KINDS[k]) for k in kinds.split()]
    at, out = 4 * len(types), []
    for t, n in zip(types, struct.unpack_from(f"<{len(types)}I", data), strict=True):
        out.append(np.frombuffer(data, t, n, at))
        at += n * t.itemsize
    return out


def store(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.ZstdCompressor(level=3).compress(out.getvalue())


def stored(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(data))) as z:
        return {k: z[k] for k in z.files}


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers, for dealing to parts."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def held_out(doc_id: int | None) -> bool:
    """Whether a document is not trained on: crc32 of its id as text, modulo 7, is 2; a null id's text is empty."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


class _Numbers(dict):
    """Word -> its number in the bucket, in order of first sight; number 0 is the end."""

    def __missing__(self, word: bytes) -> int:
        got = self[word] = len(self) + 1
        return got


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds, parts, buckets, blobs, totals = zip(*rows, strict=True)
    types = (pa.string(), pa.int32(), pa.string(), pa.binary(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((kinds, parts, buckets, blobs, totals), types, strict=True)], names=["kind", "part", "bucket", "blob", "totals"])


def _dealt(part: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[int, slice]]]:
    """A stable order by part, and each part's slice in it; the same for request and answer."""
    order = np.argsort(part, kind="stable")
    own = part[order]
    cuts = [*np.flatnonzero(np.r_[True, own[1:] != own[:-1]]).tolist(), len(own)] if len(own) else [0]
    return order, ((int(own[a]), slice(a, z)) for a, z in zip(cuts[:-1], cuts[1:], strict=True))


def buckets(docs: DataFrame, folder: str, parts: int) -> DataFrame:
    """Write the buckets; their word requests, one row per bucket and part."""

    def flush(files: Store, words: _Numbers, ids: list, held: list[bool], tokens: list[np.ndarray]) -> list[tuple]:
        import xxhash

        name = uuid.uuid4().hex
        vocab = np.r_[END, np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in words), np.uint64, len(words))]
        words.clear()
        sizes_, held_ = np.array([len(t) for t in tokens], np.int64), np.array(held)
        index = np.concatenate(tokens)
        tokens.clear()
        counts = np.bincount(index[~np.repeat(held_, sizes_)], minlength=len(vocab)).astype(np.uint32)
        known = np.array([x is not None for x in ids])
        with files.create(name) as f:
            f.write(store(ids=np.array([x or 0 for x in ids], np.int64), known=known, sizes=sizes_, held=held_, vocab=vocab, index=index))
        order, slices = _dealt((mixed(vocab) % np.uint64(parts)).astype(np.int32))
        return [("word", p, name, pack(vocab[order[s]], counts[order[s]]), None) for p, s in slices]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, words = Store(folder), _Numbers()
        ids, held, tokens, size = [], [], [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = (text.as_buffer() or b"") if text.is_valid else b""
                own = bytes(data).lower().split()  # bytes: ASCII case and white space only
                numbers = np.zeros(len(own) + 1, np.int32)
                numbers[:-1] = np.fromiter(map(words.__getitem__, own), np.int32, len(own))
                ids.append(doc_id)
                held.append(held_out(doc_id))
                tokens.append(numbers)
                size += len(data) + 100
                if size >= BUCKET_BYTES:
                    yield _rows(flush(files, words, ids, held, tokens))
                    ids, held, size = [], [], 0
        if ids:
            yield _rows(flush(files, words, ids, held, tokens))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ROWS)


def _part(batches: Iterator[pa.RecordBatch]) -> list[dict]:
    """All rows sent to one part; parts are many enough that they are few (see ``PART_BYTES``)."""
    return [r for b in batches for r in b.to_pylist()]


def count_words(requests: DataFrame, parts: int) -> DataFrame:
    """Answers to word requests: counts over all buckets; totals: tokens and distinct words of the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _part(batches)
        if not rows:
            return
        blobs = [unpack(r["blob"], "u8 u4") for r in rows]
        _, at = np.unique(np.concatenate([w for w, _ in blobs]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([n for _, n in blobs])).astype(np.int64)
        answer, k = counts[at], 0
        out = []
        for i, (r, (w, _)) in enumerate(zip(rows, blobs, strict=True)):
            out.append(("word", r["part"], r["bucket"], pack(answer[k : k + len(w)]), [int(counts.sum()), int((counts > 0).sum())] if not i else None))
            k += len(w)
        yield _rows(out)

    return requests.repartitionById(parts, "part").mapInArrow(run, _ROWS)


class Bucket:
    """A bucket's n-grams, level by level, in the order that requests and answers share.

    By distinct n-gram of the level: ``count`` over the training fold and ``p``, its probability; by token: ``at``,
    the n-gram that ends there.
    """

    def __init__(self, data: dict[str, np.ndarray], counts: np.ndarray, facts: tuple[int, int, int], parts: int):
        n, v, self.n_docs = facts
        self.data, self.parts = data, parts
        self.vocab, self.at, sizes = data["vocab"], data["index"], data["sizes"]
        self.words, self.word_counts = self.at, counts
        self.c = self.w = None
        self.count = counts.astype(np.int64)
        self.p = (counts + 1) / (n + v + 1)
        self.base = np.log10(self.p)
        self.starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
        self.train = ~np.repeat(data["held"], sizes)

    def deepen(self) -> None:
        """On to n-grams one word longer: contexts are the present ones, and one for the start of a document."""
        name = self.vocab if self.c is None else self._names(slice(None))
        begin, width = len(name), len(self.vocab)
        self.context_name, self.context_count = np.r_[name, BEGIN], np.r_[self.count, self.n_docs]
        del name
        keys = np.empty(len(self.at), np.int64)
        keys[1:] = self.at[:-1]
        keys[self.starts] = begin
        keys *= width
        keys += self.words
        keys, first, at = np.unique(keys, return_index=True, return_inverse=True)
        self.c, self.w = (keys // width).astype(np.int32), (keys % width).astype(np.int32)
        del keys
        self.lower = self.at[first]  # the n-gram without its first word
        self.at = at.astype(np.int32)
        del first, at
        self.local = np.bincount(self.at[self.train], minlength=len(self.c)).astype(np.uint32)
        owner = mixed(self.context_name[self.c])
        hot = np.flatnonzero((self.context_count > HOT_TOKENS)[self.c])
        owner[hot] = mixed(self._names(hot))
        owner %= np.uint64(self.parts)
        self.order, slices = _dealt(owner.astype(np.int32))
        del owner
        self.slices = list(slices)
        # Contexts whose backoff weight may be asked for: those of held-out tokens, and those that may have no mass.
        asked = self.context_count > K
        asked[self.c[self.at[~self.train]]] = True
        self.asked = np.flatnonzero(asked)
        self.asked_order, slices = _dealt((mixed(self.context_name[self.asked]) % np.uint64(self.parts)).astype(np.int32))
        self.asked_slices = list(slices)

    def _names(self, which) -> np.ndarray:
        """Names of the level's n-grams: hashes of their context's name and their last word's."""
        return mixed(mixed(self.context_name[self.c[which]]) + self.vocab[self.w[which]])

    def requests(self, name: str, level: int) -> Iterator[tuple]:
        for p, s in self.slices:
            own = self.order[s]
            c = self.c[own]
            start = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            blob = pack(self.context_name[c[start]], np.diff(np.r_[start, len(c)]).astype(np.uint32), self.vocab[self.w[own]], self.p[self.lower[own]], self.local[own])
            yield f"pair{level}", p, name, blob, None
        for p, s in self.asked_slices:
            yield f"context{level}", p, name, pack(self.context_name[self.asked[self.asked_order[s]]]), None

    def answered(self, blobs: dict[tuple[str, int], bytes], level: int, d: list[float]) -> None:
        """Counts and probabilities of the level from its answers."""
        r = np.zeros(len(self.c), np.int64)
        for p, s in self.slices:
            r[self.order[s]] = unpack(blobs[f"pair{level}", p], "u4")[0]
        weight, bump = np.ones(len(self.context_name)), np.zeros(len(self.context_name))
        for p, s in self.asked_slices:
            at = self.asked[self.asked_order[s]]
            weight[at], bump[at] = unpack(blobs[f"weight{level}", p], "f8 u1")
        off = np.r_[1.0, d]
        seen = np.where(r <= K, off[np.minimum(r, K)], 1.0) * r / np.maximum(self.context_count + bump, 1)[self.c]
        self.p = np.where(r > 0, seen, weight[self.c] * self.p[self.lower])
        self.count = r


def _loaded(folder: str, rows: list[dict], facts: tuple[int, int, int], parts: int, known: list[list[float]]) -> Bucket:
    """A bucket after the levels whose discounts are ``known``, from its file and the answers to it."""
    data = stored(Store(folder).whole(rows[0]["bucket"]))
    order, slices = _dealt((mixed(data["vocab"]) % np.uint64(parts)).astype(np.int32))
    blobs = {(r["kind"], r["part"]): r["blob"] for r in rows}
    counts = np.zeros(len(order), np.int64)
    for p, s in slices:
        counts[order[s]] = unpack(blobs["word", p], "i8")[0]
    bucket = Bucket(data, counts, facts, parts)
    for level, d in enumerate(known, 2):
        bucket.deepen()
        bucket.answered(blobs, level, d)
    return bucket


def ask(answers: DataFrame, lanes: int, folder: str, facts: tuple[int, int, int], parts: int, known: list[list[float]]) -> DataFrame:
    """Requests for the next level's counts and backoff weights, of every bucket."""

    def run(rows: pa.Table) -> pa.Table:
        own = rows.to_pylist()
        bucket = _loaded(folder, own, facts, parts, known)
        bucket.deepen()
        return pa.Table.from_batches([_rows(list(bucket.requests(own[0]["bucket"], len(known) + 2)))])

    return answers.repartition(lanes, "bucket").groupBy("bucket").applyInArrow(run, _ROWS)


def count_ngrams(requests: DataFrame, parts: int, level: int) -> DataFrame:
    """Answers to n-gram requests, each context's sums, and the context requests passed on.

    Sums of a context: n-grams seen 1 to K times, occurrences of those seen more often, and the lower-order P of all
    seen followers.  totals: how many n-grams occur 1, 2, ... K + 1 times in the part.
    """
    pair, context = f"pair{level}", f"context{level}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for r in _part(batches):
            if r["kind"] == pair:
                rows.append(r)
            else:
                yield _rows([(context, r["part"], r["bucket"], r["blob"], None)])
        if not rows:
            return
        blobs = [unpack(r["blob"], "u8 u4 u8 f8 u4") for r in rows]
        c = np.concatenate([np.repeat(x[0], x[1]) for x in blobs])
        w, p, n = (np.concatenate([x[k] for x in blobs]) for k in (2, 3, 4))
        order = np.lexsort((w, c))
        cs, ws = c[order], w[order]
        first = np.r_[True, (cs[1:] != cs[:-1]) | (ws[1:] != ws[:-1])]
        group = np.cumsum(first) - 1
        total = np.bincount(group, n[order]).astype(np.int64)
        answer = np.empty(len(c), np.uint32)
        answer[order] = total[group]
        k = 0
        for r, x in zip(rows, blobs, strict=True):
            yield _rows([(pair, r["part"], r["bucket"], pack(answer[k : k + len(x[2])]), None)])
            k += len(x[2])
        seen = total > 0
        own, r_, p_ = cs[first][seen], total[seen], p[order][first][seen]
        names, at = np.unique(own, return_inverse=True)
        few = [np.bincount(at[r_ == r], minlength=len(names)).astype(np.uint32) for r in range(1, K + 1)]
        many = np.bincount(at, np.where(r_ > K, r_, 0), len(names)).astype(np.int64)
        mass = np.bincount(at, p_, len(names))
        counts = [int((r_ == r).sum()) for r in range(1, K + 2)]
        order, slices = _dealt((mixed(names) % np.uint64(parts)).astype(np.int32))
        for i, (q, s) in enumerate(slices):
            o = order[s]
            yield _rows([("sums", q, None, pack(names[o], many[o], mass[o], *(f[o] for f in few)), counts if not i else None)])

    return requests.repartitionById(parts, "part").mapInArrow(run, _ROWS)


def discounts(n: list[int]) -> list[float]:
    """Katz's discounts for counts 1..K from the numbers of n-grams seen 1..K+1 times.

    Where the counts of counts give none between 0 and 1 (tiny corpora), half a count is taken off instead.
    """
    cut = (K + 1) * n[K] / n[0] if n[0] else 1.0
    out = []
    for r in range(1, K + 1):
        d = ((r + 1) * n[r] / n[r - 1] / r - cut) / (1 - cut) if n[r - 1] and cut < 1 else 0.0
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


def weigh(rows: DataFrame, d: list[float], parts: int, level: int) -> DataFrame:
    """Answers to context requests: the backoff weight, and whether T counts one more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, sums = [], []
        for r in _part(batches):
            (sums if r["kind"] == "sums" else asked).append(r)
        blobs = [unpack(r["blob"], "u8 i8 f8" + " u4" * K) for r in sums]
        joined = lambda k: np.concatenate([x[k] for x in blobs]) if blobs else np.array([], np.uint64)
        names, at = np.unique(joined(0), return_inverse=True)
        add = lambda k: np.bincount(at, joined(k), len(names))
        few = np.array([add(2 + r) for r in range(1, K + 1)]).reshape(K, len(names))
        steps = np.arange(1, K + 1)[:, None]
        total = (few * steps).sum(0) + add(1)
        mass = (few * steps * np.array(d)[:, None]).sum(0) + add(1)
        bump = total - mass < 1e-9
        left = (total + bump - mass) / np.maximum(total + bump, 1)
        weight = left / (1 - add(2)) if len(names) else left
        for r in asked:
            c = unpack(r["blob"], "u8")[0]
            k = np.minimum(np.searchsorted(names, c), max(len(names) - 1, 0))
            hit = names[k] == c if len(names) else np.zeros(len(c), bool)
            blob = pack(np.where(hit, weight[k], 1.0) if len(names) else np.ones(len(c)), (hit & bump[k] if len(names) else hit).astype(np.uint8))
            yield _rows([(f"weight{level}", r["part"], r["bucket"], blob, None)])

    return rows.repartitionById(parts, "part").mapInArrow(run, _ROWS)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def evaluate(answers: DataFrame, lanes: int, folder: str, facts: tuple[int, int, int], parts: int, known: list[list[float]]) -> DataFrame:
    """Scores of every document from its bucket and all answers to it."""

    def run(table_: pa.Table) -> pa.Table:
        b = _loaded(folder, table_.to_pylist(), facts, parts, known)
        summed = lambda x: np.add.reduceat(x, b.starts)
        columns = [
            pa.array(b.data["ids"], mask=~b.data["known"]), pa.array(b.data["held"]), pa.array(b.data["sizes"]), pa.array(summed((b.word_counts > 0)[b.words].astype(np.int64))),
            pa.array(np.full(len(b.starts), facts[0])), pa.array(summed(b.base[b.words])), pa.array(summed(np.log10(b.p)[b.at])),
        ]
        return pa.Table.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return answers.repartition(lanes, "bucket").groupBy("bucket").applyInArrow(run, SCORES)


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Train on the documents that :func:`held_out` leaves and score all of them, with n-grams up to ``order``.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.  A text's tokens are its words,
    ASCII lower case, and one end; null texts count as empty and have the end alone.  Texts are read whole: one
    longer than a bucket is a bucket of its own.  Repeated rows count and are scored each for itself.  Without a
    training document every word is unknown.  An empty table gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    trained = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7)) != 2
    size, n_docs = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 100), F.count_if(trained)).head()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // PART_BYTES))
    folder = scratch(spark, "katz")
    asked = materialize(buckets(docs, folder, parts), "katz-words")
    lanes = max(int(spark.conf.get("spark.sql.shuffle.partitions")), asked.select("bucket").distinct().count())
    answers = materialize(count_words(asked, parts), "katz-counts")
    remove(asked)
    n, v = answers.where("totals is not null").agg(F.sum(F.col("totals")[0]), F.sum(F.col("totals")[1])).head()
    facts = (n or 0, v or 0, n_docs)
    known: list[list[float]] = []
    for level in range(2, order + 1):
        counted = materialize(count_ngrams(ask(answers, lanes, folder, facts, parts, known), parts, level), "katz-ngrams")
        row = counted.where("totals is not null").agg(*(F.sum(F.col("totals")[r]) for r in range(K + 1))).head()
        known.append(discounts([x or 0 for x in row]))
        weights = weigh(counted.where(F.col("kind").isin("sums", f"context{level}")), known[-1], parts, level)
        weights = weights if level == order else materialize(weights, "katz-weights")  # lower levels' are read again
        answers = answers.union(counted.where(F.col("kind") == f"pair{level}")).union(weights)
    return evaluate(answers, lanes, folder, facts, parts, known)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: Katz scores of all documents."""
    return score(table(spark, sf_dir, "documents"))
