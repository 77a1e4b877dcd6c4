"""Alignment of two tokenizers' tokens over the same bytes, by a dangling-suffix transducer.

The transducer reads both token sequences at once.  Its state is which side leads and the leader's bytes that the other
side has not matched yet; the side behind is read next.  A token that is shorter than the residual leaves a shorter
one, an equal one empties it, a longer one takes the lead.  An empty residual closes a group: the shortest stretch that
both sides tokenize apart from the rest.  Transitions depend on the residual and the token alone and are kept.  The leader's
residual always belongs to its last token, so every token read against a residual is one *link*: two tokens that
overlap.

Where no space precedes white space, neither tokenizer joins what a space divides, so both sides end before each space
and a group never spans one; a block's distinct chunks are aligned once, many in step: each step looks up the transitions
of all of them in one sorted table.  Other texts are aligned whole.  Tokens come from the tokenizers' own libraries.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamellar.session import fresh, materialize, ship, spread, table

from .bpe import SPLIT, byte_alphabet, default_path, read_vocabulary

#: Kept transitions of a process; stretches of text up to so many characters are aligned in step, so many at once.
TRANSITIONS, CHUNK_CHARS, ENCODED = 400_000, 64, 20_000
#: Stretches that are encoded as one text.
JOINED = 200
#: Characters of text whose distinct stretches a task aligns together.
BLOCK_CHARS = 2 << 20
#: Id pairs (17 bytes each) up to which their counts are broadcast; more are joined.
BROADCAST_PAIRS = 4_000_000
#: The piece format's visible space (fixed by the format).
SPACE = "▁"


class Transducer:
    """Groups and links of token sequences of two vocabularies, given as the bytes of every id.

    States are numbered: 0 is the empty residual, in which the first side is read; 1 is that of differing bytes.
    """

    def __init__(self, first: list[bytes], second: list[bytes]):
        self.labels, self.width = (first, second), max(len(first), len(second))
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[tuple[bool, bytes], int] = {(True, b""): 0}
        self.open: list[tuple[bool, bytes]] = [(True, b""), (True, b"")]  # by state: is the first side read, the leader's rest
        self.table: dict[int, int] = {}  # by state * width + token
        self._sorted()

    def _sorted(self) -> None:
        """The table as arrays, for lookups of many at once."""
        self.keys = np.fromiter(self.table, np.int64, len(self.table))
        order = np.argsort(self.keys)
        self.keys, self.next = self.keys[order], np.fromiter(self.table.values(), np.int64, len(self.table))[order]
        self.reads_first = np.array([first for first, _ in self.open])

    def _step(self, key: int) -> int:
        """A transition met for the first time."""
        state, token = divmod(key, self.width)
        first, have = self.open[state]
        read = self.labels[not first][token]
        if have.startswith(read):
            to = (first, have[len(read) :])
        elif read.startswith(have):
            to = (not first, read[len(have) :])
        else:
            self.table[key] = 1
            return 1
        if not to[1]:
            to = (True, b"")
        found = self.ids.get(to)
        if found is None:
            found = self.ids[to] = len(self.open)
            self.open.append(to)
        self.table[key] = found
        return found

    def align(self, a: list[int], b: list[int]) -> tuple[list[tuple[list[int], list[int]]], list[tuple[int, int]]] | None:
        """(groups, links) of two token sequences, or None where their bytes differ."""
        if len(self.table) > TRANSITIONS:
            self._forget()
        groups, links = [], []
        i = j = i0 = j0 = state = 0
        table, width, states = self.table, self.width, self.open
        while True:
            if states[state][0]:  # the second side leads, or none does
                if i == len(a):
                    break
                token = a[i]
                i += 1
                if state:
                    links.append((token, b[j - 1]))
            else:
                if j == len(b):
                    return None
                token = b[j]
                j += 1
                links.append((a[i - 1], token))
            key = state * width + token
            state = table.get(key)
            if state is None:
                state = self._step(key)
            if state == 0:
                groups.append((a[i0:i], b[j0:j]))
                i0, j0 = i, j
            elif state == 1:
                return None
        return (groups, links) if state == 0 and j == len(b) else None

    def align_many(self, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Many short sequences in step: (failed by item, links as item, first id, second id; groups as item, end in a, end in b).

        ``a`` and ``b`` hold all items' tokens, and the ends say where each item's stop.  Links are in no order, groups of an item
        in theirs.
        """
        if len(self.table) > TRANSITIONS:
            self._forget()
        i, j = np.r_[0, a_ends[:-1]], np.r_[0, b_ends[:-1]]
        a, b = np.r_[a, 0], np.r_[b, 0]  # the side that is not read may be at its end
        state, failed, live = np.zeros(len(a_ends), np.int64), np.zeros(len(a_ends), bool), np.arange(len(a_ends))
        links, closed = [np.zeros((3, 0), np.int64)], [np.zeros((3, 0), np.int64)]
        self._sorted()
        while len(live):
            s = state[live]
            first, ii, jj = self.reads_first[s], i[live], j[live]
            over = np.where(first, ii >= a_ends[live], jj >= b_ends[live])
            if over.any():
                failed[live[over]] = ~(first & (s == 0) & (jj == b_ends[live]))[over]
                live = live[~over]
                continue
            token = np.where(first, a[ii], b[jj])
            key = s * self.width + token
            at = np.searchsorted(self.keys, key)
            known = np.r_[self.keys, -1][at] == key
            if not known.all():
                for k in np.unique(key[~known]).tolist():
                    self._step(k)
                self._sorted()
                at = np.searchsorted(self.keys, key)
            then = self.next[at]
            linked = ~first | (s != 0)
            links.append(np.stack([live, np.where(first, token, a[ii - 1]), np.where(first, b[jj - 1], token)])[:, linked])
            i[live] += first
            j[live] += ~first
            state[live] = then
            shut = live[then == 0]
            closed.append(np.stack([shut, i[shut], j[shut]]))
            failed[live[then == 1]] = True
            live = live[then != 1]
        links, closed = np.concatenate(links, 1), np.concatenate(closed, 1)
        links, closed = links[:, ~failed[links[0]]], closed[:, ~failed[closed[0]]]
        return failed, links, closed[:, np.argsort(closed[0], kind="stable")]


def shown(groups: list[tuple[list[int], list[int]]]) -> str:
    """Groups as text: ids joined by commas, sides by a bar, groups by semicolons."""
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def _ranked(content: bytes):
    """A quicker encoder for a file whose merges make ids in the order of their ranks (else None): the same tokens.

    When a pair's joint token is the lowest rank left, the bytes between its ends were merged as that token alone is, so
    the pair is the one that its merge names.
    """
    import tiktoken

    spec = json.loads(content)
    vocab, alphabet, special = spec["model"]["vocab"], byte_alphabet(), {a["content"] for a in spec.get("added_tokens", [])}
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if made != sorted(made) or spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
        return None
    ranks = {bytes(alphabet[c] for c in s): i for s, i in vocab.items() if s not in special}
    if len(ranks) != len(made) + 256 or any(len(s) > 1 and i < made[0] for s, i in ranks.items()):
        return None
    return tiktoken.Encoding("ranked", pat_str=SPLIT.replace(r"\S", r"\P{White_Space}").replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}"), mergeable_ranks=ranks, special_tokens={})


class Aligned(NamedTuple):
    """Results of stretches of text: numbers, groups as text (each followed by a semicolon), and coded links."""

    failed: np.ndarray
    numbers: np.ndarray  # tokens, tokens, groups and links of each
    shown: list[str]
    codes: pa.ListArray


class Aligner:
    """Two vocabulary files and the transducer between them."""

    def __init__(self, first: bytes, second: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        self.first = Tokenizer.from_buffer(first)
        self.first.no_truncation()
        self.first.no_padding()
        self.first.encode_special_tokens = True
        self.ranked = _ranked(first)
        self.second = m = sentencepiece.SentencePieceProcessor(model_proto=second)
        alphabet, size = byte_alphabet(), self.first.get_vocab_size()
        entries = [self.first.id_to_token(i) or "" for i in range(size)]
        labels = [bytes(alphabet[c] for c in s) if all(c in alphabet for c in s) else s.encode() for s in entries]
        pieces = [bytes([int(p[3:-1], 16)]) if m.is_byte(i) else p.replace(SPACE, " ").encode() for i in range(m.get_piece_size()) for p in [m.id_to_piece(i)]]
        self.width = len(pieces)
        self.code_type = pa.int32() if size * self.width < 1 << 31 else pa.int64()
        self.transducer = Transducer(labels, pieces)
        self.lone = m.piece_to_id(SPACE)  # what a space alone becomes
        self.apart = not any(" " in p.decode("utf-8", "replace").lstrip(" ") for p in pieces) and self.lone != m.unk_id()
        self.run = regex.compile(r" \p{White_Space}").search
        self.begins = [np.array([s.startswith(b" ") for s in side]) for side in (labels, pieces)]
        # every id as text, as it stands within its side of a group and at the end of it
        self.names = np.array([f"{k}{c}" for k in range(size) for c in ",|"] + [f"{k}{c}" for k in range(self.width) for c in ",;"], object)
        self.names_of_second = 2 * size

    def flat(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(all ids, ids of each stretch) of both sides, of short stretches without spaces, encoded many at once."""
        ids: tuple[list[int], list[int]] = ([], [])
        for at in range(0, len(parts), JOINED):
            text = " ".join(parts[at : at + JOINED])
            ids[0].extend(self.ranked.encode_ordinary(" " + text) if self.ranked else self.first.encode(" " + text, add_special_tokens=False).ids)
            ids[1].extend(self.second.encode(text, num_threads=1))
        out = []
        for side, begins in zip(ids, self.begins, strict=True):
            own = np.array(side, np.int64)
            counts = np.bincount(np.cumsum(begins[own]) - 1, minlength=len(parts))
            if len(counts) != len(parts):
                raise ValueError("a vocabulary has tokens that join what a space divides")
            out.append((own, counts))
        return out

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; of the first with a space in front, as the second adds one itself."""
        a = [e.ids for e in self.first.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        return a, [ids if t else [self.lone] for t, ids in zip(texts, self.second.encode(texts, num_threads=1), strict=True)]

    def split(self, text: str | None) -> list[str]:
        """The stretches of a text that are aligned by themselves; none for null and empty texts."""
        if not text:
            return []
        return [text] if not self.apart or self.run(" " + text) else text.split(" ")

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        """Groups of a whole text; none without tokens."""
        out: list[tuple[list[int], list[int]]] = []
        for a, b, part in zip(*self.tokens(parts := self.split(text)), parts, strict=True) if text else ():
            found = None if SPACE in part else self.transducer.align(a, b)
            if found is None:
                return []
            out += found[0]
        return out

    def aligned(self, parts: list[str]) -> Aligned:
        """All of many stretches: short ones together, long ones by themselves."""
        short = [k for k, p in enumerate(parts) if 0 < len(p) <= CHUNK_CHARS and self.apart and SPACE not in p and " " not in p]
        failed, numbers, shown_ = np.zeros(len(parts), bool), np.zeros((len(parts), 4), np.int64), [""] * len(parts)
        of, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(short), ENCODED):
            index = np.array(short[at : at + ENCODED])
            bad, links, sums, texts = self._together([parts[k] for k in index])
            failed[index], numbers[index] = bad, sums
            for k, t in zip(index.tolist(), texts, strict=True):
                shown_[k] = t
            of.append(index[links[0]])
            codes.append(links[1] * self.width + links[2])
        for k in set(range(len(parts))).difference(short):
            (a,), (b,) = self.tokens([parts[k]])
            found = None if SPACE in parts[k] else self.transducer.align(a, b)
            failed[k] = found is None
            if found:
                links = np.array(found[1], np.int64).reshape(-1, 2)
                numbers[k], shown_[k] = (len(a), len(b), len(found[0]), len(links)), shown(found[0]) + ";"
                of.append(np.full(len(links), k))
                codes.append(links[:, 0] * self.width + links[:, 1])
        of, codes = np.concatenate(of), np.concatenate(codes)
        ends = np.cumsum(np.bincount(of, minlength=len(parts)))
        return Aligned(failed, numbers, shown_, pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(codes[np.argsort(of, kind="stable")], self.code_type)))

    def _together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(failed, links as item and ids, numbers, groups as text) of short stretches."""
        (a, n_a), (b, n_b) = self.flat(parts)
        flat, n = (a, b), (n_a, n_b)
        failed, links, closed = self.transducer.align_many(a, np.cumsum(n_a), b, np.cumsum(n_b))
        ok = ~failed
        sums = np.stack([n[0] * ok, n[1] * ok, np.bincount(closed[0], minlength=len(parts)), np.bincount(links[0], minlength=len(parts))], 1)
        # tokens in the order of the text of groups: those of each group's first side, then of its second
        item, sizes, ids = closed[0], [], []
        new = np.r_[True, item[1:] != item[:-1]] if len(item) else np.zeros(0, bool)
        for side in range(2):
            ends, starts = closed[1 + side], np.cumsum(n[side]) - n[side]
            sizes.append(ends - np.where(new, starts[item], np.r_[0, ends[:-1]] if len(ends) else ends))
            ids.append(flat[side][np.repeat(ok, n[side])])
        begins = np.cumsum(sizes[0] + sizes[1]) - sizes[0] - sizes[1]
        order = np.zeros(len(ids[0]) + len(ids[1]), np.int64)
        for side in range(2):
            group = np.repeat(np.arange(len(item)), sizes[side])
            place = np.arange(len(group)) - np.repeat(np.cumsum(sizes[side]) - sizes[side], sizes[side])
            last = place == sizes[side][group] - 1
            order[begins[group] + side * sizes[0][group] + place] = side * self.names_of_second + 2 * ids[side] + last
        tokens, ends = self.names[order].tolist(), np.cumsum(sums[:, 0] + sums[:, 1]).tolist()
        return failed, links, sums, ["".join(tokens[x:y]) for x, y in zip([0, *ends], ends, strict=False)]


_LOADED: dict[bytes, Aligner] = {}


def _loaded(first: bytes, second: bytes) -> Aligner:
    key = hashlib.sha256(first + second).digest()
    if key not in _LOADED:
        _LOADED[key] = Aligner(first, second)
    return _LOADED[key]


def _shared(spark: SparkSession, first: str, second: str):
    ship(spark)
    return spark.sparkContext.broadcast((read_vocabulary(first), read_vocabulary(second)))


def groups(docs: DataFrame, first: str, second: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ``groups`` (array of struct a, b: the ids of both sides) of every whole text.

    Null and empty texts, and texts whose bytes the second side doesn't keep, have none.  Repeated rows give repeated
    results, an empty table an empty one, and columns not in ``keep`` go.
    """
    shared = _shared(docs.sparkSession, first, second)
    ids = T.ArrayType(T.IntegerType())
    out = T.ArrayType(T.StructType([T.StructField("a", ids), T.StructField("b", ids)]))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("groups", out)])
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = _loaded(*shared.value)
        for batch in batches:
            found = [[{"a": a, "b": b} for a, b in al.groups(t.as_py())] for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, kind)], names=schema.names)

    return docs.select(*keep, "text").mapInArrow(run, schema)


LONGS = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of stretches of rows with some BLOCK_CHARS characters."""
    held, chars, start = [], 0, 0
    for t in texts:
        held.append(t.as_py())
        chars += len(held[-1] or "")
        if chars >= BLOCK_CHARS:
            yield start, held
            start, held, chars = start + len(held), [], 0
    if held:
        yield start, held


def linked(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and ``codes`` (first id times the second vocabulary's size plus
    second id, of every link in no order) of every whole text.

    A block's distinct stretches are tokenized and aligned once, whatever the number of texts that hold them.
    """
    shared = _shared(docs.sparkSession, first, second)
    al = _loaded(*shared.value)
    codes = T.ArrayType(T.IntegerType() if al.code_type == pa.int32() else T.LongType())
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in LONGS), T.StructField("groups_sha256", T.StringType()), T.StructField("codes", codes)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = _loaded(*shared.value)
        for batch in batches:
            for start, texts in _blocks(batch.column(1)):
                index: dict[str, int] = {}
                parts = [np.array([index.setdefault(p, len(index)) for p in al.split(t)], np.int64) for t in texts]
                found = al.aligned(list(index))
                parts = [own[:0] if found.failed[own].any() else own for own in parts]
                numbers = np.array([found.numbers[own].sum(0) for own in parts])
                digests = [hashlib.sha256("".join([found.shown[k] for k in own.tolist()])[:-1].encode()).hexdigest() if len(own) else "" for own in parts]
                links = found.codes.take(pa.array(np.concatenate(parts))).flatten()
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(numbers[:, 3])], pa.int32()), links)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *(pa.array(numbers[:, k]) for k in range(4)), pa.array(digests, pa.string()), lists], names=schema.names)

    return spread(docs.select("doc_id", "text")).mapInArrow(run, schema)


def best_pairs(found: DataFrame, width: int) -> DataFrame:
    """``code``, ``n`` (links of the id pair in all texts) and ``best``: whether no pair of the same second id has more.

    The maxima are one row per second id, so the vocabulary bounds what is broadcast.
    """
    pairs = materialize(found.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n")), "align-pairs")
    second = F.col("code") % width
    most = pairs.groupBy(second.alias("b")).agg(F.max("n").alias("most"))
    return pairs.join(F.broadcast(most), second == F.col("b")).select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every whole text.

    ``n_best`` counts the links whose id pair no pair of the same second id exceeds in links in all texts, ``count_sum`` adds the
    pairs' links in all texts over a text's links.  Same rules as :func:`groups`; without tokens all numbers are zero and the digest is ''.
    """
    found = materialize(linked(docs, first, second), "align-texts")
    pairs = materialize(best_pairs(found, _loaded(read_vocabulary(first), read_vocabulary(second)).width), "align-best")
    return (_looked_up if pairs.count() <= BROADCAST_PAIRS else _joined)(found, pairs)


def _looked_up(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The counts are held by every task: at most BROADCAST_PAIRS of them."""
    spark = found.sparkSession
    known = pairs.toArrow().sort_by("code")
    counts = spark.sparkContext.broadcast(tuple(known.column(c).to_numpy() for c in ("code", "n", "best")))
    longs = [T.StructField(c, T.LongType()) for c in (*LONGS, "n_best", "count_sum")]
    schema = T.StructType([found.schema["doc_id"], *longs, found.schema["groups_sha256"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, times, best = counts.value
        for b in batches:
            lists = b.column(6)
            at = np.searchsorted(codes, lists.flatten().to_numpy())
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sums = [pa.array(np.diff(np.r_[0, np.cumsum(x[at], dtype=np.int64)][ends])) for x in (best, times)]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *sums, b.column(5)], names=schema.names)

    return found.mapInArrow(run, schema)


def _joined(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """A row per text and link meets the counts in a join, whose hot pairs adaptive execution splits."""
    (row,) = fresh(found, "row")
    numbered = materialize(found.withColumn(row, F.monotonically_increasing_id()), "align-rows")
    held = numbered.select(row, F.explode("codes").alias("code")).join(pairs, "code")
    sums = held.groupBy(row).agg(F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("n").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return numbered.drop("codes").join(sums, row, "left").select("doc_id", *LONGS, zero("n_best"), zero("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: every whole text of documents under the 50k byte-level and the 32k piece vocabulary."""
    import public_tokenizers

    return alignments(table(spark, sf_dir, "documents"), default_path(), public_tokenizers.path("piece_bpe_32k.model"))
