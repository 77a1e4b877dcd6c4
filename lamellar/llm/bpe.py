"""Byte-pair encoding and decoding with a compiled tokenization automaton.

The ordered merge list is compiled once into a deterministic automaton over tokens.  It starts as one
state that accepts every byte.  Each merge ``u v -> uv`` then adds one *gadget*, in merge order:

* the state entered by ``u`` is copied; the copy loses the arc ``v`` (after ``u`` a separate ``v`` can no
  longer follow), and ``u`` arcs lead to the copy;
* wherever ``u`` then ``v`` could be read, an arc ``uv`` is added to the state that ``v`` led to.

The copies share almost everything, so they are kept persistently: a state is the token that entered it,
``removed[u, v]`` is the step at which a gadget took arc ``v`` from ``u``'s state, and a token made at step
``r`` inherits the arcs of its right part as they stood at ``r`` and exists wherever its left part did.
A transition is resolved through these tables once and stored in a flat transition table afterwards.  (Copied
out, the automaton of 50k merges has 50,256 states of 48,691 arcs on average, 2.4 * 10^9 in all; the average is
over 200 random states.)

The accepted token strings are exactly the merge results, and every byte string has one; what is accepted of a
word ends, at each byte, in one token.  So reading a word is deterministic and never goes back: after each byte,
of the labels that end there (an Aho-Corasick automaton lists them) one continues the token accepted where it
starts, and that token is the state.  Decoding emits the byte labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lamellar.session import ship, spread, table

#: Pre-splitting pattern of the byte-level tokenizer file format (fixed by the format).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of either half of each per-process word table, and the longest word kept in one; they bound memory only.
CACHE_ENTRIES, CACHE_CHARS = 150_000, 64
#: Resolved transitions kept at once.
TABLE_ENTRIES = 400_000
_FAR = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The format's printable character for each byte: itself if printable Latin-1, else from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class MergeAutomaton:
    """Tables of the automaton built by one gadget per merge; see the module's text."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        """``labels``: bytes of every token; ``merges``: (left, right, result) in order of rank."""
        import ahocorasick

        self.labels = labels
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.step: dict[int, int] = {}
        self.removed: dict[tuple[int, int], int] = {}
        self.table: dict[int, dict[int, bool]] = {}  # by state, by arc
        self.free: dict[int, bool] = {}
        self.resolved = 0
        self.sizes = {t: len(s) for t, s in labels.items()}
        made = {t for _, _, t in merges}
        self.arcs: dict[bytes, int] = {s: t for t, s in labels.items() if t not in made and len(s) == 1}
        if len(made) != len(merges):
            raise ValueError("two merges make the same token; such merge lists are not supported")
        for step, (u, v, t) in enumerate(merges):
            self._gadget(step, u, v, t)
        self.ends = ahocorasick.Automaton()
        for s, t in self.arcs.items():
            self.ends.add_word(s.decode("latin-1"), (len(s), t))
        self.ends.make_automaton()

    def _gadget(self, step: int, u: int, v: int, t: int) -> None:
        live = self.arcs.get(self.labels[u]) == u and self.arcs.get(self.labels[v]) == v
        if live and self._open(u, v):  # else no path reads u then v: the merge never applies
            self.left[t], self.right[t], self.step[t] = u, v, step
            self.arcs[self.labels[t]] = t
        self.removed.setdefault((u, v), step)

    def _open(self, state: int, arc: int) -> bool:
        """Whether the state entered by token ``state`` has the arc ``arc`` after all gadgets so far."""
        until = _FAR
        while True:
            part, within = arc, _FAR
            while True:
                at = self.removed.get((state, part))
                if at is not None and at < until and at <= within:
                    return False
                if part not in self.left:
                    break
                within, part = self.step[part], self.left[part]
            if state not in self.right:
                return True
            until, state = self.step[state], self.right[state]

    def encode(self, word: bytes) -> tuple[int, ...]:
        """Tokens of one pre-split word: one table-driven step a byte, then the accepted labels from the end back."""
        token = self.arcs.get(word)
        if token is not None:
            return (token,)
        n, rows, ends = len(word), self.table, self.ends.iter(word.decode("latin-1"))
        state = [-1] * n  # by byte: the token that the accepted path ends in there
        moves: list[dict[int, bool]] = [self.free] * n  # and its row of the transition table
        done = -1
        for at, (length, token) in ends:
            if at == done:
                continue
            if length <= at:
                own = moves[at - length]
                open_ = own.get(token)
                if open_ is None:
                    open_ = self._resolve(state[at - length], token)
                if not open_:
                    continue
            state[at], done = token, at
            row = rows.get(token)
            if row is None:
                row = rows[token] = {}
            moves[at] = row
        path, at, size = [], n - 1, self.sizes
        while at >= 0:
            token = state[at]
            path.append(token)
            at -= size[token]
        path.reverse()
        return tuple(path)

    def _resolve(self, state: int, token: int) -> bool:
        """A transition looked up for the first time, kept in the table; a full table starts anew."""
        self.resolved += 1
        if self.resolved > TABLE_ENTRIES:
            for row in self.table.values():
                row.clear()
            self.resolved = 1
        open_ = self.table[state][token] = self._open(state, token)
        return open_


class _Words(dict):
    """Word -> tokens, filled on demand.  When full, what was used last becomes the old half; older words go.

    Long words are not kept, so that a table's bytes are bounded too.
    """

    def __init__(self, fill, size):
        self.fill, self.size, self.old = fill, size, {}

    def __missing__(self, key):
        if len(key) > CACHE_CHARS:
            return self.fill(key)
        got = self.old.get(key)
        if got is None:
            got = self.fill(key)
        if len(self) >= self.size:
            self.old = self.copy()
            self.clear()
        self[key] = got
        return got


class Tokenizer:
    """Encoder and decoder for a byte-level BPE file of the ``tokenizers`` JSON format."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model, added = spec["model"], spec.get("added_tokens", [])
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("only byte-level BPE files without a normalizer are supported")
        alphabet, vocab = byte_alphabet(), model["vocab"]
        self.special = {a["content"]: a["id"] for a in added}
        labels = {t: bytes(alphabet[c] for c in s) for s, t in vocab.items() if s not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.automaton = MergeAutomaton(labels, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.labels = labels | {i: s.encode() for s, i in self.special.items()}
        self.numbers = {t: str(t) for t in self.labels}
        self._split = regex.compile(SPLIT.replace(r"\S", r"\P{White_Space}").replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")).findall
        self._run = regex.compile(r" \p{White_Space}").search
        self._special = regex.compile("(" + "|".join(sorted(map(regex.escape, self.special), key=len, reverse=True)) + ")").split if self.special else None
        self._words = _Words(lambda w: self.automaton.encode(w.encode()), CACHE_ENTRIES // 4)
        self._chunks = _Words(lambda c: self._plain(" " + c), CACHE_ENTRIES)

    def _plain(self, text: str) -> tuple[int, ...]:
        body = text[1:]
        if text[:1] == " ":  # the two commonest forms of a chunk, as the pattern would split them
            if body.isalpha():
                return self.automaton.encode(text.encode())
            if body[:-1].isalpha() and body[-1] in ".,;:!?":
                return (*self._words[text[:-1]], *self._words[body[-1]])
        parts = self._split(text)
        if len(parts) == 1 and len(text) < 64:
            return self.automaton.encode(text.encode())  # the chunk table keeps it
        return tuple(chain.from_iterable(map(self._words.__getitem__, parts)))

    def _ordinary(self, text: str) -> list[int]:
        if self._run(text):
            return list(self._plain(text))
        # Without a space before white space, every space starts a word: look whole chunks up.
        first, *rest = text.split(" ")
        return [*self._plain(first), *chain.from_iterable(map(self._chunks.__getitem__, rest))]

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text; the strings of added tokens are those tokens, as in the library."""
        if not self._special or not any(s in text for s in self.special):
            return self._ordinary(text)
        out: list[int] = []
        for part in self._special(text):
            out += [self.special[part]] if part in self.special else self._ordinary(part) if part else []
        return out

    def decode(self, ids: list[int]) -> str:
        """The text whose bytes the arcs' labels spell; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[bytes, Tokenizer] = {}


def loaded(content: bytes) -> Tokenizer:
    """The compiled tokenizer, made once per process."""
    key = hashlib.sha256(content).digest()
    if key not in _LOADED:
        _LOADED[key] = Tokenizer(content)
    return _LOADED[key]


def read_vocabulary(path: str) -> bytes:
    """A vocabulary file's content, read on the driver; a few MB whatever the corpus."""
    with open(path, "rb") as f:
        return f.read()


def _shared(spark: SparkSession, path: str):
    ship(spark)
    return spark.sparkContext.broadcast(read_vocabulary(path))


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ``ids`` (array<int>) of every whole text; null texts count as empty and give an empty array.

    Repeated rows give repeated results; an empty table gives an empty one; columns not in ``keep`` go.
    """
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    content = _shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = loaded(content.value)
        for b in batches:
            ids = [tok.encode(x or "") for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(ids, pa.list_(pa.int32()))], names=[*keep, "ids"])

    return docs.select(*keep, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``text`` of every row's ``ids``; null ids give an empty text."""
    schema = T.StructType([*(encoded.schema[c] for c in keep), T.StructField("text", T.StringType())])
    content = _shared(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = loaded(content.value)
        for b in batches:
            texts = [tok.decode(x or []) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "text"])

    return encoded.select(*keep, "ids").mapInArrow(run, schema)


DIGESTS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def digests(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Encode, decode and digest in one pass over the texts.

    Same rules as :func:`encode`.  Columns: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if ``keep_ids``.
    """
    ids_field = [T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if keep_ids else []
    schema = T.StructType([docs.schema["doc_id"], *DIGESTS.fields, *ids_field])
    content = _shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = loaded(content.value)
        sha = hashlib.sha256
        for b in batches:
            counts, first, second, kept = [], [], [], []
            for x in b.column(1):
                ids = tok.encode(x.as_py() or "")
                counts.append(len(ids))
                first.append(sha(",".join(map(tok.numbers.__getitem__, ids)).encode()).hexdigest())
                second.append(sha(tok.decode(ids).encode()).hexdigest())
                if keep_ids:
                    kept.append(pa.array(ids, pa.int32()))
            lists = []
            if keep_ids:
                values = pa.concat_arrays(kept) if kept else pa.array([], pa.int32())
                lists = [pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, kept))], pa.int32()), values)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string()), *lists], names=schema.names)

    return spread(docs.select("doc_id", "text")).mapInArrow(run, schema)


def default_path() -> str:
    """The byte-level vocabulary of the installed public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every whole text of documents, encoded and decoded."""
    return digests(table(spark, sf_dir, "documents"), default_path())
