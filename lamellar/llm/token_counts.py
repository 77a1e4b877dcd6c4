"""Token counts of a unigram tokenizer without building tokens: count-only Viterbi.

An Aho-Corasick automaton over the vocabulary enumerates every match that ends at a character; dynamic
programming keeps, for each position, only the best score and the number of pieces on that best path.

Tie rules are the unigram tokenizer's: paths are tried by ascending start of their last piece and a later
one must be strictly better, so among equal scores the longest last piece wins.  A character that no
single-character piece covers may also be unknown, at ten below the lowest score and after all pieces;
unknown characters count as their UTF-8 bytes (byte fallback).

White space handling is the piece format's: each space becomes U+2581 and one is put in front.  Where no piece has
U+2581 behind another character, every best path cuts there, and the words between are solved once each; other
vocabularies are solved over whole texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lamellar.session import ship, spread, table

#: The piece format's visible space (fixed by the format).
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Entries of the per-process word table and the longest word kept in it; they bound memory only.
CACHE_ENTRIES, CACHE_CHARS = 200_000, 64


class UnigramCounter:
    """Counts pieces of the best segmentation for a vocabulary of (piece, score)."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        best: dict[str, float] = {}
        for p, s in pieces:
            best[p] = max(s, best.get(p, s))
        for p, s in best.items():
            self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.whole = any(SPACE in p.lstrip(SPACE) for p in best)
        self.single = {p for p in best if len(p) == 1}
        self.unknown = min(best.values(), default=0.0) - UNKNOWN_PENALTY
        self._words: dict[str, tuple[int, float]] = {}
        self._split = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

    def word(self, w: str) -> tuple[int, float]:
        """(pieces, score) of the best path over ``w`` alone."""
        n = len(w)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        reached = 0  # positions up to here are settled
        for end, (length, s) in self.automaton.iter(w):
            end += 1
            while reached < end - 1:
                reached += 1
                self._unknown(w, reached, score, count)
            start = end - length  # matches that end here come longest first
            if reached < end:
                reached, score[end], count[end] = end, score[start] + s, count[start] + 1
                if w[start:end] not in self.single:
                    self._late(w, end, score, count)
            elif score[start] + s > score[end]:
                score[end], count[end] = score[start] + s, count[start] + 1
        while reached < n:
            reached += 1
            self._unknown(w, reached, score, count)
        return count[n], score[n]

    def _unknown(self, w: str, end: int, score: list[float], count: list[int]) -> None:
        score[end], count[end] = score[end - 1] + self.unknown, count[end - 1] + len(w[end - 1].encode())

    def _late(self, w: str, end: int, score: list[float], count: list[int]) -> None:
        """The unknown path to ``end``, if the character has no piece: strictly better paths win over it."""
        if w[end - 1] not in self.single and score[end - 1] + self.unknown > score[end]:
            self._unknown(w, end, score, count)

    def count(self, text: str) -> tuple[int, float]:
        """(pieces, score) of a whole text; an empty one has (0, 0)."""
        if not text:
            return 0, 0.0
        words, n, total = self._words, 0, 0.0
        spaced = SPACE + text.replace(" ", SPACE)
        if self.whole:
            return self.word(spaced)
        for w in self._split(spaced):
            got = words.get(w)
            if got is None:
                got = self.word(w)
                if len(w) <= CACHE_CHARS:
                    if len(words) >= CACHE_ENTRIES:
                        words.clear()
                    words[w] = got
            n += got[0]
            total += got[1]
        return n, total


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces and scores of a sentencepiece model file, read on the driver."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = (i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)))
    return [(m.id_to_piece(i), m.get_score(i)) for i in ordinary]


_LOADED: dict[str, UnigramCounter] = {}


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]]) -> DataFrame:
    """doc_id, n_chars, n_tokens, score of every whole text.

    ``pieces`` is shipped to the executors: its size is the vocabulary's, whatever the corpus.  Null texts
    count as empty: no tokens, score 0.  Repeated rows give repeated results, an empty table an empty one,
    and other columns are not read.
    """
    ship(docs.sparkSession)
    key = hashlib.sha256(repr(pieces).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_chars", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _LOADED.get(key) or _LOADED.setdefault(key, UnigramCounter(shared.value))
        for b in batches:
            chars, counts, scores = [], [], []
            for x in b.column(1):
                text = x.as_py() or ""
                n, s = counter.count(text)
                chars.append(len(text))
                counts.append(n)
                scores.append(s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(chars, pa.int64()), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())], names=schema.names)

    return spread(docs.select("doc_id", "text")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: token counts of all documents with the 32k piece vocabulary and its scores."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), read_pieces(public_tokenizers.path("piece_bpe_32k.model")))
