"""Personal data: fixed patterns plus a linear-chain conditional random field over word-shape features.

The patterns find the base spans.  The random field adds spans that the patterns can't state: telephone numbers
without a country code, card numbers with other separators, secrets (keys and tokens named as such).  Its features are
a token's shape, the shape's beginning and end, length, kind of characters, and the shapes and words around it; a
feature not seen in training says nothing.  It is trained on the driver from a small labelled table and sent to the
executors, its size fixed by that table.  Its lattice gives tokens without a digit or "@" the label O only, so a text
falls apart at them and each run of other tokens is decoded by itself; runs are decoded in numpy batches of equal
length by Viterbi.  Decoded spans that touch a base span are dropped: base spans always stay as they are.
"""

from __future__ import annotations

import hashlib
import random
import re
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lamellar.session import ship, table

KINDS = ("email", "ip", "card", "phone")
#: Kinds of the random field's spans.
FIELD_KINDS = (*KINDS, "secret")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a digit run does; without that, long digit runs cost their square.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A white space separated token that has a digit or an "@"; starts only at token starts, so it is linear.
_CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_DIGIT = re.compile("[0-9]")
_DIGITS = re.compile("d[0-9]*(?:d[0-9]*)*")
TABLE_ROWS = 800
#: Rows and bytes of text that a task works on at once; one longer text is a slice by itself.
SLICE, SLICE_BYTES = 500, 4 << 20
#: Tokens whose features are held at once; longer runs are decoded in blocks of so many.
HELD_TOKENS = 8192


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def octet(digits: str) -> bool:
    """Whether a run of digits is at most 255."""
    own = digits.lstrip("0")
    return len(own) < 4 and int(own or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind as listed, then start; code points, end exclusive."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and valid("card", m[0]):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if valid("phone", m[0])]
    return out


def valid(kind: str, span: str) -> bool:
    """What a span of the kind must hold besides its form."""
    digits = [c for c in span if c in "0123456789"]
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn("".join(digits))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "secret":
        own = span.rpartition("=")[2] if "=" in span[:-1] else span
        return len(own) >= 8 and any(c.isdigit() for c in own) and any(c.isalpha() for c in own)
    if kind == "ip":
        parts = span.split(".")
        return len(parts) == 4 and all(p.isdecimal() and octet(p) for p in parts)
    return span.count("@") == 1 and "." in span.partition("@")[2]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping email matches, found from each "@" outwards; linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", done if m else at + 1)


# --- the random field -------------------------------------------------------------------------------------

LABELS = ("O", *(f"{p}-{k}" for k in FIELD_KINDS for p in "BI"))
_CLASSES = str.maketrans({chr(c): "d" if chr(c).isdigit() else "x" if chr(c).islower() else "X" for c in range(128) if chr(c).isalnum()})
_RUN = re.compile(r"(x|X)\1+|d{5,}")


def shape(token: str) -> str:
    """Word shape: letters x and X with runs cut to one, digits d with runs of five and more as "d" and their length."""
    own = "".join(c if c.isascii() else "x" for c in token).translate(_CLASSES)
    return _RUN.sub(lambda m: m[1] or f"d{len(m[0])}", own)


def core(token: str) -> tuple[int, int]:
    """Start and end of a token without the punctuation around it."""
    a, b = 0, len(token)
    while a < b and token[a] in "\"'<[{,;:!?.":
        a += 1
    while b > a and token[b - 1] in "\"'>]},;:!?.#*$%&|":
        b -= 1
    return a, b


#: Characters before and after a run in which its neighbouring words are looked for.
NEAR = 40
_WORD = re.compile(r"[A-Za-z]+")
_HEX = re.compile(r"[0-9a-fA-F]+")


def features(text: str, run: list[tuple[int, int]], at: int = 0, left: str = "", right: str | None = None) -> list[list[str]]:
    """Features of each token of a run: its own, its neighbours' shapes and the words before and after the run.

    A part of a run is told how many tokens precede it (``at``) and the shapes beside it (``right`` is None at the run's end).  Words
    beside a run are looked for within NEAR characters, where a longer one is cut.
    """
    tokens = [text[a:b] for a, b in run]
    shapes = [left, *map(shape, tokens), right or ""]
    before = text[max(0, run[0][0] - NEAR) : run[0][0]].lower().rstrip("\"'<[{").split()[-2:] if not at else []
    after = text[run[-1][1] : run[-1][1] + NEAR].lower().split()[:1] if right is None else []
    words = [f"before={w[0]}" for x in before if (w := _WORD.search(x))]
    sign = [f"sign={c}" for c in "=:" if before and c in before[-1]]
    out = []
    for i, t in enumerate(tokens):
        n, s = len(t), shapes[i + 1]
        own = [
            "bias", f"shape={s}", f"short={_DIGITS.sub('d', s)[:24]}", f"first={s[:3]}", f"last={s[-3:]}", f"long={n if n < 12 else 12 if n < 16 else n if n < 20 else 20 + n // 20}", f"dots={min(t.count('.'), 4)}",
            f"at={min(t.count('@'), 2)}", f"hex={bool(_HEX.fullmatch(t)) and not t.isdigit()}", f"left={shapes[i]}", f"right={shapes[i + 2]}", f"place={min(at + i, 3)}",
        ]
        if "=" in t[:-1]:
            own.append(f"name={t.partition('=')[0].lower()}")
        if at + i == 0:
            own += words + sign
        if i == len(tokens) - 1 and after and (w := _WORD.search(after[0])):
            own.append(f"after={w[0]}")
        out.append(own)
    return out


def labelled_table(rows: int = TABLE_ROWS, seed: int = 7) -> list[tuple[str, list[tuple[int, int]], list[str]]]:
    """The small training table: (text, tokens' ends of one run, labels), drawn from written-out forms with a fixed seed."""
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    w = lambda: "".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(2, 8)))
    h = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    octet_ = lambda: str(r.randint(1, 255))
    cues = {"phone": ["call", "phone", "tel:", "at"], "email": ["mail", "to", "contact"], "ip": ["host", "address", "from"], "card": ["card", "visa", "paid"], "O": []}
    names = ["token", "key", "secret", "password", "passwd", "apikey", "api_key", "auth", "bearer"]

    def forms() -> tuple[str, str, str]:
        """Kind, words before, text."""
        name, joint = r.choice(names), r.choice([" = ", "=", ": ", " "])
        value = r.choice([h(40), h(32), h(40).upper(), w() + d(4) + w().upper() + d(3), h(64)])
        quoted = f'"{value}"' if r.random() < 0.5 else value
        kind, own = r.choice([
            ("phone", f"({d(3)}) {d(3)}-{d(4)}"), ("phone", f"{d(3)}-{d(3)}-{d(4)}"), ("phone", f"{d(3)}.{d(3)}.{d(4)}"), ("phone", f"{d(3)} {d(3)} {d(4)}"), ("phone", f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}"), ("phone", f"+{d(2)} {d(3)} {d(4)}"), ("phone", f"+{d(5)}{d(6)}"),
            ("email", f"{w()}.{d(2)}@{w()}.com"), ("email", f"{w()}@{w()}.{w()}.org"), ("email", f"{w()}@{w()}{d(1)}.{w()}.net"), ("email", f"{w()}.{w()}@{w()}.de"),
            ("ip", ".".join(octet_() for _ in range(4))), ("ip", ".".join(octet_() for _ in range(4))), ("ip", ".".join(octet_() for _ in range(4))),
            ("card", f"4{d(15)}"), ("card", f"{d(4)} {d(4)} {d(4)} {d(4)}"), ("card", f"{d(4)}-{d(4)}-{d(4)}-{d(4)}"), ("card", f"{d(4)}.{d(4)}.{d(4)}.{d(4)}"),
            ("secret", quoted), ("secret", quoted), ("secret", quoted), ("secret", f"{name}={value}"),
            ("O", d(r.randint(1, 12))), ("O", f"{d(1)}."), ("O", f"{d(1)}.{d(1)}"), ("O", f"{d(2)}.{d(1)}"), ("O", f"{d(1)}.{d(1)}.{d(1)}"), ("O", f"{w()}{d(2)}"), ("O", f"{d(4)}-{d(2)}-{d(2)}"), ("O", f"{d(2)}/{d(2)}/{d(4)}"),
            ("O", h(32)), ("O", h(40)), ("O", h(40)), ("O", h(64)), ("O", h(12)), ("O", f"({d(4)})"), ("O", f"{d(2)}:{d(2)}"), ("O", f"{d(3)}-{d(4)}"), ("O", f"@{w()}"), ("O", f"${d(3)}"), ("O", f"{d(17)}"), ("O", f"{d(14)}"), ("O", f"{d(1)},{d(3)},{d(3)}"), ("O", f"{d(4)} {d(4)}"),
        ])
        if kind == "secret":
            return kind, "" if "=" in own else name + joint, own
        return kind, r.choice(cues[kind]) + " " if cues[kind] and r.random() < 0.3 else "", own

    out = []
    for _ in range(rows):
        text, labels = f"{w()} {w()}, ", []
        for _ in range(r.choice([1, 1, 1, 2])):
            kind, cue, own = forms()
            text += cue + own + r.choice([" ", ". ", "; ", "! "])
            labels += ["O" if kind == "O" else f"{'I' if i else 'B'}-{kind}" for i in range(len(own.split(" ")))]
        text += w()
        for run in runs_of(text):
            out.append((text, run, labels[: len(run)]))
            labels = labels[len(run) :]
    return out


class Field:
    """Weights: ``emit`` by feature and label, ``move`` between labels, both learned by penalised likelihood."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.index, self.emit, self.move, self.start = index, emit, move, start

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """Best labels for runs of one length: [runs, length, labels] -> [runs, length]."""
        n, length, _ = scores.shape
        back = np.zeros((n, length, len(LABELS)), dtype=np.int8)
        best = self.start + scores[:, 0]
        for t in range(1, length):
            paths = best[:, :, None] + self.move[None]
            back[:, t] = paths.argmax(1)
            best = paths.max(1) + scores[:, t]
        out = np.zeros((n, length), dtype=np.int8)
        out[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = np.take_along_axis(back[:, t], out[:, t, None].astype(np.int64), 1)[:, 0]
        return out

    def decode_long(self, text: str, run: array) -> np.ndarray:
        """Labels of one run of any length: features and scores of a block at a time, and one byte a token and label to go back by."""
        n = len(run) // 2
        back, best = np.zeros((n, len(LABELS)), np.int8), None
        token = lambda k: shape(text[run[2 * k] : run[2 * k + 1]])
        for at in range(0, n, HELD_TOKENS):
            end = min(n, at + HELD_TOKENS)
            part = features(text, list(zip(run[2 * at : 2 * end : 2], run[2 * at + 1 : 2 * end : 2], strict=True)), at, token(at - 1) if at else "", token(end) if end < n else None)
            for k, scores in enumerate(self.emit[_numbers([part], self.index)[0]].sum(1), at):
                if best is None:
                    best = self.start + scores
                else:
                    paths = best[:, None] + self.move
                    back[k] = paths.argmax(0)
                    best = paths.max(0) + scores
        out = np.zeros(n, np.int8)
        out[-1] = best.argmax()
        for k in range(n - 1, 0, -1):
            out[k - 1] = back[k, out[k]]
        return out

    def decode(self, runs: list[list[list[str]]]) -> list[np.ndarray]:
        """Labels of every run, given its tokens' features; runs of one length go through numpy together."""
        by: dict[int, list[int]] = defaultdict(list)
        for i, run in enumerate(runs):
            by[len(run)].append(i)
        out: list[np.ndarray] = [np.empty(0)] * len(runs)
        for length, own in by.items():
            block = max(1, 50_000 // length)
            for k in range(0, len(own), block):
                part = own[k : k + block]
                scores = self.emit[_numbers([runs[i] for i in part], self.index)].sum(2)
                for i, labels in zip(part, self.viterbi(scores), strict=True):
                    out[i] = labels
        return out


def _numbers(runs: list[list[list[str]]], index: dict[str, int]) -> np.ndarray:
    """[runs, length, features]: the features' rows in ``emit``; unknown ones and gaps lead to its last row, of zeros."""
    none = len(index)
    most = max((len(t) for run in runs for t in run), default=1)
    return np.array([[[index.get(f, none) for f in t] + [none] * (most - len(t)) for t in run] for run in runs])


def train(table: list[tuple[str, list[tuple[int, int]], list[str]]], steps: int = 150, rate: float = 0.5, penalty: float = 1e-3) -> Field:
    """Gradient ascent on the penalised conditional likelihood, by forward-backward over runs of equal length."""
    lab = {x: i for i, x in enumerate(LABELS)}
    own = [(features(text, run), [lab[y] for y in labels]) for text, run, labels in table]
    index = {f: i for i, f in enumerate(sorted({f for run, _ in own for t in run for f in t}))}
    k, groups = len(LABELS), defaultdict(list)
    for run, labels in own:
        groups[len(run)].append((run, labels))
    data = [(_numbers([x for x, _ in g], index), np.array([y for _, y in g])) for _, g in sorted(groups.items())]
    emit, move, start = np.zeros((len(index) + 1, k)), np.zeros((k, k)), np.zeros(k)
    total = len(table)
    lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
    sums = [np.zeros_like(emit), np.zeros_like(move), np.zeros_like(start)]
    for _ in range(steps):
        ge, gm, gs = -penalty * emit * total, -penalty * move * total, -penalty * start * total
        for x, y in data:
            n, length, _ = x.shape
            e = emit[x].sum(2)
            a, b = [start + e[:, 0]], [np.zeros((n, k))]
            for t in range(1, length):
                a.append(lse(a[-1][:, :, None] + move[None], 1) + e[:, t])
                b.insert(0, lse(move[None] + (e[:, length - t] + b[0])[:, None, :], 2))
            z = lse(a[-1], 1)
            for t in range(length):
                p = np.exp(a[t] + b[t] - z[:, None])
                off = -p
                off[np.arange(n), y[:, t]] += 1.0
                np.add.at(ge, x[:, t], off[:, None, :])
                if t == 0:
                    gs += off.sum(0)
                else:
                    np.add.at(gm, (y[:, t - 1], y[:, t]), 1.0)
                    gm -= np.exp(a[t - 1][:, :, None] + move[None] + (e[:, t] + b[t])[:, None, :] - z[:, None, None]).sum(0)
        ge[-1] = 0
        for w, g, s in zip((emit, move, start), (ge, gm, gs), sums, strict=True):
            s += g * g
            w += rate * g / np.sqrt(s + 1e-8)
    return Field(index, emit, move, start)


def _runs(text: str) -> Iterator[array]:
    """Runs of neighbouring tokens with a digit or "@", each as start, end, start, end, ... without punctuation."""
    run, last = array("q"), -1
    for m in _CANDIDATE.finditer(text):
        a, b = core(m[0])
        if b > a:
            if run and not (last >= 0 and not text[last : m.start()].strip()):
                yield run
                run = array("q")
            run.extend((m.start() + a, m.start() + b))
            last = m.end()
        else:
            last = -1
    if run:
        yield run


def runs_of(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring tokens with a digit or "@": (start, end) of each token without punctuation."""
    return [list(zip(r[::2], r[1::2], strict=True)) for r in _runs(text)]


def _labelled(text: str, run: array, labels: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """Valid spans that a run's labels state."""
    changes = np.flatnonzero(labels)
    open_at = last = -1
    for t in changes.tolist():
        y = labels[t]
        if open_at >= 0 and (t != last + 1 or y % 2 or (y - 1) // 2 != (labels[open_at] - 1) // 2):
            yield from _span(text, run, labels, open_at, last)
            open_at = -1
        if open_at < 0:
            open_at = t
        last = t
    if open_at >= 0:
        yield from _span(text, run, labels, open_at, last)


def _span(text: str, run: array, labels: np.ndarray, first: int, last: int) -> Iterator[tuple[str, int, int]]:
    kind, a, b = FIELD_KINDS[(labels[first] - 1) // 2], run[2 * first], run[2 * last + 1]
    if valid(kind, text[a:b]):
        yield kind, a, b


def field_spans(texts: list[str], field: Field) -> list[list[tuple[str, int, int]]]:
    """Spans that the random field decodes in each text; no more than HELD_TOKENS tokens' features, or a run's, are held at once."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    held: list[tuple[int, array]] = []

    def flush() -> None:
        pairs = [(i, list(zip(r[::2], r[1::2], strict=True))) for i, r in held]
        for (i, run), labels in zip(held, field.decode([features(texts[i], r) for i, r in pairs]), strict=True):
            found[i].extend(_labelled(texts[i], run, labels))
        held.clear()

    tokens = 0
    for i, x in enumerate(texts):
        for run in _runs(x) if _DIGIT.search(x) or "@" in x else ():
            if len(run) > 2 * HELD_TOKENS:
                found[i].extend(_labelled(x, run, field.decode_long(x, run)))
                continue
            held.append((i, run))
            tokens += len(run) // 2
            if tokens >= HELD_TOKENS:
                flush()
                tokens = 0
    flush()
    return found


def merge(base: list[tuple[str, int, int]], more: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans and those of ``more`` that overlap none of them, by kind as listed, then start."""
    own = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in own], list(accumulate((b for _, b in own), max))  # ends: the furthest of all up to here

    def free(a: int, b: int) -> bool:
        before = bisect_left(starts, b)
        return not before or ends[before - 1] <= a

    return sorted([*base, *(s for s in more if free(s[1], s[2]))], key=lambda s: (FIELD_KINDS.index(s[0]), s[1], s[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of at most SLICE rows and, unless one row is more, SLICE_BYTES of text."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_pylist()
        at = held = 0
        for k, size in enumerate(sizes):
            if k > at and (k - at >= SLICE or held + size > SLICE_BYTES):
                yield b.slice(at, k - at)
                at, held = k, 0
            held += size
        if b.num_rows > at:
            yield b.slice(at)


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of base spans, all spans, and their number.

    Null and empty texts have no spans.  Texts are read whole, and of a very long one some 40 bytes a token are held beside it; repeated rows give repeated results; an empty
    table gives an empty one; other columns are not read.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(field or train(labelled_table()))
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_spans", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, 1):
            texts = [x or "" for x in b.column(1).to_pylist()]
            base = [base_spans(x) for x in texts]
            spans = [merge(x, y) for x, y in zip(base, field_spans(texts, model.value), strict=True)]
            counts = [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in KINDS]
            digest = pa.array([hashlib.sha256(written(x).encode()).hexdigest() for x in base], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, digest, pa.array([written(x) for x in spans], pa.string()), pa.array(list(map(len, spans)), pa.int64())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def mask(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets; n_chars, if there, follows.

    Null texts stay null; texts are read whole; repeated rows are masked alike; an empty table gives an empty one; all
    columns stay, whatever their names.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(field or train(labelled_table()))
    names, at = docs.columns, docs.columns.index("text")
    size = names.index("n_chars") if "n_chars" in names and docs.schema["n_chars"].dataType.typeName() in ("integer", "long") else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, at):
            texts = b.column(at).to_pylist()
            found = field_spans([x or "" for x in texts], model.value)
            clean = [x if x is None else masked(x, merge(base_spans(x), f)) for x, f in zip(texts, found, strict=True)]
            columns = list(b.columns)
            columns[at] = pa.array(clean, pa.string())
            if size >= 0:
                old = b.column(size)
                columns[size] = pa.array([o if x is None or o is None else len(x) for x, o in zip(clean, old.to_pylist(), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with its spans, overlapping ones joined, replaced."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: personal data in all documents."""
    return find(table(spark, sf_dir, "documents"))
