"""Alignment against offsets: groups, links, corpus-wide counts, odd texts, and the way without a broadcast."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lamellar.llm import alignment
from lamellar.llm.bpe import byte_alphabet, default_path
from lamellar.session import table

SCHEMA = "doc_id long, text string, code int, n int, row string, b long"
ODD = [None, "", " ", "  ", "a ", " a", "a  b", "\n", "a\n b", "tab\t x", "<|endoftext|> x", "<s> </s> <unk>", "▁", "a▁b", "é中🎉 x", "\x00 y", "\x85 z", "12 345", "don't we'll", "x" * 3000, "é " * 4000, "a \n" * 500, "ab" * 40_000]


def pieces_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Both libraries over whole texts, and spans of bytes."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(default_path())
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path())
        self.alphabet = byte_alphabet()

    def spans(self, text):
        if not text:
            return None
        a = [(i, bytes(self.alphabet[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()) for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        if not b"".join(s for _, s in a) == b"".join(s for _, s in b) == (" " + text).encode():
            return None
        out = []
        for side in (a, b):
            at, own = 0, []
            for i, s in side:
                own.append((at, at + len(s), i))
                at += len(s)
            out.append(own)
        return out

    def links(self, a, b):
        j = 0
        for s, e, i in a:
            while b[j][1] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][0] < e:
                yield i, b[k][2]
                k += 1

    def expected(self, texts):
        held = {t: self.spans(t) for t in set(texts)}
        links = {t: list(self.links(*x)) if x else [] for t, x in held.items()}
        count = Counter()
        for t in texts:
            count.update(links[t])
        most = Counter()
        for (_, b), n in count.items():
            most[b] = max(most[b], n)
        for t in texts:
            if not held[t]:
                yield (0, 0, 0, 0, 0, 0, "")
                continue
            a, b = held[t]
            cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
            groups, ia, ib = [], iter(a), iter(b)
            for c in cuts:
                sides = []
                for it in (ia, ib):
                    own = []
                    for _, e, i in it:
                        own.append(str(i))
                        if e == c:
                            break
                    sides.append(",".join(own))
                groups.append("|".join(sides))
            own = [count[p] for p in links[t]]
            yield (len(a), len(b), len(cuts), len(own), sum(count[p] == most[p[1]] for p in links[t]), sum(own), hashlib.sha256(";".join(groups).encode()).hexdigest())


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    words = "the of and thing inea Tion\tonre ouè mentré 中文 x1 a-b 2024 naïve re- ...ok".split(" ")
    out = [*ODD, *(r.choice(["", " ", "\n"]) + r.choice([" ", " ", " ", "  ", "\n"]).join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(150))]
    return [*out, out[-1], out[-1], out[3]]


def frame(spark, texts):
    return spark.createDataFrame([(None if i == 4 else i // 2, t, 1, 2, "r", 3) for i, t in enumerate(texts)], SCHEMA)


@pytest.mark.parametrize("broadcast", [4_000_000, 0])
def test_against_offsets(spark, monkeypatch, plain, texts, broadcast):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", broadcast)
    got = [tuple(r) for r in alignment.alignments(frame(spark, texts), default_path(), pieces_path()).collect()]
    want = [(None if i == 4 else i // 2, *w) for i, w in enumerate(plain.expected(texts))]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("chars,encoded,transitions", [(64, 20_000, 400_000), (5, 7, 50), (200, 30, 0), (0, 1, 10)])
def test_stretches_together_and_alone(monkeypatch, texts, chars, encoded, transitions):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", chars)
    monkeypatch.setattr(alignment, "ENCODED", encoded)
    monkeypatch.setattr(alignment, "TRANSITIONS", transitions)
    al = alignment.Aligner(open(default_path(), "rb").read(), open(pieces_path(), "rb").read())
    parts = sorted({p for t in texts for p in al.split(t) if len(p) < 10_000})
    found = al.aligned(parts)
    for k, p in enumerate(parts):
        a, b = (x[0] for x in al.tokens([p]))
        want = None if "▁" in p else al.transducer.align(a, b)
        assert found.failed[k] == (want is None)
        groups, links = want or ([], [])
        assert found.shown[k] == "".join(f"{alignment.shown([g])};" for g in groups)
        assert sorted(found.codes[k].as_py()) == sorted(x * al.width + y for x, y in links)
        assert found.numbers[k].tolist() == ([len(a), len(b), len(groups), len(links)] if want else [0] * 4)


@pytest.mark.parametrize("ranked", [True, False])
def test_short_stretches_by_either_encoder(monkeypatch, ranked):
    al = alignment.Aligner(open(default_path(), "rb").read(), open(pieces_path(), "rb").read())
    assert al.ranked
    if not ranked:
        al.ranked = None
    r = random.Random(8)
    parts = list({"".join(r.choice("aab\n\t'sreTHE'he0129é…中🎉\x1c\x85ing.,ß") for _ in range(r.randint(1, 60))) for _ in range(1500)} | {"<|endoftext|>"})
    parts = [p for p in parts if not al.run(" " + p)]
    for side, found in zip(al.tokens(parts), al.flat(parts), strict=True):
        assert [x.tolist() for x in np.split(found[0], np.cumsum(found[1])[:-1])] == side


def test_blocks_hold_every_row(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "BLOCK_CHARS", 5)
    own = ["ab", None, "cdef", "", "x" * 20, "y"]
    found = list(alignment._blocks(pa.array(own, pa.string())))
    assert [t for _, b in found for t in b] == own and [s for s, _ in found] == [0, 3, 5]


@pytest.mark.parametrize("broadcast", [4_000_000, 0])
def test_no_rows(spark, monkeypatch, broadcast):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", broadcast or -1)
    assert alignment.alignments(frame(spark, []), default_path(), pieces_path()).count() == 0


def test_groups_spell_the_same_bytes(spark, plain, texts):
    found = alignment.groups(frame(spark, texts), default_path(), pieces_path(), keep=("doc_id", "row")).collect()
    al = alignment.Aligner(open(default_path(), "rb").read(), open(pieces_path(), "rb").read())
    assert sum(map(len, (r.groups for r in found))) == sum(w[2] for w in plain.expected(texts))
    for r in found:
        for g in r.groups:
            assert b"".join(al.transducer.labels[0][i] for i in g.a) == b"".join(al.transducer.labels[1][i] for i in g.b)


def test_transducer_forgets_and_refuses(monkeypatch):
    r = random.Random(1)
    labels = [b"a", b"b", b"ab", b"ba", b"aba", b"bb"]
    monkeypatch.setattr(alignment, "TRANSITIONS", 3)
    t = alignment.Transducer(labels, labels)
    for _ in range(500):
        a, b = ([r.randrange(6) for _ in range(r.randint(0, 6))] for _ in range(2))
        x, y = (b"".join(labels[i] for i in s) for s in (a, b))
        found = t.align(a, b)
        assert (found is not None) == (x == y)
        if found:
            groups, links = found
            arrays = [np.array(x, np.int64) for x in (a, b)]
            failed, flat, closed = t.align_many(arrays[0], np.array([len(a)]), arrays[1], np.array([len(b)]))
            assert not failed[0] and sorted(map(tuple, flat[1:].T.tolist())) == sorted(links) and len(closed[0]) == len(groups)
            assert [i for g, _ in groups for i in g] == a and [i for _, g in groups for i in g] == b
            assert len(links) == len(a) + len(b) - len(groups)


def test_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    rows = table(spark, sf, "documents").select("doc_id", "text").collect()
    want = [(r.doc_id, *w) for r, w in zip(rows, plain.expected([r.text for r in rows]), strict=True)]
    assert sorted(map(tuple, alignment.query(spark, sf).collect())) == sorted(want)
