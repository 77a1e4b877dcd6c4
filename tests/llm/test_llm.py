"""Operators of the text subpackage against brute force, and on odd rows: nulls, empty and long texts, repeats, ties."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lamellar.llm import bpe, components, fingerprints, katz, mixing, ordering, pii, quality, simhash, suffix_dedup, token_counts, warc
from lamellar.llm.queries import ORACLES, QUERIES
from lamellar.session import shared_dir

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, sketch int, fp string, key string, n int"
WORDS = "the of and thing inea edth rely Tion\tonre ouè mentré été 中文 x1 a-b".split()


def corpus(n=120, seed=1):
    r = random.Random(seed)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(0, 80))) for _ in range(n)]
    texts += [texts[3], texts[3] + " more", "", " \n\t ", "one", None, "é" * 40, "word " * 3000, "a" * 5000, "line\n" * 30, "<|endoftext|> x <|endoftext|>", "tail  \n  spaces  "]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (7, texts[7]), (8, "another text with the same id"), (None, "no id at all"), (None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", None if i == 5 else f"s{(i or 0) % 3}", None if t is None else len(t), "w", 1, "f", "k", 2) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def text_of(r):
    return sorted(map(repr, r))


# --- 1 BPE ------------------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, rows, docs, empty):
    from tokenizers import Tokenizer

    path = bpe.default_path()
    ref, own = Tokenizer.from_file(path), bpe.Tokenizer(bpe.read_vocabulary(path))
    r = random.Random(0)
    odd = ["".join(r.choice("aab  \n\t'sreTHE he0129é…中🎉\x1c\x85ing.,ß") for _ in range(r.randint(1, 50))) for _ in range(1500)]
    for t in [t or "" for _, t in rows] + odd:
        ids = ref.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.decode(ids) == ref.decode(ids, skip_special_tokens=False) == t
    ids_of = {i: r.ids for r in bpe.digests(docs, path, keep_ids=True).collect() if (i := r.doc_id) in (0, 3)}
    assert ids_of == {i: ref.encode(rows[i][1], add_special_tokens=False).ids for i in (0, 3)}
    want = [(i, len(ids := ref.encode(t or "", add_special_tokens=False).ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows]
    assert text_of(map(tuple, bpe.digests(docs, path).collect())) == text_of(want)
    back = bpe.decode(bpe.encode(docs, path), path)
    assert text_of(map(tuple, back.collect())) == text_of((i, t or "") for i, t in rows)
    assert bpe.digests(empty, path).count() == 0


def test_automaton_equals_merging():
    r = random.Random(5)
    for _ in range(60):
        labels = {k: bytes([97 + k]) for k in range(3)}
        merges = []
        while len(merges) < 14:
            u, v = r.choice(list(labels)), r.choice(list(labels))
            if labels[u] + labels[v] not in labels.values():
                labels[len(labels)] = labels[u] + labels[v]
                merges.append((u, v, len(labels) - 1))
        auto = bpe.MergeAutomaton(labels, merges)
        rank = {(u, v): (k, t) for k, (u, v, t) in enumerate(merges)}
        for _ in range(60):
            word = bytes(r.choice(b"abc") for _ in range(r.randint(1, 14)))
            now = [c - 97 for c in word]
            while True:
                pairs = [(rank[p][0], k) for k, p in enumerate(zip(now, now[1:])) if p in rank]
                if not pairs:
                    break
                _, k = min(pairs)
                now[k : k + 2] = [rank[now[k], now[k + 1]][1]]
            assert list(auto.encode(word)) == now


# --- 2 fingerprints ---------------------------------------------------------------------------------------


def shingles(t, k=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def likeness(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_next_rows(spark, rows):
    unique = {i: t for i, t in rows if i is not None and i % 3}
    df = spark.createDataFrame(list(unique.items()), "doc_id long, text string")
    ids = sorted(unique)
    got = {r.doc_id: r.next_text for r in ordering.with_next(df, "doc_id", ["text"]).collect()}
    assert got == {i: unique[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}
    one = df.limit(1)
    assert ordering.with_next(one, "doc_id", ["text"]).head().next_text == one.head().text


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_next_rows_of_hot_ids(spark, monkeypatch, parts):
    """Null and repeated ids that fill several buckets, and columns with the names used inside."""
    r = random.Random(1)
    rows = [(None, f"n{r.random()}") for _ in range(300)] + [(5, f"f{r.random()}") for _ in range(200)] + [(i, f"t{i}") for i in range(10, 60)] + [(5, "same")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"__b": F.lit(1), "__key": F.lit("k"), "__ghost": F.lit(0)})
    monkeypatch.setattr(ordering, "bucket_count", lambda df: parts)
    hashes = dict(df.select("text", F.xxhash64("text")).distinct().collect())
    own = sorted(rows, key=lambda x: (-(1 << 63) if x[0] is None else x[0], hashes[x[1]]))
    got = ordering.with_next(df, "doc_id", ["text"])
    assert got.columns == [*df.columns, "next_text"]
    assert text_of((x.doc_id, x.text, x.next_text) for x in got.collect()) == text_of((*a, b[1]) for a, b in zip(own, own[1:] + own[:1]))


def test_sketches(spark, rows, docs, empty):
    s = docs.where("doc_id is not null").select("doc_id", "text", fingerprints.sketch(F.col("text")).alias("a"))
    other = fingerprints.sketch(F.reverse(F.split(F.coalesce("text", F.lit("")), " ")).cast("string"))
    out = s.select("text", F.size("a").alias("n"), fingerprints.distinct_count(F.col("a")).alias("d"), fingerprints.resemblance(F.col("a"), F.col("a")).alias("same"), fingerprints.containment(F.col("a"), other).alias("c")).collect()
    for r in out:
        true = len(shingles(r.text or ""))
        assert r.n == min(true, fingerprints.K) and r.same == 1 and 0 <= r.c <= 1
        assert r.d == true if true < fingerprints.K else abs(r.d / true - 1) < 0.4
    assert empty.select(fingerprints.sketch(F.col("text"))).count() == 0


def test_merged_sketch_is_the_sketch_of_all(spark):
    parts = spark.createDataFrame([(i % 2, " ".join(f"w{j}" for j in range(i * 40, i * 40 + 60))) for i in range(8)], "g int, text string")
    merged = {r.g: r.sketch for r in fingerprints.merge(parts.select("g", fingerprints.sketch(F.col("text")).alias("sketch")), ["g"]).collect()}
    for g in (0, 1):
        whole = parts.where(F.col("g") == g).select(F.explode(fingerprints.sketch(F.col("text"), 1 << 20)).alias("h")).distinct().orderBy("h").limit(fingerprints.K).collect()
        assert merged[g] == [r.h for r in whole]


def test_fingerprint_query(spark):
    got = {r.doc_id: r for r in QUERIES["op2_fingerprints"](spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    assert len(got) == len(table)
    by_text = {}
    for k, d in enumerate(table):
        t, nxt = d.text or "", table[(k + 1) % len(table)].text or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        r = got[d.doc_id]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - likeness(shingles(t), shingles(edited))) < 0.2
        assert abs(r.near_next - likeness(shingles(t), shingles(nxt))) < 0.2
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint


# --- 3 WARC -----------------------------------------------------------------------------------------------


def warc_expected(pages, min_bytes=0):
    ids = defaultdict(list)
    for p, _, h in pages:
        ids[h or ""].append(p)
    out = []
    for p, _, h in pages:
        data = (h or "").encode()
        known = [i for i in ids[h or ""] if i is not None]
        revisit = len(ids[h or ""]) > 1 and bool(known) and p != min(known) and len(data) >= min_bytes
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", min(known) if revisit else None))
    return out


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_archives(spark, min_bytes):
    pages = [(1, "http://a.b/x", "hi"), (2, "http://a.b/x", "hi"), (2, "http://a.b/x", "hi"), (5, None, None), (6, "bad url \n\t", ""), (None, "http://é.com:80/ü?x=%20y", "hi"), (7, "http://a.b/x", "y" * 3_000_000), (0, "//h", "y" * 3_000_000)]
    pages += [(10 + i, f"https://h{i % 7}.example.org/p/{i}", f"body {i % 9} é") for i in range(300)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, key int")
    folder = f"{shared_dir(spark)}/warc-test-{min_bytes}"
    shards = warc.index(warc.write(df, folder, min_bytes), folder, 7)
    got = warc.lookup(df, shards, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert text_of(map(tuple, got)) == text_of(warc_expected(pages, min_bytes))
    none = warc.lookup(df.limit(0), shards, folder)
    assert none.count() == 0 and warc.lookup(spark.createDataFrame([(99999, "http://no.where/")], "page_id long, url string"), shards, folder).count() == 0


def test_url_keys(spark):
    u = spark.createDataFrame([("http://user@WWW.Example.com:8080/a b?q#f",), (None,), ("nonsense",)], "u string").select(warc.url_key(F.col("u")).alias("k")).collect()
    assert [r.k for r in u] == ["com,example,www:8080)/a%20b?q#f", ")", ")nonsense"]


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    folder = f"{shared_dir(spark)}/warc-none"
    assert warc.lookup(none, warc.index(warc.write(none, folder), folder), folder).count() == 0


def test_warc_query(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = QUERIES["op3_warc"](spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert text_of(map(tuple, got)) == text_of(warc_expected(pages))


# --- 4 repeated strings -----------------------------------------------------------------------------------


def cut(texts, depth=400):
    data = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + depth] for b in data for i in range(len(b) - depth + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        last = 0
        for i in range(len(b) - depth + 1):
            if counts[b[i : i + depth]] > 1:
                s = max(i, last)
                gone[s : i + depth] = b"\1" * (i + depth - s)
                last = i + depth
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("piece", [1 << 20, 700])
def test_repeats(spark, monkeypatch, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    r = random.Random(5)
    base = ["".join(r.choice("abcdefgh é") for _ in range(r.randint(300, 1500))) for _ in range(30)]
    texts = []
    for _ in range(80):
        x = ""
        for _ in range(r.randint(1, 4)):
            y = r.choice(base)
            a = r.randint(0, len(y))
            x += y[a : r.randint(a, len(y))] if r.random() < 0.7 else "".join(r.choice("xyz ") for _ in range(r.randint(0, 300)))
        texts.append(x)
    texts += ["a" * 3000, "ab" * 700, "a" * 401, "b" * 400, "b" * 400, None, "", base[0] * 3, "q" * 500 + base[1]]
    rows = [*enumerate(texts), (3, texts[3]), (3, "other"), (None, texts[5])]
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    want = [(i, *w) for (i, _), w in zip(rows, cut([t for _, t in rows]))]
    assert text_of((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, hashlib.sha256(bytes(x.kept)).hexdigest()) for x in got) == text_of(want)


def test_periodic_runs(spark):
    """Padding and repeated lines: few rows, and the result of all windows."""
    r = random.Random(11)
    noise = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    line = noise(90) + "\n"
    unit = noise(7)
    texts = ["a" * 6000, "b" * 400, "b" * 2500, noise(300) + "=" * 1700 + noise(500), noise(20) + line * 40 + noise(450), line * 5 + line[:37], noise(100) + unit * 300 + "!" + unit * 200, (unit * 80)[3:460], noise(900)]
    texts += [texts[3][:900], "=" * 399, "=" * 401, noise(30) + texts[4][200:700], (line * 9)[50:500], "z" * 1200 + "y" * 1300 + "z" * 900]
    docs = frame(spark, list(enumerate(texts)))
    got = {row.doc_id: (row.n_bytes, row.n_removed, row.n_spans, hashlib.sha256(bytes(row.kept)).hexdigest()) for row in suffix_dedup.remove_repeats(docs).collect()}
    assert got == dict(enumerate(cut(texts)))
    runs = suffix_dedup.periodic(suffix_dedup.np.frombuffer(texts[0].encode(), suffix_dedup.np.uint8))
    assert runs == [(0, 6000, 1)]
    for t in ("a" * 1_000_000, line * 10_000):
        data = suffix_dedup.np.frombuffer(t.encode(), suffix_dedup.np.uint8)
        assert len(suffix_dedup.minimizers(data, runs=suffix_dedup.periodic(data))[0]) < 800


def test_repeats_just_under_the_depth(spark):
    """A passage of over 50 words that two documents share stays at 399 bytes and goes at 400; n_bytes is the text's length either way."""
    r = random.Random(3)
    words = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    short, full = words(70)[:399], words(70)[:400]
    assert min(len(short.split()), len(full.split())) > 50
    texts = [f"{words(30)}\n{short}\n{words(20)}", f"{words(10)}\t{short}\t{words(50)}", f"{words(30)}\n{full}\n{words(20)}", f"{words(10)}\t{full}\t{words(50)}", words(200)]
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans) for x in suffix_dedup.remove_repeats(frame(spark, list(enumerate(texts)))).collect()}
    assert got == {i: (len(t), *((400, 1) if full in t else (0, 0))) for i, t in enumerate(texts)}


def test_repeats_of_nothing(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_repeats_query(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = [(r.doc_id, *w) for r, w in zip(d, cut([r.text for r in d]))]
    got = QUERIES["op4_suffix_dedup"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert text_of(map(tuple, got)) == text_of(want)


# --- 5 SimHash --------------------------------------------------------------------------------------------


def simple_fingerprint(t, k=4):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    own = [b" ".join(w)] if len(w) < k else [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(values, bits=4, more=None, all_bits=128):
    root = list(range(len(values)))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for i in range(len(values)):
        for j in range(i):
            apart = (values[i] ^ values[j]).bit_count()
            if apart <= bits and (more is None or apart + (more[i] ^ more[j]).bit_count() <= all_bits):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def class_ids(ids, values, *how):
    least = {}
    roots = linked(values, *how)
    for i, r in zip(ids, roots):
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return [(i, f"{v:016x}", least[r]) for i, v, r in zip(ids, values, roots)]


def test_classes(spark, rows, docs, empty):
    got = simhash.classes(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    assert text_of(map(tuple, got)) == text_of(class_ids([i for i, _ in rows], [simple_fingerprint(t) for _, t in rows]))
    assert simhash.classes(empty).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(left) == len(set(left)) and (3, rows[3][1]) in left and not any(i == 120 for i, _ in left)


@pytest.mark.parametrize("slot,bits,blocks", [(4000, 4, 3), (3, 4, 3), (50, 7, 4)])
def test_links_lose_nothing(spark, monkeypatch, slot, bits, blocks):
    monkeypatch.setattr(simhash, "SLOT_HOMES", slot)
    r = random.Random(1)
    values = set()
    for _ in range(30):
        b = r.getrandbits(64)
        values.add(b)
        for _ in range(15):
            z = b
            for k in r.sample(range(64), r.randint(0, bits + 2)):
                z ^= 1 << k
            values.add(z)
    values = sorted(values)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v), signed(v), 0) for v in values], "node long, fp long, more long")
    root = {r.node: r.root for r in components.components(simhash.links(df, bits, blocks)).collect()}
    ours, theirs = defaultdict(set), defaultdict(set)
    for v, t in zip(values, linked(values, bits)):
        ours[root.get(signed(v), signed(v))].add(v)
        theirs[t].add(v)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


@pytest.mark.parametrize("slot,tile,all_bits", [(4000, 65_536, 25), (3, 40, 25), (50, 65_536, 24), (50, 65_536, 9)])
def test_wide_links_lose_nothing(spark, monkeypatch, slot, tile, all_bits):
    monkeypatch.setattr(simhash, "SLOT_HOMES", slot)
    monkeypatch.setattr(simhash, "TILE", tile)
    r = random.Random(3)
    values = set()
    for k in range(40):
        b = r.getrandbits(128)
        values.add(b)
        for _ in range(8):
            places = range(64) if k % 4 == 0 else range(64, 128) if k % 4 == 1 else range(128)
            z = b
            for j in r.sample(places, r.randint(all_bits - 2, all_bits + 2) if k % 2 else r.randint(0, all_bits)):
                z ^= 1 << j
            values.add(z)
    values = sorted(values)
    halves = [(v & (1 << 64) - 1, v >> 64) for v in values]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(i, signed(a), signed(b)) for i, (a, b) in enumerate(halves)], "node long, fp long, more long")
    root = {r.node: r.root for r in components.components(simhash.links(df, all_bits=all_bits)).collect()}
    ours, theirs = defaultdict(set), defaultdict(set)
    for i, t in enumerate(linked([a for a, _ in halves], 64, [b for _, b in halves], all_bits)):
        ours[root.get(i, i)].add(i)
        theirs[t].add(i)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_keep_first_drops_near_copies(spark):
    """Of pairs whose five-word shingles are 0.8 alike and more, 0.9 and more lose their second text."""
    r = random.Random(4)
    own, near = [], []
    while len(near) < 120:
        w = [f"w{r.getrandbits(40)}" for _ in range(220)]
        v = list(w)
        for k in r.sample(range(220), r.randint(1, 4)):
            v[k] = f"w{r.getrandbits(40)}"
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (w, v))
        if len(a & b) >= 0.8 * len(a | b):
            own.append(" ".join(w))
            near.append(" ".join(v))
    docs = frame(spark, [*enumerate(own), *((1000 + i, t) for i, t in enumerate(near))])
    kept = {x.doc_id for x in simhash.keep_first(docs).collect()}
    assert set(range(120)) <= kept and len(kept) <= 120 + 12


def test_keep_first_against_brute_force(spark):
    d = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    more = [simhash.majority(simhash.remixed(simhash.hashes(t, 5))) for _, t in d]
    want = {i for i, _, c in class_ids([i for i, _ in d], [simple_fingerprint(t, 5) for _, t in d], 64, more, 25) if i == c}
    assert {r.doc_id for r in simhash.keep_first(frame(spark, d)).collect()} == want


def test_keep_first_keeps_rows_not_ids(spark):
    r = random.Random(6)
    text = lambda: " ".join(f"w{r.getrandbits(40)}" for _ in range(100))
    a, b, c, d, e = (text() for _ in range(5))
    # B under the id that names A's class is a copy of document 3; copies that share an id; nulls alone and with others.
    rows = [(5, a), (7, a), (5, b), (3, b), (9, c), (9, c + " "), (None, d), (None, d + "  "), (None, e), (11, e)]
    docs = frame(spark, rows)
    for own in (docs, docs.union(docs)):
        kept = [(x.doc_id, x.text.strip()) for x in simhash.keep_first(own).collect()]
        assert sorted(kept, key=str) == sorted([(5, a), (3, b), (9, c), (None, d), (11, e)], key=str)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5000, 5000), (7, 8)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and len({got[1000 + i] for i in range(80)}) == 1 and got[0] != got[1000] and 5000 not in got


def test_simhash_query(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = QUERIES["op5_simhash"](spark, SF).select("doc_id", "fingerprint", "component_id").collect()
    assert text_of(map(tuple, got)) == text_of(class_ids([r.doc_id for r in d], [simple_fingerprint(r.text) for r in d]))


# --- 6 quality --------------------------------------------------------------------------------------------


def measures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    c = Counter(windows)
    inside = {j for i, x in enumerate(windows) if c[x] > 1 for j in range(i, i + 5)}
    n, chars, sym, dup, rep = len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)
    failed = n < 10 or 100 * rep > 20 * n
    kept = not (failed or 10 * sym > n or 2 * dup > len(lines) or chars < 3 * n or chars > 12 * n)
    return n, chars, sym, dup, rep, failed, kept


def test_quality(rows, docs, empty):
    got = quality.verdicts(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert text_of(map(tuple, got)) == text_of((i, *measures(t)) for i, t in rows)
    assert quality.verdicts(empty).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert text_of((r.doc_id, r.text) for r in kept.collect()) == text_of((i, t) for i, t in rows if measures(t)[-1])


def test_cascade_order(docs):
    plan = quality.plan(docs)
    worth = [share / cost for _, share, cost in plan]
    assert worth == sorted(worth, reverse=True) and {r.name for r, _, _ in plan} == {r.name for r in quality.RULES}


# --- 7 Katz -----------------------------------------------------------------------------------------------


def katz_brute(rows, order=katz.ORDER):
    """Counts and probabilities straight from the definition, for any order."""
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    uni = Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(uni.values()), len(uni)
    p1 = lambda w: (uni[w] + 1) / (n + v + 1)
    grams = lambda t, k: [(tuple(["begin", *t][max(0, j + 1 - (k - 1)) : j + 1]), w) for j, w in enumerate(t)]  # noqa: E731  contexts stop at the document's start
    levels = {}
    for k in range(2, order + 1):
        seen = Counter(g for i, t in tokens if not held(i) for g in grams(t, k))
        sizes = Counter(seen.values())
        d = katz.discounts([sizes[r] for r in range(1, katz.K + 2)])
        off = lambda c, d=d: d[c - 1] if c <= katz.K else 1.0
        after = defaultdict(dict)
        for (c, w), r in seen.items():
            after[c][w] = r
        levels[k] = (after, off, {})

    def p(context, w, k):
        if k == 1:
            return p1(w)
        after, off, weights = levels[k]
        lower = context[1:] if len(context) == k - 1 and k > 2 else context  # shorter ones begin the document
        if context not in after:
            return p(lower, w, k - 1)
        if context not in weights:
            f = after[context]
            total, mass = sum(f.values()), sum(off(c) * c for c in f.values())
            total += total - mass < 1e-9
            weights[context] = (1 - mass / total) / (1 - sum(p(lower, x, k - 1) for x in f)), total
            assert abs(mass / total + weights[context][0] * (1 - sum(p(lower, x, k - 1) for x in f)) - 1) < 1e-9
        r = after[context].get(w, 0)
        return off(r) * r / weights[context][1] if r else weights[context][0] * p(lower, w, k - 1)

    out = []
    for i, t in tokens:
        s = sum(math.log10(p(c, w, order)) for c, w in grams(t, order))
        out.append((i, held(i), len(t), sum(uni[w] > 0 for w in t), n, sum(math.log10(p1(w)) for w in t), s))
    return out


def same_scores(got, want):
    own = sorted(map(tuple, got), key=lambda r: repr(r[:5]) + f"{r[5]:.3f}{r[6]:.3f}")
    want = sorted(want, key=lambda r: repr(r[:5]) + f"{r[5]:.3f}{r[6]:.3f}")
    assert len(own) == len(want)
    for a, b in zip(own, want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-5) and a[6] == pytest.approx(b[6], abs=1e-5)


@pytest.mark.parametrize("bucket,part,hot,order", [(24 << 20, 1 << 20, 5, 2), (2000, 3000, 40, 2), (2000, 1 << 20, 1 << 40, 3), (3000, 3000, 20, 3), (24 << 20, 1 << 20, 5, 4)])
def test_katz(spark, monkeypatch, rows, docs, empty, bucket, part, hot, order):
    monkeypatch.setattr(katz, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(katz, "PART_BYTES", part)
    monkeypatch.setattr(katz, "HOT_TOKENS", hot)
    own = [*rows, (11, "New york " * 9 + "x")]
    same_scores(katz.score(frame(spark, own), order).collect(), katz_brute(own, order))
    assert katz.score(empty).count() == 0


def test_katz_query(spark):
    d = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same_scores(QUERIES["op7_katz"](spark, SF).collect(), katz_brute(d))


# --- 8 mixing ---------------------------------------------------------------------------------------------


def test_mixing(spark, rows, docs, empty):
    out = mixing.replicate(docs, keep_draw=True)
    assert [c for c in out.columns if c not in ("n_copies", "copy", "shuffle_key")] == docs.columns
    again = mixing.replicate(docs.repartition(7), keep_draw=True)
    assert text_of(map(tuple, out.collect())) == text_of(map(tuple, again.collect()))
    assert mixing.replicate(empty).count() == 0 and mixing.replicate(docs).columns == docs.columns


def test_names_inside_clash_with_none(spark, docs):
    """User columns with the names that operators use inside come through whole."""
    names = ["__n", "__u", "__KEY", "__copy", "__own", "__salt", "__deal", "__source", "__parts", "__cdf", "__id", "__key", "__b", "__tie", "__to"]
    names = [n for k, n in enumerate(names) if n.lower() not in [m.lower() for m in names[:k]]]
    own = docs.where("doc_id < 20").withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for out in (mixing.replicate(own), simhash.keep_first(own), pii.mask(own), quality.keep_good(own)):
        assert out.columns == own.columns
        assert all(x[n] == f"{n}{x.doc_id}" for x in out.collect() for n in names)


def test_mixing_deals_rows_of_one_id(spark):
    docs = spark.range(8000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"))
    sizes = [r.n for r in mixing.replicate(docs, total=40_000).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 3 * sum(sizes) / 4


def test_mixing_hits_its_targets(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "warm").otherwise(None).alias("source"))
    weights = {"hot": 1.0, "warm": 1.0, None: 2.0}
    got = {r.source: r["count"] for r in mixing.replicate(docs, weights, total=40_000).groupBy("source").count().collect()}
    assert all(abs(got[s] - 10_000 * w) < 500 * w for s, w in weights.items())
    many = mixing.replicate(docs.limit(50), {None: 1.0}, total=5000)
    assert abs(many.count() - 5000) < 500
    assert set(mixing.replicate(docs, {"hot": 1.0}).select("source").distinct().toPandas().source) == {"hot"}


def test_mixing_beyond_broadcast(spark, docs, monkeypatch):
    want = text_of(map(tuple, mixing.replicate(docs, keep_draw=True).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert text_of(map(tuple, mixing.replicate(docs, keep_draw=True).collect())) == want


# --- 9 personal data --------------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def found(t):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]


def personal():
    r = random.Random(3)
    texts = ["".join(r.choice("ab1234567890 .@+-()4%é") for _ in range(r.randint(0, 80))) for _ in range(3000)]
    return [*texts, "a@b.c.d@e.f@g", "4111 1111 1111 1111 x", "call +1 (865) 555-5454.", "a@@b.c", None, "", "1" * 4000 + ".1.1.1", "x" * 50_000]


def test_base_spans():
    for t in personal():
        assert pii.base_spans(t or "") == found(t or "")


def test_field_finds_what_patterns_cannot(spark, empty):
    field = pii.train(pii.labelled_table())
    texts = ["reach us at (865) 555-5454 today", "or 865-555-5454", "version 1.2.3 of 2024-01-05, id 4804071098067950", "card 4111.1111.1111.1111 here"]
    assert [[k for k, _, _ in s] for s in pii.field_spans(texts, field)] == [["phone"], ["phone"], [], ["card"]]
    secrets = ['my token = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f" ok', "commit 9c8b45435718dcc700c184a7e303cdc64c6a8f7f ok", "api_key: Zk3Lq81TtWvB42pXa9 and on"]
    assert [[k for k, _, _ in s] for s in pii.field_spans(secrets, field)] == [["secret"], [], ["secret"]]
    held = pii.labelled_table(300, seed=99)
    got = field.decode([pii.features(text, run) for text, run, _ in held])
    pairs = [(pii.LABELS[y], z) for own, (_, _, labels) in zip(got, held) for y, z in zip(own, labels, strict=True)]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.95
    assert pii.find(empty).count() == 0


def test_field_on_documents(spark):
    """Held-out recall on whole documents: without the patterns the field finds nearly all of their spans, and named secrets."""
    field = pii.train(pii.labelled_table())
    texts = [r.text or "" for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("text").collect()]
    own = pii.field_spans(texts, field)
    hit = [any(k == k2 and a < z2 and a2 < z for k2, a2, z2 in f) for t, f in zip(texts, own) for k, a, z in pii.base_spans(t)]
    assert len(hit) > 50 and sum(hit) / len(hit) > 0.95
    named = [f for t, f in zip(texts, own) if re.search('token = "[0-9a-f]{40}"', t)]
    assert named and sum(any(k == "secret" for k, _, _ in f) for f in named) / len(named) > 0.9
    plain = [f for t, f in zip(texts, own) if not re.search("[0-9@]", t)]
    assert plain and not any(plain)


def test_shapes_are_of_whole_tokens():
    field = pii.train(pii.labelled_table())
    text = f"write to {'é' * 70}@mail.example.org now"
    assert pii.shape("é" * 70 + "@mail.example.org") == "x@x.x.x" and pii.shape("a" * 64 + "1") == "xd" and pii.shape("9" * 100) == "d100"
    assert not pii.base_spans(text) and pii.field_spans([text], field) == [[("email", 9, 9 + 70 + 17)]]


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    field = pii.train(pii.labelled_table(60), steps=20)
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(5, 4, len(pii.LABELS)))
    for own, got in zip(scores, field.viterbi(scores)):
        value = lambda p: field.start[p[0]] + own[0, p[0]] + sum(field.move[a, b] + own[t + 1, b] for t, (a, b) in enumerate(zip(p, p[1:])))
        assert value(got) == pytest.approx(max(map(value, itertools.product(range(len(pii.LABELS)), repeat=4))))


def test_long_runs_in_blocks(monkeypatch):
    """Blocks change no label, and memory follows the block, not the run."""
    import tracemalloc

    field = pii.train(pii.labelled_table(200))
    r = random.Random(6)
    forms = ["(202) 555-0143", "4111 1111 1111 1111", "7", "12", "a@b", "10.0.0.1", "x1=9f86d081884c7d65", "3.5", "2024-01-02"]
    texts = [" ".join(r.choice(forms) for _ in range(n)) for n in (1, 40, 300)] + ["word " + " ".join(r.choice(forms) for _ in range(70)) + " end", "", "none"]
    want = [sorted(x) for x in pii.field_spans(texts, field)]
    for held in (1, 2, 7, 64):
        monkeypatch.setattr(pii, "HELD_TOKENS", held)
        assert [sorted(x) for x in pii.field_spans(texts, field)] == want
    monkeypatch.undo()
    text = "1 2 3 " * 50_000
    tracemalloc.start()
    pii.field_spans([text], field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # 150,000 tokens held about 300 MB of features before they were made in blocks


def test_slices_are_bounded_by_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(pii, "SLICE", 3)
    monkeypatch.setattr(pii, "SLICE_BYTES", 10)
    texts = ["ab", None, "x" * 30, "y" * 9, "zz", "", "", "", "q"]
    found = [b.column(0).to_pylist() for b in pii._slices(iter([pa.record_batch([pa.array(texts)], names=["text"])]), 0)]
    assert [t for b in found for t in b] == texts and all(len(b) <= 3 and (len(b) == 1 or sum(map(len, filter(None, b))) <= 10) for b in found)


def test_merge_keeps_what_overlaps_nothing():
    r = random.Random(2)
    for _ in range(200):
        spans = [[(r.choice(pii.FIELD_KINDS), a := r.randrange(60), a + r.randint(1, 9)) for _ in range(r.randint(0, 9))] for _ in range(2)]
        base, more = spans
        free = [s for s in more if all(s[2] <= a or b <= s[1] for _, a, b in base)]
        assert pii.merge(base, more) == sorted(base + free, key=lambda s: (pii.FIELD_KINDS.index(s[0]), s[1], s[2]))


def test_spans_and_masks(spark):
    texts = personal()
    df = frame(spark, [*enumerate(texts), (1, texts[1]), (None, "a@b.cd")])
    for r in pii.find(df).where("doc_id is not null").collect():
        base = found(texts[r.doc_id] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest() and {pii.written([s]) for s in base} <= set(r.spans.split(",")) | {""}
    clean = pii.mask(df)
    assert clean.columns == df.columns and clean.count() == df.count()
    one = clean.where("text like '%<email>%'").head()
    assert not EMAIL.search(one.text.replace("<email>", " ")) or "@" in one.text
    assert clean.where("n_chars <> length(text)").count() == 0


# --- 10 token counts --------------------------------------------------------------------------------------


def test_token_counts(spark, rows, docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer, models

    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    counter = token_counts.UnigramCounter(pieces)
    ref = Tokenizer(models.Unigram([("<unk>", min(s for _, s in pieces)), *pieces], 0, False)).model
    r = random.Random(2)
    odd = ["".join(r.choice("ab the in  er\n中é_xq") for _ in range(r.randint(1, 30))) for _ in range(1500)]

    def want(t):
        return sum(len(x.value.encode()) if x.id == 0 else 1 for x in ref.tokenize("▁" + t.replace(" ", "▁"))) if t else 0

    for t in odd:
        assert counter.count(t)[0] == want(t)
    got = token_counts.count_tokens(docs, pieces).select("doc_id", "n_chars", "n_tokens").collect()
    assert text_of(map(tuple, got)) == text_of((i, len(t or ""), want(t or "")) for i, t in rows)
    assert token_counts.count_tokens(empty, pieces).count() == 0


def test_ties_go_to_the_longest_last_piece():
    c = token_counts.UnigramCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", 0.0)])
    assert c.count("ab") == (2, -2.0)
    inner = token_counts.UnigramCounter([("a", -1.0), ("b", -1.0), ("▁", -1.0), ("a▁b", -1.5)])
    assert inner.count("a b a b") == (4, -5.0) and inner.count("ab" * 50) == (101, -101.0)  # a piece with a space inside
    c = token_counts.UnigramCounter([("a", -1.0), ("bc", -2.0), ("ab", -1.0), ("c", -2.0), ("▁", 0.0)])
    assert c.count("abc") == (3, -3.0)


# --- queries and pipeline ---------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert text_of(map(tuple, df.select(*names).collect())) == text_of(result.fetchall())


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "tokens"]
    table = spark.read.parquet(f"{SF}/documents.parquet")
    d = [(r.doc_id, r.text, r.source) for r in table.collect() if measures(r.text)[-1]]
    prints = [simple_fingerprint(t, 5) for _, t, _ in d]
    more = [simhash.majority(simhash.remixed(simhash.hashes(t, 5))) for _, t, _ in d]
    first = {(i, c) for i, _, c in class_ids([i for i, _, _ in d], prints, 64, more, 25)}
    d = [r for r in d if (r[0], r[0]) in first]
    field = pii.train(pii.labelled_table())
    d = [(i, pii.masked(t, pii.merge(found(t), pii.field_spans([t], field)[0])), s) for i, t, s in d]
    n = Counter(s for _, _, s in d)
    total = sum(math.sqrt(c) for c in n.values())
    ref = Tokenizer.from_file(bpe.default_path())
    want = []
    for i, t, s in d:
        rate = len(d) * math.sqrt(n[s]) / total / n[s]
        u = int(hashlib.md5(f"42|{i}|0".encode()).hexdigest()[:13], 16) / (1 << 52)
        k, p = 0, math.exp(-rate)
        c = p
        while c <= u:
            k += 1
            p *= rate / k
            c += p
        ids = ref.encode(t, add_special_tokens=False).ids
        want += [(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())] * k
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert text_of(tuple(r)[:4] for r in got.collect()) == text_of(want)
    assert all(hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() == r.ids_sha256 for r in got.collect())


def test_stages_keep_the_columns(spark, docs, empty):
    import corpus_pipeline

    for own in (docs, empty):
        now = own
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        assert now.count() >= 0
