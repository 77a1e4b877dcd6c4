"""Merkle manifests against a plain tree, on odd rows and keys, and over several rounds of buckets."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lamellar.llm import merkle
from lamellar.session import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, place int, member string, key string, path string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fanout=3):
    """(root, each leaf's list of (place, siblings))."""
    proofs, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + fanout, len(nodes))) for i in range(0, len(nodes), fanout)]
        for run in runs:
            for place, node in enumerate(run):
                for i in spans[node]:
                    proofs[i].append((place, [nodes[k] for k in run if k != node]))
        nodes, spans = [digest(*(nodes[k] for k in run)) for run in runs], [[i for k in run for i in spans[k]] for run in runs]
    return nodes[0], proofs


def expected(rows, fanout=3):
    """Contract rows, by brute force, of (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = [], []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *tree([leaf(r) for r in own], fanout)))
    if not trees:
        return []
    root, above = tree([t[1] for t in trees], fanout)
    for (own, subroot, proofs), upper in zip(trees, above, strict=True):
        for r, lower in zip(own, proofs, strict=True):
            proof = lower + upper
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = leaf((*r[:4], r[4].replace("\n", ""))) if even and r[4] is not None else leaf(r)
            for place, others in proof:
                now = digest(*others[:place], now, *others[place:])
            out.append((r[0], leaf(r), subroot, root, digest(*(d for _, o in proof for d in o)), now, now == root))
    return out


def docs_of(rng, n, sources):
    texts = ["", None, "a\nb", "x" * 50_000 + "\n", "é中\n", "plain"]
    rows = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 3]), rng.choice(texts)) for i in rng.sample(range(10 * n + 1), n)]
    return rows + rows[:3] + [(rows[0][0], rows[0][1], "de", 1, "same id"), (None, "s1", None, None, "no id\n"), (None, None, None, None, None)] if n else []


def frame(spark, rows):
    return spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "t", 1, "m", "k", "p") for r in rows], SCHEMA)


def by_query(spark, monkeypatch, docs, **kw):
    """The query over a table of one's own, with other parameters of the operator."""
    own = merkle.manifest
    monkeypatch.setattr(merkle, "table", lambda *_: docs)
    monkeypatch.setattr(merkle, "manifest", lambda d, **k: own(d, **k, **kw))
    return merkle.query(spark, "")


@pytest.mark.parametrize("n,levels,fanout", [(200, 1, 3), (120, 2, 2), (60, 7, 3), (0, 7, 3), (1, 7, 3)])
def test_against_a_plain_tree(spark, monkeypatch, n, levels, fanout):
    rng = random.Random(n)
    rows = docs_of(rng, n, ["s1"] * 5 + ["s2", "ß", "z", "", None, "lone"])
    got = [tuple(r) for r in by_query(spark, monkeypatch, frame(spark, rows), levels=levels, fanout=fanout).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(rows, fanout)))


def test_one_source_and_single_rows(spark, monkeypatch):
    for rows in ([(7, "s", "en", 2, "a\nb")], [(i, "s", None, None, "t") for i in range(10)], [(i, f"s{i}", None, None, "t\n") for i in range(10)]):
        got = [tuple(r) for r in by_query(spark, monkeypatch, frame(spark, rows)).collect()]
        assert sorted(got) == sorted(expected(rows))


def test_proofs_have_every_sibling(spark):
    """Every proof leads from its leaf to the root, and from no other leaf."""
    docs = frame(spark, [(i, f"s{i % 2}", "en", 1, f"text {i}") for i in range(50)])
    found = merkle.manifest(docs, levels=2).collect()
    root = {bytes(r.root) for r in found}
    assert len(root) == 1 and {r.place for r in found if r.tree == 0} == set(range(25))
    for r, other in zip(found, found[1:] + found[:1], strict=True):
        assert merkle.fold(bytes(r.leaf), bytes(r.path), bytes(r.siblings)) == bytes(r.root) != merkle.fold(bytes(other.leaf), bytes(r.path), bytes(r.siblings))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(tuple, merkle.query(spark, sf).collect())) == sorted(expected(rows))


def test_manifest_of_other_columns(spark):
    docs = spark.range(30).select(F.format_string("k%02d", "id").alias("name"), (F.col("id") % 3).alias("shard"))
    found = merkle.manifest(docs, key="name", group="shard", columns=("name",)).orderBy("tree", "place").collect()
    assert [r.name for r in found if r.tree == 1] == [f"k{i:02d}" for i in range(30) if i % 3 == 1]
    assert bytes(found[0].leaf).hex() == digest("3:k00")
