"""URL filters against brute force: odd URLs, rules of all shapes, lists with false positives, filters of one block."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamellar.llm import urls

ODD = [None, "", "x", "://", "http://", "http://a", "HTTP://WWW.A.Net", "http://a.net/", "http://b.a.net/en", "http://b.a.net/en/x?q#f", "http://xa.net/en/", "http://anet/", "http://net/", "http://.net/",
       "http://a.net?x=/", "http://a.net#/", "http://A.NET:80/en/", "http://a..net/en/", "ftp://É.Net/É/", "a://b://c.net/d", "http://a.net/en//", "http://www.a.net:443/p/?utm_source=1&b=2&a=1&&#z",
       "http://" + "a." * 30_000 + "net/" + "d/" * 20_000, "http://a.net/" + "é" * 50_000]


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path, rest[len(host) + len(path) :]


def form(url):
    host, path, rest = parts(url)
    query = "&".join(sorted(p for p in rest.split("#")[0][1:].split("&") if p and not p.startswith("utm_"))) if rest.startswith("?") else ""
    return host and re.sub(":(80|443)$", "", re.sub(r"^www\.", "", host)) + path.rstrip("/") + (f"?{query}" if query else "")


def judged(url, rules, listed):
    host, path, _ = parts(url)
    fit = [((len(h + p), len(h)), h + p, a) for h, p, a in rules if (h in ("", host) or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None, key=lambda f: (f[0], f[2] == "block"))
    known = form(url) != "" and form(url) in listed
    return host, path, best and best[1], known, best[2] if best else "block" if known else "allow"


def pages_of(spark, found):
    rows = [(i if i != 3 else None, u, "h", "host", 1, [2], "best") for i, u in enumerate(found)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, labels int, may array<int>, best string")


@pytest.mark.parametrize("blocks,per_block", [(1 << 19, 32), (1, 1)])
def test_against_brute_force(spark, monkeypatch, blocks, per_block):
    monkeypatch.setattr(urls, "MAX_BLOCKS", blocks)
    monkeypatch.setattr(urls, "PER_BLOCK", per_block)
    r = random.Random(3)
    hosts, dirs = ["a.net", "b.a.net", "net", "x.org", "y.x.org", "org", "a.org"], ["", "/", "/en", "/en/", "/en/x", "/e", "/de/"]
    found = ODD + [f"http://{r.choice(['', 'www.', 'm.'])}{r.choice(hosts)}{r.choice(dirs)}{r.choice(['', '?b=2&a=1', '#t', '?utm_x=1'])}" for _ in range(300)]
    found += found[-5:]
    rules = [(h, d, r.choice(["allow", "block"])) for h in hosts for d in dirs if r.random() < 0.3] + [("b.a.net", "/e", "block"), ("a.net", "/en/x", "allow"), ("x.org", "/en", "allow"), ("x.org", "/en", "block")]
    listed = {form(u) for u in found[::7]} | {f"other{i}.net/p" for i in range(200)} | {"", None}
    listing = urls.entries(spark.createDataFrame(rules, "host string, path string, action string"), spark.createDataFrame([(u,) for u in listed], "url string"))
    got = [tuple(x) for x in urls.judge(pages_of(spark, found), listing).collect()]
    want = [(i if i != 3 else None, *judged(u, rules, listed)) for i, u in enumerate(found)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert urls.judge(pages_of(spark, []), listing).count() == 0


def test_only_rules_or_only_urls(spark):
    pages = pages_of(spark, ["http://a.net/x", "http://b.org/", None])
    rule = spark.createDataFrame([("", "/x", "block")], "host string, path string, action string")
    url = spark.createDataFrame([("b.org",)], "url string")
    assert [x.verdict for x in urls.judge(pages, urls.entries(rule, None)).orderBy("page_id").collect()] == ["block", "allow", "allow"]
    assert [x.verdict for x in urls.judge(pages, urls.entries(None, url)).orderBy("page_id").collect()] == ["allow", "block", "allow"]
    assert {x.verdict for x in urls.judge(pages, urls.entries(rule.where("false"), None)).collect()} == {"allow"}
    with pytest.raises(ValueError, match="neither"):
        urls.entries(None, None)


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    words = urls.bloom(keys, 20_000)
    assert words.shape == (625, urls.WORDS)
    asked = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("key")).select("key", urls._place(F.col("key"), 625).alias("at"), urls._bits(F.col("key")).alias("bits")).toArrow()
    hit = urls.passes(words, asked.column("at").to_numpy(), asked.column("bits").to_numpy())
    own = np.array([int(k[1:]) < 20_000 for k in asked.column("key").to_pylist()])
    assert hit[own].all() and hit[~own].mean() < 0.005


def test_shapes_are_refused_not_cut(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_SHAPES", 2)
    rules = spark.createDataFrame([("a", "/" * k, "allow") for k in range(3)], "host string, path string, action string")
    with pytest.raises(ValueError, match="shapes"):
        urls.judge(pages_of(spark, ["http://a/"]), urls.entries(rules, None))


def test_query(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = sorted(map(repr, duckdb.sql(urls.ORACLE).fetchall()))
    assert sorted(repr(tuple(r)) for r in urls.query(spark, sf).collect()) == want
