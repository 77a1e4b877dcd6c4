import re

import numpy as np
import pytest
from pyspark.errors import PySparkException

from lamellar.functions.geometry import Scale
from lamellar.operators import chunked, labelsets
from lamellar.plans import pipelines, registry
from lamellar.sources import colocated, volumes

KEYS = ["chunk_x", "chunk_y", "chunk_z"]
SCALES = [Scale(str(k), (100 >> k, 70 >> k, 24 if k < 2 else 12), (8, 8, 8)) for k in range(4)]
SETS = "chunk_x int, chunk_y int, chunk_z int, label long"


def plan_of(df):
    """The physical plan, hash joins and file scans included, after it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"^[ +:*()\d-]*Exchange ", plan_of(df).split("== Initial Plan ==")[0], re.M))


def encoded(spark, seed=1):
    """Chunks of a volume full of small regions of three labels and background, with some noise, so that every scale has all of them."""
    x, y, z = SCALES[0].size
    at = spark.range(x * y * z).selectExpr("id", f"id % {x} as x", f"id div {x} % {y} as y", f"id div {x * y} as z")
    region = f"pmod(xxhash64(x div 11, y div 9, z div 5, {seed}), 4)"
    noise = f"pmod(xxhash64(id, {seed}), 9)"
    return chunked.from_voxels(at.selectExpr("x", "y", "z", f"if({noise} < 4, {noise}, {region}) as label"), SCALES[0])


def as_dict(df):
    return {tuple(r[k] for k in KEYS): bytes(r["encoded"]) for r in df.collect()}


@pytest.mark.parametrize("span", [1, 2, 3, 9])
def test_chunks_equal_those_of_the_exchanged_way(spark, tmp_path, span):
    own = colocated.create(spark, f"{tmp_path}/v", SCALES, buckets=3, span=span)
    first = encoded(spark)
    own.write(first, 0)
    want = first
    for level in (1, 2, 3):
        own.raise_chunks(level)
        want = chunked.put_together(chunked.halved(want, SCALES[level - 1], SCALES[level]), SCALES[level])
        found = own.read(level)
        assert as_dict(found) == as_dict(want) != {}
        assert found.count() == found.select(*KEYS).distinct().count()
    assert own.levels() == [0, 1, 2, 3]


def test_no_exchange_between_scales(spark, tmp_path):
    own = colocated.create(spark, f"{tmp_path}/v", SCALES, buckets=3)
    own.write(encoded(spark), 0)
    own.raise_chunks(1)
    vote = chunked.downsampled(own.homed(1), SCALES[0], SCALES[1], "home")
    assert exchanges(vote) == 0 and "FlatMapGroupsInArrow" in plan_of(vote)
    with colocated.subset_keys(spark):
        pairs = own.pairs(1)
        assert exchanges(pairs) == 0 and "SortMergeJoin" in plan_of(pairs)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    assert exchanges(own.pairs(1)) == 2  # the same rows, the exchanged way
    files = list((tmp_path / "v").glob("level_1_*/*.parquet"))
    assert len(files) <= 3  # one a bucket


def test_pairs_against_plain_python(spark, tmp_path):
    own = colocated.create(spark, f"{tmp_path}/v", SCALES, buckets=4, span=2)
    own.write(encoded(spark, 2), 0)
    for level in (1, 2, 3):
        own.raise_chunks(level)
        low, high = (as_dict(own.read(k)) for k in (level - 1, level))
        factors = [2, 2, 2 if level == 2 else 1]
        want = {(p, c): (low[p], high[c]) for p in low if (c := tuple(a // f for a, f in zip(p, factors, strict=True))) in high}
        with colocated.subset_keys(spark):
            rows = own.pairs(level).collect()
            lost = own.pairs(level, how="left").where("child_encoded is null").count()
        found = {(tuple(r[f"parent_{a}"] for a in "xyz"), tuple(r[k] for k in KEYS)): (bytes(r.parent_encoded), bytes(r.child_encoded)) for r in rows}
        assert found == want != {} and len(rows) == len(want)
        assert lost == len(low) - len(want)


def test_label_sets_rise_in_place(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(int(x), int(y), int(z), int(v)) for x, y, z, v in zip(rng.integers(0, 13, 3000), rng.integers(0, 9, 3000), rng.integers(0, 3, 3000), rng.integers(-40, 40, 3000), strict=True)]
    rows += [(12, 8, 2, v) for v in range(40_000)] + rows[:50] + [(1, 1, 1, None)]
    df = spark.createDataFrame(rows, SETS)
    own = colocated.create(spark, f"{tmp_path}/s", SCALES, buckets=3)
    own.write(labelsets.sets(df, labelsets.numbered(df, SCALES[0])), 0)
    seen = {}
    for x, y, z, v in rows:
        if v is not None:
            seen.setdefault((x, y, z), set()).add(v)
    for level in (1, 2, 3):
        own.raise_sets(level)
        up = {}
        for (x, y, z), some in seen.items():
            up.setdefault((x // 2, y // 2, z // (2 if level == 2 else 1)), set()).update(some)
        seen = up
        counts = labelsets.counts(own.read(level), ["home", *KEYS])
        assert {tuple(r[k] for k in KEYS): r.unique_labels for r in counts.collect()} == {k: len(v) for k, v in seen.items()}
        assert exchanges(counts) == 0


def test_found_again_and_written_again(spark, tmp_path):
    own = colocated.create(spark, f"{tmp_path}/a'b", SCALES, buckets=2)
    own.write(encoded(spark), 0)
    own.raise_chunks(1)
    before = as_dict(own.read(1))
    own.forget()  # as a new session begins
    again = colocated.attach(spark, f"{tmp_path}/a'b")
    assert again == own and as_dict(again.read(1)) == before
    assert exchanges(chunked.downsampled(again.homed(2), SCALES[1], SCALES[2], "home")) == 0
    reader = again.read(1)
    again.write(encoded(spark, 5), 0)
    again.raise_chunks(1)
    assert as_dict(reader) == before != as_dict(again.read(1))  # the old folder serves who reads it
    assert again.vacuum() == 2 and again.vacuum() == 0
    assert as_dict(own.read(1)) == as_dict(again.read(1))


def test_empty_tables_wrong_rows_and_clashing_names(spark, tmp_path):
    own = colocated.create(spark, f"{tmp_path}/e", SCALES, buckets=2)
    schema = "chunk_x int, chunk_y int, chunk_z int, encoded binary"
    own.write(spark.createDataFrame([], schema), 0)
    own.raise_chunks(1)
    assert own.read(1).count() == 0
    with colocated.subset_keys(spark):
        assert own.pairs(1).count() == 0
    for at in ((13, 0, 0), (0, -1, 0), (None, 0, 0)):
        with pytest.raises(PySparkException, match="outside the grid"):
            own.write(spark.createDataFrame([(*at, b"")], schema), 0)
    assert own.read(0).count() == 0  # a failed write leaves what was there
    with pytest.raises(ValueError, match="home"):
        own.write(spark.createDataFrame([], schema + ", Home int"), 0)
    with pytest.raises(ValueError, match="not written"):
        own.read(3)
    with pytest.raises(ValueError):
        colocated.create(spark, f"{tmp_path}/x", [], 2)
    own.write(spark.createDataFrame([(1, 1, 1, "a", 5), (1, 1, 1, "a", 5), (3, 3, 1, None, None)], "chunk_x int, chunk_y int, chunk_z int, parent_x string, encoded int"), 0)
    own.write(spark.createDataFrame([(0, 0, 1, 9)], "chunk_x int, chunk_y int, chunk_z int, v int"), 1)
    with colocated.subset_keys(spark):
        rows = own.pairs(1, how="full").select("parent_parent_x", "parent_encoded", "child_v").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [("a", 5, 9), ("a", 5, 9), (None, None, None)]))
    assert colocated.buckets_for(0) == 1 and colocated.buckets_for(10 * (1 << 28) + 1) == 11


def test_pyramid_in_place_writes_the_same_files(spark, tmp_path):
    scales = [Scale(s.key, s.size, s.chunk, 1, 1, max(0, sum(s.bits) - 2)) for s in SCALES]
    out = [f"{tmp_path}/{name}" for name in ("exchanged", "in_place")]
    chunks = pipelines.materialize(encoded(spark, 7), "chunks")
    for path in out:
        volumes.write_volume(chunks, path, scales[0], 0)
    one = pipelines.pyramid(spark, out[0], scales)
    two = pipelines.pyramid_in_place(spark, out[1], scales, buckets=3, span=2)
    for level in (1, 2, 3):
        assert sorted(map(tuple, one[level].collect())) == sorted(map(tuple, two[level].collect())) != []
        files = [{f.relative_to(path): f.read_bytes() for f in (tmp_path / path).rglob("*.shard")} for path in out]
        assert files[0] == files[1] and len(files[0]) > 3


def test_sets_are_words_that_rise_by_hash(spark, tmp_path):
    df = spark.range(5000).selectExpr("cast(id % 13 as int) as chunk_x", "cast(id % 9 as int) as chunk_y", "cast(id % 3 as int) as chunk_z", "id as label")
    own = colocated.create(spark, f"{tmp_path}/w", SCALES, buckets=3)
    own.write(labelsets.sets(df, labelsets.numbered(df, SCALES[0])), 0)
    own.raise_sets(1)
    assert [own.read(k).schema["bits"].dataType.simpleString() for k in (0, 1)] == ["bigint"] * 2
    up = labelsets.merged(own.homed(1).selectExpr("home", "chunk_x div 2 as chunk_x", "bucket", "bits"), ["home", "chunk_x"])
    assert exchanges(up) == 0 and "SortAggregate" not in plan_of(up)
    assert labelsets.counts(own.read(1), ["home", *KEYS]).agg({"unique_labels": "sum"}).head()[0] == 5000


def test_sets_are_written_with_one_exchange(spark, tmp_path):
    # Repeats, negative labels and a null, in parts; each row goes to its bucket once and is merged there
    df = spark.range(6000).selectExpr("cast(id % 13 as int) as chunk_x", "cast(id % 9 as int) as chunk_y", "cast(id % 3 as int) as chunk_z", "if(id = 77, null, id % 1000 - 500) as label").repartition(5)
    words = pipelines.materialize(labelsets.words(df, labelsets.numbered(df, SCALES[0])), "words")
    own, plain = (colocated.create(spark, f"{tmp_path}/{name}", SCALES, buckets=3, span=1) for name in ("own", "plain"))
    assert exchanges(labelsets.merged(own.placed(words, 0), ["home", *KEYS])) == 1
    own.write_sets(words, 0)
    plain.write(labelsets.merged(words, KEYS), 0)
    for level in range(3):
        both = [sorted(tuple(r[c] for c in ("home", *KEYS, "bucket", "bits")) for r in c.read(level).collect()) for c in (own, plain)]
        assert both[0] == both[1] != [] and len(set(both[0])) == len(both[0])
        for c in (own, plain):
            c.raise_sets(level + 1)
    with pytest.raises(PySparkException, match="outside the grid"):
        own.write_sets(spark.createDataFrame([(1, 9, 0, 0, 1)], "chunk_x int, chunk_y int, chunk_z int, bucket long, bits long"), 0)


def test_buckets_of_pairs_follow_the_rows(spark, monkeypatch):
    # However few partitions a session has, no task merges more than its share of line items
    made, create, at = [], colocated.create, "/root/testdata/sf0.001"
    monkeypatch.setattr(colocated, "create", lambda *a, **k: made.append(create(*a, **k)) or made[-1])
    monkeypatch.setattr(registry, "BUCKET_ROWS", 500, raising=False)
    found = registry.QUERIES["colocated_pairs"](spark, at).count()
    monkeypatch.setattr(registry, "BUCKET_ROWS", 1 << 19, raising=False)
    assert found == registry.QUERIES["colocated_pairs"](spark, at).count() > 0
    rows = spark.read.parquet(f"{at}/lineitem.parquet").count()
    assert [own.buckets for own in made] == [colocated.buckets_for(rows, 500), 4]
