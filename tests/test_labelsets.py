from lamellar.functions.geometry import Scale
from lamellar.operators import labelsets

SCHEMA = "chunk_x int, chunk_y int, chunk_z int, label long"
A, B, C = (Scale(str(k), (n, n, 64)) for k, n in enumerate((512, 256, 128)))


def python(rows, fx, fy):
    out = {}
    for x, y, z, label in rows:
        if label is not None:
            out.setdefault((x // fx, y // fy, z), set()).add(label)
    return {k: len(v) for k, v in out.items()}


def counted(df):
    return {tuple(r)[:3]: r.unique_labels for r in df.collect()}


def test_unions_up_a_pyramid(spark):
    # 70,000 labels in one chunk fill three buckets; labels that chunks share, repeats, nulls and negative bit patterns
    rows = [(0, 0, 0, 7 * k - 1000) for k in range(70_000)] + [(x, y, 0, label) for x in range(8) for y in range(8) for label in (-1, 5, x, x * y, 0)] + [(3, 3, 0, 5), (4, 4, 0, None), (7, 7, 0, -(1 << 63))]
    df = spark.createDataFrame(rows, SCHEMA)
    numbers = labelsets.numbered(df, A)
    found = numbers.collect()
    assert sorted(r.number for r in found) == list(range(1, len({r[3] for r in rows} - {None}) + 1))
    own = labelsets.sets(df, numbers)
    assert counted(labelsets.counts(own)) == python(rows, 1, 1)
    up = labelsets.raised(own, A, B)
    assert up.schema["chunk_x"].dataType.simpleString() == "int"
    assert counted(labelsets.counts(up)) == python(rows, 2, 2)
    assert counted(labelsets.counts(labelsets.raised(up, B, C))) == python(rows, 4, 4)
    whole = labelsets.counts(labelsets.merged(own.selectExpr("chunk_z as k", "bucket", "bits"), ["k"]), ["k"]).head()
    assert whole.unique_labels == len(found)


def test_axes_that_stay_and_no_rows(spark):
    rows = [(x, 0, z, x + z) for x in range(4) for z in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    own = labelsets.sets(df, labelsets.numbered(df, A))
    flat = labelsets.raised(own, Scale("a", (256, 64, 256)), Scale("b", (128, 64, 256)))
    assert counted(labelsets.counts(flat)) == python(rows, 2, 1)
    none = spark.createDataFrame([], SCHEMA)
    assert labelsets.counts(labelsets.raised(labelsets.sets(none, labelsets.numbered(none, A)), A, B)).count() == 0


def test_numbers_follow_places(spark):
    rows = [(7, 7, 0, 1), (0, 0, 0, 900), (7, 7, 0, 900), (0, 1, 0, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.label: r.number for r in labelsets.numbered(df, A).collect()} == {900: 1, 3: 2, 1: 3}


def test_small_sets_stay_small(spark):
    # A label or two a chunk: what is exchanged is a number a set, not a bitmap's buffer, and by hash, so that nothing is sorted
    rows = spark.range(20_000).selectExpr("cast(id % 400 as int) as chunk_x", "cast(id div 400 as int) as chunk_y", "cast(id % 3 as int) as chunk_z", "id as label")
    own = labelsets.sets(rows, labelsets.numbered(rows, A))
    up = labelsets.raised(own, A, B)
    assert own.schema["bits"].dataType.simpleString() == up.schema["bits"].dataType.simpleString() == "bigint"
    assert own.count() == 20_000 >= up.count()
    assert "SortAggregate" not in up._jdf.queryExecution().executedPlan().toString()
    assert labelsets.counts(up).agg({"unique_labels": "sum"}).head()[0] == 20_000
