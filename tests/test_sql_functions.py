from pyspark.sql import functions as F

from lamellar.functions import bits, geometry as g, models, sql, text

LARGE = g.Scale("large", (94088, 78317, 134576), (64, 64, 64), 9, 6, 19)


def test_sql_functions_equal_columns(spark):
    sql.register(spark)
    sql.register_scale(spark, "big", LARGE)
    t = spark.range(3000).select((F.col("id") * 7 % 1471).alias("x"), (F.col("id") * 13 % 1224).alias("y"), (F.col("id") * 29 % 2103).alias("z"), (F.col("id") - 5).alias("n"))
    t.createOrReplaceTempView("t")
    got = spark.sql("SELECT x, y, z, n, big_morton(x, y, z) AS code, big_shard(big_morton(x, y, z)) AS shard, big_minishard(big_morton(x, y, z)) AS mini, big_shard_file(big_shard(big_morton(x, y, z))) AS file, bits_for(n) AS b, unsigned_label(n) AS u, export_gib(n * 1000000, n, 3) AS gib, pick_tier(export_gib(n * 1000000, n, 3)) AS tier FROM t")
    code = g.morton(LARGE, F.col("x"), F.col("y"), F.col("z"))
    gib = models.export_gib(F.col("n") * 1000000, F.col("n"), F.lit(3))
    want = t.select("x", "y", "z", "n", code.alias("code"), g.shard_number(LARGE, code).alias("shard"), g.minishard_number(LARGE, code).alias("mini"), g.shard_filename(g.shard_number(LARGE, code), 19).alias("file"), bits.bits_for(F.col("n")).alias("b"), bits.unsigned(F.col("n")).alias("u"), gib.alias("gib"), models.pick_tier(gib).alias("tier"))
    assert got.exceptAll(want).count() == 0 and got.count() == 3000
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_error_class_in_sql(spark):
    sql.register(spark)
    for m in ("ZSTD", "CURL error", "Not found", "timeout", "OOM", "x"):
        assert spark.sql("SELECT error_class(:m) AS c", {"m": m}).head().c == spark.range(1).select(text.error_class(F.lit(m))).head()[0]
