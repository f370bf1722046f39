from pyspark.sql import functions as F

from shopsignal.plans import joins


def _hinted(df) -> bool:
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_row_bytes_counts_string_bytes(spark):
    df = spark.createDataFrame([("ab", 1), ("ééé", 2), (None, 3)], "s string, n long")
    got = [r.b for r in df.select(joins.row_bytes(df).alias("b")).collect()]
    # header 16 + (8 + utf-8 bytes) + 8
    assert got == [16 + 8 + 2 + 8, 16 + 8 + 6 + 8, 16 + 8 + 0 + 8]


def test_checked_broadcast_needs_both_bounds(spark):
    df = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("wide"))
    assert _hinted(joins.checked_broadcast(df, max_rows=1000))  # 100 rows, ~100 KB: broadcast
    assert joins.checked_broadcast(df, max_rows=10) is df  # too many rows
    assert joins.checked_broadcast(df, max_rows=1000, max_bytes=50_000) is df  # too many bytes
    assert joins.checked_broadcast(df, max_rows=None) is df


def test_key_bucket_forms_the_same_groups(spark):
    data = [(None if i % 11 == 0 else f"K{i % 37}", i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, v long")
    plain = sorted((r.k or "", r.n, r.s) for r in df.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).collect())
    bucketed = sorted((r.k or "", r.n, r.s) for r in df.groupBy("k", joins.key_bucket("k")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).collect())
    assert bucketed == plain and len(plain) == 38  # 37 keys and the null key
