from helpers import log_row, raw_df
from pyspark.sql import functions as F

from shopsignal.operators import quality
from shopsignal.plans.layout import partition_sizes


def test_null_counts_one_pass(spark):
    df = raw_df(spark, [log_row(1), log_row(2, session=None, price=None), log_row(3, session=None)])
    r = quality.null_counts(df).first().asDict()
    assert r["session_id"] == 2 and r["price"] == 1 and r["event_id"] == 0
    assert len(r) == len(df.columns)


def test_shape_and_event_counts(spark):
    df = raw_df(spark, [log_row(i, event=e) for i, e in enumerate(["view", "cart", "purchase", "signup"])])
    s = quality.table_shape(df).first()
    assert (s.n_rows, s.n_columns) == (4, 9)
    e = quality.event_counts(df).first()
    assert (e.views, e.carts, e.purchases, e.total, e.all_rows, e.reconciles) == (1, 1, 1, 3, 4, False)


def test_partition_sizes(spark):
    sizes = partition_sizes(spark.range(100).repartition(4), 4).collect()
    assert sorted(r.partition for r in sizes) == [0, 1, 2, 3] and sum(r.rows for r in sizes) == 100
    one_key = partition_sizes(spark.range(100).withColumn("k", F.lit(1)).repartition(8, "k"), 8).collect()
    assert sorted(r.rows for r in one_key) == [0] * 7 + [100]
