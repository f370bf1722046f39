import datetime as dt
import re

import pytest
from conftest import _key, rows
from helpers import log_row, raw_df
from pyspark.sql import functions as F

from shopsignal.operators.clean import coerce_types
from shopsignal.operators import store
from shopsignal.plans import layout
from shopsignal.schemas import PROFILE
from shopsignal.session import scratch_path
from shopsignal.sources import files

PROFILE_ROWS = [
    ("User_1", [("Home", 9), ("Toys", 3)], ["A", "B", "A", "C"]),
    ("User_2", [("Toys", 7), ("Home", None)], []),
    ("User_3", [("Home", 9)], ["C", "D"]),
]
PROFILE_DDL = ("user_id string, top_categories array<struct<category:string,score:bigint>>, "
               "recommended_pairs array<string>")


def _profiles(spark):
    return spark.createDataFrame(PROFILE_ROWS, PROFILE_DDL)


def test_lookups(spark):
    p = _profiles(spark)
    assert [r.user_id for r in store.profile_by_user(p, "User_2").collect()] == ["User_2"]
    assert [tuple(r) for r in store.users_by_category(p, "Home", 3).collect()] == [
        ("User_1", 9), ("User_3", 9), ("User_2", None)]
    assert [r.user_id for r in store.users_by_item(p, "C", 5).collect()] == ["User_1", "User_3"]
    assert store.users_by_item(p, "NOPE", 5).count() == 0


def test_lookup_tables(spark):
    p = _profiles(spark)
    assert rows(store.category_index(p)) == sorted([
        ("Home", 1, "User_1", 9), ("Toys", 2, "User_1", 3), ("Toys", 1, "User_2", 7),
        ("Home", 2, "User_2", None), ("Home", 1, "User_3", 9)], key=_key)
    assert rows(store.item_index(p)) == sorted([
        ("A", "User_1"), ("B", "User_1"), ("C", "User_1"), ("C", "User_3"), ("D", "User_3")], key=_key)


def test_publish_and_read_store(spark):
    p = _profiles(spark)
    paths = store.publish_profiles(p, scratch_path(spark, "store"), n_partitions=2)
    back = files.read_profile_store(spark, paths["profiles"])
    assert back.columns == ["user_id", "top_categories"]
    assert rows(back, "user_id") == [("User_1",), ("User_2",), ("User_3",)]
    by_cat, parts = (spark.read.parquet(paths[t]) for t in ("by_category", "by_category_parts"))
    got = store.users_by_category_indexed(by_cat, parts, "Home", 3).collect()
    assert [tuple(r) for r in got] == [("User_1", 9), ("User_3", 9), ("User_2", None)]
    assert store.users_by_category_indexed(by_cat, parts, "none", 3).collect() == []
    plan = store.users_by_category_indexed(by_cat, parts, "Home")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(category,Home)" in plan
    by_item = spark.read.parquet(paths["by_item"])
    assert [r.user_id for r in store.users_by_item_indexed(by_item, "A").collect()] == ["User_1"]
    assert [r.user_id for r in store.users_by_item_indexed(by_item, "C").collect()] == ["User_1", "User_3"]
    assert store.users_by_item_indexed(by_item, "missing").count() == 0
    plan = store.users_by_item_indexed(by_item, "C")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(item,C)" in plan
    stored = spark.read.schema(PROFILE).parquet(paths["profiles"])
    one = store.profile_by_user(stored, "User_3")
    assert [r.user_id for r in one.collect()] == ["User_3"]
    assert "EqualTo(user_id,User_3)" in one._jdf.queryExecution().executedPlan().toString()


def test_hot_category_lookup_reads_one_file(spark):
    """A category shared by all users lies best first over many files; a lookup reads the first of them."""
    n = 4000
    p = spark.createDataFrame([(f"U{i:05d}", [("Hot", (i * 37) % 1000), (f"C{i % 9}", 1)], ["A"]) for i in range(n)], PROFILE_DDL)
    paths = store.publish_profiles(p, scratch_path(spark, "hot_store"), n_partitions=8)
    by_cat, parts = (spark.read.parquet(paths[t]) for t in ("by_category", "by_category_parts"))
    assert parts.filter("category = 'Hot'").count() >= 3
    want = sorted(((f"U{i:05d}", (i * 37) % 1000) for i in range(n)), key=lambda r: (-r[1], r[0]))
    for limit, most in ((3, 1), (1500, 4), (None, 8)):
        df = store.users_by_category_indexed(by_cat, parts, "Hot", limit)
        assert [tuple(r) for r in df.collect()] == want[:limit]
        files_read = re.findall(r"number of files read: (\d+)", _scan_metrics(df))
        assert files_read and int(files_read[0]) <= most


def _scan_metrics(df) -> str:
    """``name: value`` of every file scan's metrics in the plan that ran, the widest scan first."""
    found = []

    def walk(plan):
        if plan.nodeName().startswith("Scan"):
            it = plan.metrics().iterator()
            metrics = []
            while it.hasNext():
                m = it.next()._2()
                metrics.append(f"{m.name().get()}: {m.value()}")
            found.append(("by_category/" in plan.toString() or "by_category]" in plan.toString(), ", ".join(metrics)))
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            children = [plan.executedPlan()]
        elif hasattr(plan, "plan") and "QueryStage" in plan.nodeName():
            children = [plan.plan()]
        for c in children:
            walk(c)

    walk(df._jdf.queryExecution().executedPlan())
    return found[0][1] if found else ""


def test_publish_is_all_or_nothing(spark, monkeypatch):
    root = scratch_path(spark, "versions")
    store.publish_profiles(_profiles(spark), root, n_partitions=2)
    first = store.versions(spark, root)
    old = store.read_store(spark, root)

    def dies(*args, **kwargs):
        raise RuntimeError("no more")

    with monkeypatch.context() as m:
        m.setattr(store, "item_index", dies)  # the profiles and the category table of the new version are written by then
        with pytest.raises(RuntimeError):
            store.publish_profiles(_profiles(spark).limit(1), root, n_partitions=2)
    assert store.versions(spark, root) == first
    assert store.read_store(spark, root).count() == old.count() == 3
    assert {t: store.read_store(spark, root, t).count() for t in store.TABLES} == {
        "profiles": 3, "by_category": 5, "by_category_parts": spark.read.parquet(store.table_paths(spark, root)["by_category_parts"]).count(),
        "by_item": 5}
    store.publish_profiles(_profiles(spark).filter("user_id = 'User_3'"), root, n_partitions=2)
    assert [r.user_id for r in store.read_store(spark, root).collect()] == ["User_3"]
    assert old.count() == 3  # a reader of the version before goes on
    assert store.read_store(spark, root, version=first[0]).count() == 3
    gone = store.drop_versions(spark, root, keep=1)
    assert len(gone) == 2 and len(store.versions(spark, root)) == 1 and store.read_store(spark, root).count() == 1
    with pytest.raises(FileNotFoundError):
        store.read_store(spark, root, version=first[0])
    with pytest.raises(FileNotFoundError):
        store.read_store(spark, scratch_path(spark, "nothing"))


def test_csv_roundtrip_quotes_newlines_micros(spark):
    t = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = raw_df(spark, [log_row(1, ts=t, pmeta='{"category":"A, \\"quoted\\"\nline"}'), log_row(2, price=None)])
    path = files.write_csv(df, scratch_path(spark, "csv"))
    back = coerce_types(files.read_raw_csv(spark, path), {"event_id": "bigint"})
    assert rows(back) == rows(df)


def test_raw_csv_bad_values_become_null(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(
        "session_id,user_id,product_id,event_type,timestamp,price,user_metadata,product_metadata,event_id\n"
        "S1,U,I,view,2024-01-01T10:00:00.000000,abc,\"{\"\"device\"\":\"\"m\"\"}\",\"{\"\"category\"\":\"\"C\"\"}\",1\n"
        "S1,U,I,view,yesterday,2.5,,,2\n")
    typed = coerce_types(files.read_raw_csv(spark, str(p)), {"event_id": "bigint"})
    back = {r.event_id: r for r in typed.collect()}
    assert back[1].price is None and back[1].user_metadata == '{"device":"m"}'
    assert back[2].timestamp is None and back[2].price == 2.5 and back[2].user_metadata is None


HEADER = "session_id,user_id,product_id,event_type,timestamp,price,user_metadata,product_metadata,event_id\n"


def _csv_line(i, note="plain"):
    return f'S{i % 50},U{i % 20},I{i % 9},view,2024-01-01T10:00:00,1.5,"{{""device"":""m""}}","{{""category"":""C"",""brand"":""{note}""}}",{i}\n'


def test_only_files_with_quoted_line_breaks_are_read_whole(spark, tmp_path):
    """One big plain file is split over many tasks, one with a quoted line break is not, and all rows are right."""
    folder = tmp_path / "raw logs=1"
    folder.mkdir()
    plain, broken, small = folder / "plain +%.csv", folder / "broken.csv", folder / "small.csv"
    plain.write_text(HEADER + "".join(_csv_line(i) for i in range(4000)))
    broken.write_text(HEADER + "".join(_csv_line(i, "two\nlines" if i == 6000 else "plain") for i in range(4000, 8000)))
    small.write_text(HEADER + _csv_line(8000, "a\nb"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        found = {r["path"].rsplit("/", 1)[1]: r["multi_line"] for r in files.csv_files(spark, str(folder)).collect()}
        assert found == {"plain +%.csv": False, "broken.csv": True, "small.csv": True}
        assert files.read_raw_csv(spark, str(plain)).rdd.getNumPartitions() >= 8
        assert files.read_raw_csv(spark, str(broken)).rdd.getNumPartitions() == 1
        df = files.read_raw_csv(spark, str(folder))
        assert df.rdd.getNumPartitions() >= 8
        ids = sorted(int(r[0]) for r in df.select("event_id").collect())
        assert ids == list(range(8001))
        assert df.filter(F.col("product_metadata").contains("two\nlines")).count() == 1
        assert df.filter(F.col("product_metadata").contains("a\nb")).count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_parquet_roundtrips(spark):
    p = _profiles(spark)
    back = files.read_profiles_json(spark, files.write_json(p, scratch_path(spark, "json"), n_partitions=3))
    assert rows(back) == rows(p)
    back2 = spark.read.parquet(files.write_parquet(p, scratch_path(spark, "pq"), n_partitions=2))
    assert rows(back2) == rows(p)


def test_layout_ops_keep_rows(spark):
    df = spark.createDataFrame([(f"S{i % 7}", i) for i in range(200)], "session_id string, v long")
    assert rows(layout.round_robin(df, 5)) == rows(df)
    keyed = layout.by_key(df, "session_id", 4)
    assert keyed.rdd.getNumPartitions() == 4
    tagged = keyed.withColumn("pid", F.spark_partition_id())
    spread = tagged.select("session_id", "pid").distinct().groupBy("session_id").count().collect()
    assert all(r["count"] == 1 for r in spread)


def test_partition_sizes_lose_no_row(spark):
    df = spark.range(800).repartition(8)
    for asked in (None, 0, 4, 8, 11):
        got = {r["partition"]: r["rows"] for r in layout.partition_sizes(df, asked).collect()}
        assert sum(got.values()) == 800 and sorted(got) == list(range(max(8, asked or 0)))
    laid = layout.by_id(spark.range(100).withColumn("p", F.col("id") % 3), F.col("p"), 5)
    assert rows(layout.partition_sizes(laid)) == [(0, 34), (1, 33), (2, 33), (3, 0), (4, 0)]
    assert rows(layout.partition_sizes(laid, 1)) == [(0, 34), (1, 33), (2, 33)]
    assert rows(layout.partition_sizes(spark.range(0).coalesce(1), 2)) == [(0, 0), (1, 0)]


def test_clustered_splits_hot_key_and_keeps_key_ranges(spark):
    # a third of all rows share one category
    data = [("HOT" if i % 3 == 0 else f"C{i % 50:02d}", f"User_{i:05d}") for i in range(6000)]
    df = spark.createDataFrame(data, "category string, user_id string")
    out = layout.clustered(df, "category", 8, then="user_id")
    parts = out.groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("category").alias("lo"), F.max("category").alias("hi"), F.count(F.lit(1)).alias("n")
    ).collect()
    assert sum(r.n for r in parts) == len(data) and rows(out) == rows(df)
    hot = [r for r in parts if r.lo <= "HOT" <= r.hi]
    assert len(hot) >= 2  # the hot category is cut over several partitions
    assert max(r.n for r in parts) < 2000  # no partition holds the whole hot key
    # ranges do not interleave: sorted by lo, each partition starts at or after the previous end
    spans = sorted((r.lo, r.hi) for r in parts)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
