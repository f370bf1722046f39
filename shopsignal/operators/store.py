"""

The reference loads profiles into a document database with three indexes and
queries it.  Here the store is a directory of versions, each with tables that are clustered
(range-partitioned and sorted) on their lookup key so Parquet min/max statistics
prune files and row groups for point lookups:

* ``profiles``     clustered by ``user_id``     (index on user_id)
* ``by_category``  clustered by ``category``, best scores first  (multikey index on top_categories.category)
* ``by_category_parts``  how many rows of a category each part of ``by_category`` holds
* ``by_item``      clustered by ``item``        (index on recommended_pairs)

A version is complete before anyone can see it: its tables are written to
``versions/<version>``, and only then does an empty file ``published/<version>``
name it.  Readers take the last name there, so a publish that dies half way
changes nothing, and readers of the version before go on undisturbed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.layout import clustered
from ..schemas import PROFILE

TABLES = ("profiles", "by_category", "by_category_parts", "by_item")


def category_index(profiles: DataFrame) -> DataFrame:
    """Q5: one row per (user, ranked category): ``category, rank, user_id, score`` (rank from 1)."""
    return profiles.select("user_id", F.posexplode("top_categories").alias("_pos", "_tc")).select(
        F.col("_tc.category").alias("category"),
        (F.col("_pos") + 1).alias("rank"),
        "user_id",
        F.col("_tc.score").alias("score"),
    )


def item_index(profiles: DataFrame) -> DataFrame:
    """Q6: one row per (recommended item, user): ``item, user_id``."""
    return profiles.select(F.explode(F.array_distinct("recommended_pairs")).alias("item"), "user_id")


# ---------------------------------------------------------------- versions
def _folder(spark: SparkSession, path: str):
    """``(file system, path)`` of the store's own file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _folder(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def versions(spark: SparkSession, path: str) -> list[str]:
    """The published versions of the store at ``path``, oldest first."""
    return _names(spark, f"{path.rstrip('/')}/published")


def _next_version(spark: SparkSession, root: str) -> str:
    """A new name behind all others, published or not; its own part keeps two publishers apart."""
    known = [n for n in _names(spark, f"{root}/versions") + versions(spark, root) if n[:8].isdigit()]
    return f"{max((int(n[:8]) for n in known), default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"


def _tables(root: str, version: str) -> dict[str, str]:
    return {t: f"{root}/versions/{version}/{t}" for t in TABLES}


def table_paths(spark: SparkSession, path: str, version: str | None = None) -> dict[str, str]:
    """The table folders of a version (the last published one)."""
    root = path.rstrip("/")
    published = versions(spark, root)
    if version is None and not published:
        raise FileNotFoundError(f"no version is published in {root}")
    if version is not None and version not in published:
        raise FileNotFoundError(f"{root} has no published version {version}; it has {', '.join(published)}")
    return _tables(root, version or published[-1])


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` published versions, and what unfinished publishes before those left; their names."""
    root = path.rstrip("/")
    published = versions(spark, root)
    kept = published[-max(1, keep):]
    gone = [v for v in sorted({*published, *_names(spark, f"{root}/versions")}) if kept and v < kept[0]]
    for v in gone:
        for folder in ("published", "versions"):  # the name first: readers stop finding it
            fs, p = _folder(spark, f"{root}/{folder}/{v}")
            fs.delete(p, True)
    return gone


# ---------------------------------------------------------------- publish and read
def publish_profiles(profiles: DataFrame, path: str, n_partitions: int | None = None) -> dict[str, str]:
    """K8: a new version of the store at ``path`` with ``profiles`` and the lookup tables; returns its folders.

    The lookup tables are derived from the written ``profiles`` table, so a
    computed profile plan runs once, not once per table.
    """
    spark, root = profiles.sparkSession, path.rstrip("/")
    version = _next_version(spark, root)
    out = _tables(root, version)
    clustered(profiles, "user_id", n_partitions).write.parquet(out["profiles"])
    profiles = spark.read.parquet(out["profiles"])
    # A category or item can be shared by a third of all users: range on more than the key.
    best_first = [F.col("score").desc_nulls_last(), "user_id"]
    by_category = clustered(category_index(profiles), "category", n_partitions, then=best_first)
    by_category.withColumn("part", F.spark_partition_id()).write.partitionBy("part").parquet(out["by_category"])
    parts = spark.read.parquet(out["by_category"]).groupBy("category", "part").agg(F.count(F.lit(1)).alias("rows"))
    clustered(parts, "category", n_partitions, then="part").write.parquet(out["by_category_parts"])
    clustered(item_index(profiles), "item", n_partitions, then="user_id").write.parquet(out["by_item"])
    fs, name = _folder(spark, f"{root}/published/{version}")
    fs.create(name, False).close()
    return out


def read_store(spark: SparkSession, path: str, table: str = "profiles", version: str | None = None) -> DataFrame:
    """A table of the store's last published version, or of ``version``."""
    reader = spark.read.schema(PROFILE) if table == "profiles" else spark.read
    return reader.parquet(table_paths(spark, path, version)[table])


def profile_by_user(profiles: DataFrame, user_id: str) -> DataFrame:
    """Q1: the profile of one user (at most one row).

    On the published ``profiles`` table (clustered by ``user_id``) the
    equality is pushed to the Parquet scan, and min/max statistics skip every
    file and row group whose range cannot hold the user.
    """
    return profiles.filter(F.col("user_id") == user_id).limit(1)


def users_by_category(profiles: DataFrame, category: str, limit: int | None = 3) -> DataFrame:
    """Q2 / Q3: users whose profile has ``category``, with its score; best scores first."""
    hit = F.filter("top_categories", lambda x: x.getField("category") == F.lit(category))
    found = profiles.filter(F.exists("top_categories", lambda x: x.getField("category") == F.lit(category)))
    out = found.select("user_id", F.get(hit, 0).getField("score").alias("score")).orderBy(
        F.col("score").desc_nulls_last(), "user_id"
    )
    return out.limit(limit) if limit else out


def users_by_category_indexed(by_category: DataFrame, parts: DataFrame, category: str, limit: int | None = 3) -> DataFrame:
    """Q2 against the store's category table and its ``by_category_parts``.

    A category's rows lie best first over consecutive parts.  The parts table
    says behind which part ``limit`` rows are complete, and the scan selects
    the folders up to there (a scalar subquery in its partition filter): for a
    few rows, one file, however many users share the category.
    """
    found = by_category.filter(F.col("category") == category)
    if limit:
        so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        mine = parts.filter(F.col("category") == category).select("part", F.sum("rows").over(so_far).alias("rows"))
        # The first part at which there are enough rows; without one all parts are needed.
        enough = mine.agg(F.coalesce(F.min(F.when(F.col("rows") >= limit, F.col("part"))), F.max("part")).alias("part"))
        first = mine.agg(F.min("part").alias("part"))
        found = found.filter(F.col("part").between(first.scalar(), enough.scalar()))
    out = found.select("user_id", "score").orderBy(F.col("score").desc_nulls_last(), "user_id")
    return out.limit(limit) if limit else out


def users_by_item_indexed(by_item: DataFrame, item: str, limit: int | None = 5) -> DataFrame:
    """Q4 against the clustered item table (pushed-down equality on ``item``)."""
    out = by_item.filter(F.col("item") == item).select("user_id").orderBy("user_id")
    return out.limit(limit) if limit else out


def users_by_item(profiles: DataFrame, item: str, limit: int | None = 5) -> DataFrame:
    """Q4: users whose recommendation list contains ``item``; empty when none."""
    out = profiles.filter(F.array_contains("recommended_pairs", item)).select("user_id").orderBy("user_id")
    return out.limit(limit) if limit else out
