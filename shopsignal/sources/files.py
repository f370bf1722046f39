"""File sources and sinks.

Raw logs are read by header name, as text: their types come from
``operators.clean.coerce_types``, so a value that does not parse is a null that
the quality report counts, not a lost row nobody sees.  Tables this library
writes are read back with declared schemas, or (Parquet) their own.  CSV
timestamps are written in a microsecond format, so a round trip is exact.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.layout import round_robin
from ..schemas import AFFINITY, CLEAN, PAIRS, PROFILE, PROFILE_STORE_DDL, RAW

TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CSV_OPTIONS = {"escape": '"', "timestampNTZFormat": TS_NTZ_FORMAT}


def _require(df: DataFrame, columns: Iterable[str], path: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df


# ---------------------------------------------------------------- readers
def _odd_quotes(line: Column) -> Column:
    """Whether a line has an odd number of quotes, as the first line of a quoted line break has."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def csv_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length, multi_line)`` of every file under ``path``: whether it has to be read as a whole.

    A file no larger than a scan split (``spark.sql.files.maxPartitionBytes``)
    is one task either way and counts as multi-line unread.  Of a larger one
    every line is looked at, by many tasks: a line break inside quotes leaves
    a line with an odd number of them (an escaped quote is two), and only such
    a file cannot be split.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = listed.select("path", "length", F.col("_metadata.file_path").alias("_file"))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    large = [r["path"] for r in listed.filter(F.col("length") > split).select("path").collect()]
    if not large:
        return listed.select("path", "length", F.lit(True).alias("multi_line"))
    lines = spark.read.text(large).select(F.col("_metadata.file_path").alias("_file"), _odd_quotes(F.col("value")).alias("_odd"))
    broken = lines.groupBy("_file").agg(F.max("_odd").alias("_broken"))
    multi_line = F.coalesce(F.col("_broken"), F.lit(True))
    return listed.join(broken, "_file", "left").select("path", "length", multi_line.alias("multi_line"))


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Raw log CSV with a header: every column, by its name, as text (empty: null).

    A missing required column is an error; the order of the columns is free and
    further columns are kept.  ``clean.coerce_types`` (the first step of every
    job on raw logs) gives timestamps and prices their types.

    Quoted line breaks are read as such, and a file without them is split over many tasks:
    ``csv_files`` tells which large files have any (one more pass over the large files).
    ``multi_line`` saves that pass where the answer is known: True reads every
    file as a whole, False line by line.
    """
    reader = spark.read.options(header="true", nullValue="", escape='"')
    if multi_line is not None:
        return _require(reader.options(multiLine=str(multi_line).lower()).csv(path), RAW.names, path)
    whole, split = [], []
    for f in csv_files(spark, path).collect():  # the listing that every scan keeps on the driver
        (whole if f["multi_line"] else split).append(f["path"])
    if not split:
        return read_raw_csv(spark, path, multi_line=True)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(root) and fs.getFileStatus(root).isDirectory():
        reader = reader.option("basePath", path)  # columns that stand in folder names
    parts = [_require(reader.options(multiLine=str(flag).lower()).csv(paths), RAW.names, path)
             for paths, flag in ((split, False), (whole, True)) if paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_clean_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned logs, with any further columns the raw logs had."""
    return _require(spark.read.parquet(path), CLEAN.names, path)


def read_clean_csv(spark: SparkSession, path: str, schema: StructType = CLEAN) -> DataFrame:
    """Variant K2 read back: headerless CSV of cleaned logs (``schema``: the columns that were written)."""
    return spark.read.schema(schema).options(header="false", nullValue="", **CSV_OPTIONS).csv(path)


def read_abandoned_csv(spark: SparkSession, path: str) -> DataFrame:
    """K6 read back: abandoned carts, by header name and as text (types: ``clean.coerce_types``)."""
    df = spark.read.options(header="true", nullValue="", multiLine="true", escape='"').csv(path)
    return _require(df, CLEAN.names, path)


def read_campaign_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3: the campaign table, with the columns it was written with."""
    return _require(spark.read.parquet(path), ["user_id", "session_id", "discount_offer"], path)


def read_pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    """Pair frequencies with header."""
    return spark.read.schema(PAIRS).options(header="true", **CSV_OPTIONS).csv(path)


def read_affinity_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AFFINITY).parquet(path)


def read_profiles_json(spark: SparkSession, path: str) -> DataFrame:
    """Profile JSON lines (every part file); a stray ``_id`` field is not read."""
    return spark.read.schema(PROFILE).json(path)


def read_profile_store(
    spark: SparkSession, path: str | None = None, fmt: str = "parquet", ddl: str = PROFILE_STORE_DDL, **options: str
) -> DataFrame:
    """The profile store, projected to ``user_id, top_categories``.

    ``fmt`` is any Spark data source (``parquet`` default; a document-store
    connector works where its package is on the classpath, with its options).
    """
    reader = spark.read.format(fmt).schema(ddl).options(**options)
    return reader.load(path) if path else reader.load()


# ---------------------------------------------------------------- writers
def write_parquet(df: DataFrame, path: str, n_partitions: int | None = None) -> str:
    """K1 / K4 / K7: overwrite Parquet, optionally round-robin to ``n_partitions``."""
    round_robin(df, n_partitions).write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, n_partitions: int | None = None) -> str:
    """K3 / K6: overwrite CSV (header by default)."""
    round_robin(df, n_partitions).write.mode("overwrite").options(
        header=str(header).lower(), **CSV_OPTIONS
    ).csv(path)
    return path


def write_clean_csv(df: DataFrame, path: str, n_partitions: int | None = None) -> str:
    """K2 variant: cleaned logs as headerless CSV."""
    return write_csv(df, path, header=False, n_partitions=n_partitions)


def write_json(df: DataFrame, path: str, n_partitions: int | None = None) -> str:
    """K5: JSON lines."""
    round_robin(df, n_partitions).write.mode("overwrite").json(path)
    return path
