
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CART, PURCHASE, VIEW


def table_shape(df: DataFrame) -> DataFrame:
    """A1: ``n_rows`` x ``n_columns``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def null_counts(df: DataFrame) -> DataFrame:
    """A2: one row, one bigint column per input column = its null count (single scan)."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in df.columns])


def distinct_values(df: DataFrame, column: str = "event_type") -> DataFrame:
    """A4: the distinct values of a column (partial aggregation before the shuffle)."""
    return df.select(column).distinct()


def event_counts(clean: DataFrame) -> DataFrame:
    """A5: per-type counts, their total and whether they reconcile with all rows, in one pass."""
    et = F.col("event_type")
    counts = clean.agg(
        F.count_if(et == VIEW).alias("views"),
        F.count_if(et == CART).alias("carts"),
        F.count_if(et == PURCHASE).alias("purchases"),
        F.count(F.lit(1)).alias("all_rows"),
    )
    return counts.select(
        "views",
        "carts",
        "purchases",
        (F.col("views") + F.col("carts") + F.col("purchases")).alias("total"),
        "all_rows",
        ((F.col("views") + F.col("carts") + F.col("purchases")) == F.col("all_rows")).alias("reconciles"),
    )


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    """A one-row count, returned as a DataFrame (write it wherever needed)."""
    return df.agg(F.count(F.lit(1)).alias(name))
