"""Test-input mapping: ``events`` + ``part`` -> raw click logs (FIXTURES.md 3).

The reference ships no data, so the raw logs are derived deterministically
from the driver's tables.  Everything is a Spark plan over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .plans.joins import checked_broadcast
from .plans.layout import spread
from .schemas import CLEAN, RAW

# The test logs carry a stable row identity that real logs do not have.
EVENT_ID = T.StructField("event_id", T.LongType())
RAW_WITH_ID = T.StructType([*RAW.fields, EVENT_ID])
CLEAN_WITH_ID = T.StructType([*RAW_WITH_ID.fields, *CLEAN.fields[len(RAW.fields):]])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_logs_from(events: DataFrame, part: DataFrame) -> DataFrame:
    """The FIXTURES.md mapping as a DataFrame plan (schema ``RAW_WITH_ID``)."""
    b = spread(events).select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr("datediff(cast(ts as date), date'2024-01-01') div 7").alias("wk"),
    )
    # part is a dimension table: broadcast it only when its size is proven small.
    dims = checked_broadcast(part.select("p_partkey", "p_type", "p_brand"))
    c = b.join(dims, b["k"] == dims["p_partkey"]).select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        "k",
        "wk",
        F.expr(
            "case when k % 10 = 9 then null when event_id % 13 = 0 then 'PROMO' else p_type end"
        ).alias("cat"),
        F.expr("case when k % 7 = 6 then null else p_brand end").alias("br"),
        F.expr(
            "case user_id % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end"
        ).alias("dev"),
    )
    out = c.select(
        F.expr(
            "case when event_id % 23 = 0 then null "
            "else 'S' || cast(user_id as string) || '_' || cast(wk as string) end"
        ).alias("session_id"),
        F.expr("'User_' || cast(user_id as string)").alias("user_id"),
        F.expr("'ITEM_' || cast(k as string)").alias("product_id"),
        F.expr("case event_type when 'click' then 'cart' else event_type end").alias("event_type"),
        F.col("ts").alias("timestamp"),
        F.expr("case when event_id % 17 = 0 then -value else value end").alias("price"),
        F.expr(
            "case when event_id % 19 = 0 then null else '{\"device\":\"' || dev || '\"}' end"
        ).alias("user_metadata"),
        F.expr(
            "case when event_id % 29 = 0 then '{bad' "
            "else '{\"category\":' || coalesce('\"' || cat || '\"', 'null') "
            "|| ',\"brand\":' || coalesce('\"' || br || '\"', 'null') || '}' end"
        ).alias("product_metadata"),
        F.col("event_id"),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in RAW_WITH_ID.fields])


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_logs_from(table(spark, sf_dir, "events"), table(spark, sf_dir, "part"))


def lineitem_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second basket input: one basket per order, items are part keys."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("basket_id"), F.col("l_partkey").alias("item")
    )


# ---- DuckDB oracle text (FIXTURES.md 3.2), used by __spark_entry__.oracle_sql ----
DUCKDB_RAW = """
raw as (
  with b as (
    select *, cast(json_extract_string(props, '$.k') as int) k,
           date_diff('day', date '2024-01-01', cast(ts as date)) // 7 wk
    from events),
  c as (
    select b.*, case when k % 10 = 9 then null when event_id % 13 = 0 then 'PROMO' else p_type end cat,
           case when k % 7 = 6 then null else p_brand end br,
           case user_id % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end dev
    from b join part on p_partkey = k)
  select case when event_id % 23 = 0 then null else 'S' || cast(user_id as varchar) || '_' || cast(wk as varchar) end session_id,
         'User_' || cast(user_id as varchar) user_id,
         'ITEM_' || cast(k as varchar) product_id,
         case event_type when 'click' then 'cart' else event_type end event_type,
         ts "timestamp",
         case when event_id % 17 = 0 then -value else value end price,
         case when event_id % 19 = 0 then null else '{"device":"' || dev || '"}' end user_metadata,
         case when event_id % 29 = 0 then '{bad'
              else '{"category":' || coalesce('"' || cat || '"', 'null') || ',"brand":' || coalesce('"' || br || '"', 'null') || '}'
         end product_metadata,
         event_id,
         case when event_id % 29 = 0 then null else cat end category,
         case when event_id % 29 = 0 then null else br end brand,
         case when event_id % 19 = 0 then null else dev end device
  from c)"""

DUCKDB_CLEAN = """
clean as (
  select * from raw
  where session_id is not null and user_id is not null and product_id is not null and event_type is not null
    and "timestamp" is not null and category is not null and user_metadata is not null and price > 0)"""
