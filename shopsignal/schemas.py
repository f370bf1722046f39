"""Schemas and fixed business values shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns a log row must carry to survive cleaning (nulls in any drop the row).
CRITICAL_COLUMNS = (
    "session_id",
    "user_id",
    "product_id",
    "event_type",
    "timestamp",
    "category",
    "user_metadata",
)

# Raw click-log columns every input must have (by name, in any order; further columns are kept).
RAW = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_metadata", T.StringType()),
        T.StructField("product_metadata", T.StringType()),
    ]
)

# Cleaned logs: raw columns plus the three fields parsed out of the JSON metadata.
CLEAN = T.StructType(
    list(RAW.fields)
    + [
        T.StructField("category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("device", T.StringType()),
    ]
)

# Market-basket pair frequencies.
PAIRS = T.StructType(
    [
        T.StructField("item_1", T.StringType()),
        T.StructField("item_2", T.StringType()),
        T.StructField("frequency", T.LongType()),
    ]
)

AFFINITY = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("total_score", T.LongType()),
    ]
)

CATEGORY_SCORE = T.StructType(
    [T.StructField("category", T.StringType()), T.StructField("score", T.LongType())]
)

PROFILE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("top_categories", T.ArrayType(CATEGORY_SCORE)),
        T.StructField("recommended_pairs", T.ArrayType(T.StringType())),
    ]
)

# Projected schema the campaign reads from the profile store.
PROFILE_STORE_DDL = "user_id STRING, top_categories ARRAY<STRUCT<category: STRING, score: BIGINT>>"

# ---- fixed values that must equal the reference's for identical results ----
# Event types with a meaning.
VIEW, CART, PURCHASE = "view", "cart", "purchase"
# Interest weight per event type; any other type scores null.
EVENT_WEIGHTS = {"view": 1, "cart": 3, "purchase": 5}
# Text before the row count in its report.
ROW_COUNT_LABEL = "Total rows: "
# Campaign labels.
MARKETING_ACTION = "Send cart recovery email"
HIGH_DISCOUNT = "High_Discount"
STANDARD_REMINDER = "Standard_Reminder"
# JSON paths of the metadata fields.
JSON_FIELDS = {
    "category": ("product_metadata", "$.category"),
    "brand": ("product_metadata", "$.brand"),
    "device": ("user_metadata", "$.device"),
}
# Recommendation pairs kept per category.
PAIRS_PER_CATEGORY = 2
# -----------------------------------------------------------------------------
