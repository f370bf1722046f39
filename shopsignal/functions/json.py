"""JSON field extraction from the metadata strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import JSON_FIELDS


def metadata_field(name: str) -> Column:
    """``get_json_object`` of one metadata field; null for missing or malformed JSON."""
    source, path = JSON_FIELDS[name]
    return F.get_json_object(F.col(source), path)


def parse_metadata(df: DataFrame) -> DataFrame:
    """Append ``category``, ``brand`` (from product_metadata) and ``device`` (from user_metadata)."""
    return df.withColumns({name: metadata_field(name) for name in ("category", "brand", "device")})
