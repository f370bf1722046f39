
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import parse_metadata
from ..schemas import CART, CRITICAL_COLUMNS, PURCHASE, VIEW


# Timestamp texts beside those a cast reads (ISO dates and times, with ``T`` or a space, a fraction, a zone).
TIMESTAMP_FORMATS = ("MM/dd/yyyy HH:mm:ss", "yyyy/MM/dd HH:mm:ss")
# A time of day with something behind it that names a zone: ``Z``, an offset, an abbreviation or a region.
ZONED = r":\d{1,2}(\.\d+)?\s*(\[?[A-Za-z]|[+-]\d)"


def _timestamp(text: Column) -> Column:
    """A text as a local time of the session zone (``spark.sql.session.timeZone``); null if no known form fits.

    A text with a zone is an instant, and becomes the local time of that
    instant; any other text is a local time already and is taken as it stands
    (so no time is moved by a clock change of the session zone).
    """
    instant = text.try_cast("timestamp").cast("timestamp_ntz")
    local = text.try_cast("timestamp_ntz")
    return F.coalesce(F.when(text.rlike(ZONED), instant).otherwise(local),
                      *[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in TIMESTAMP_FORMATS])


def unparsed(df: DataFrame) -> dict[str, Column]:
    """Per converted column whether a row's text is there but does not parse (typed columns: never)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    ts, price = F.col("timestamp"), F.col("price")
    bad_ts = isinstance(fields["timestamp"], T.StringType)
    bad_price = not isinstance(fields["price"], T.NumericType)
    return {
        "timestamp": ts.isNotNull() & _timestamp(ts).isNull() if bad_ts else F.lit(False),
        "price": price.isNotNull() & price.try_cast("double").isNull() if bad_price else F.lit(False),
    }


def coerce_types(df: DataFrame, others: dict[str, str] | None = None) -> DataFrame:
    """Give text ``timestamp`` / ``price`` columns (and ``others``: name -> type) their types; bad values become null.

    Conversions never fail (ANSI-safe): the null drops its row in the
    critical-column filter, and ``unparsed`` counts it for the quality report.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = df
    if isinstance(fields.get("timestamp"), T.StringType):
        out = out.withColumn("timestamp", _timestamp(F.col("timestamp")))
    if "price" in fields and not isinstance(fields["price"], T.NumericType):
        out = out.withColumn("price", F.col("price").try_cast("double"))
    return out.withColumns({c: F.col(c).try_cast(t) for c, t in (others or {}).items()})


def keep_condition(columns=CRITICAL_COLUMNS) -> Column:
    """All critical columns non-null and a positive price.

    Written as plain ``isNotNull`` conjuncts (not ``dropna``) so the null tests
    reach the Parquet scan as pushed filters.
    """
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return not_null & (F.col("price") > 0)


def clean_logs(raw: DataFrame) -> DataFrame:
    """Raw logs -> cleaned logs: raw columns + ``category``, ``brand``, ``device``."""
    return parse_metadata(coerce_types(raw)).filter(keep_condition())


def events_of_type(clean: DataFrame, event_type: str) -> DataFrame:
    """Rows of one event type."""
    return clean.filter(F.col("event_type") == event_type)


def split_events(clean: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(views, carts, purchases)."""
    return tuple(events_of_type(clean, t) for t in (VIEW, CART, PURCHASE))  # type: ignore[return-value]


def dropped_rows(raw: DataFrame) -> DataFrame:
    """A3 in one pass: ``raw_rows``, ``clean_rows``, ``dropped_rows``."""
    parsed = parse_metadata(coerce_types(raw))
    return parsed.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(keep_condition()).alias("clean_rows"),
    ).withColumn("dropped_rows", F.col("raw_rows") - F.col("clean_rows"))
