from conftest import rows
from helpers import log_row, raw_df

from shopsignal.operators import clean


def test_json_extraction_and_nulls(spark):
    df = raw_df(spark, [
        log_row(1),
        log_row(2, pmeta=None),
        log_row(3, pmeta="{bad"),
        log_row(4, pmeta='{"category":null,"brand":"B"}'),
        log_row(5, pmeta='{"category":"Toys"}'),
        log_row(6, umeta='{"x":1}'),
        log_row(7, pmeta='{"category":{"a":1},"brand":"B"}'),
        log_row(8, pmeta='{"category":7,"brand":"B"}'),
    ])
    out = clean.clean_logs(df)
    got = {r.event_id: (r.category, r.brand, r.device) for r in out.collect()}
    # 2 (null metadata), 3 (malformed), 4 (null category) are dropped
    assert set(got) == {1, 5, 6, 7, 8}
    assert got[1] == ("Home", "B1", "mobile")
    assert got[5] == ("Toys", None, "mobile")      # brand may be null
    assert got[6] == ("Home", "B1", None)          # device may be null, user_metadata is not
    assert got[7][0] == '{"a":1}'                  # nested value kept as JSON text
    assert got[8][0] == "7"


def test_critical_nulls_and_price(spark):
    df = raw_df(spark, [
        log_row(1),
        log_row(2, session=None),
        log_row(3, user=None),
        log_row(4, product=None),
        log_row(5, event=None),
        log_row(6, ts=None),
        log_row(7, umeta=None),
        log_row(8, price=0.0),
        log_row(9, price=-3.0),
        log_row(10, price=None),
    ])
    assert rows(clean.clean_logs(df), "event_id") == [(1,)]
    d = clean.dropped_rows(df).first()
    assert (d.raw_rows, d.clean_rows, d.dropped_rows) == (10, 1, 9)


def test_text_timestamp_and_price_become_null(spark):
    df = spark.createDataFrame(
        [("S1", "U", "I", "view", "2024-01-01 10:00:00", "5.5", '{"device":"m"}', '{"category":"C"}', 1),
         ("S1", "U", "I", "view", "not a time", "5.5", '{"device":"m"}', '{"category":"C"}', 2),
         ("S1", "U", "I", "view", "2024-01-01 10:00:00", "cheap", '{"device":"m"}', '{"category":"C"}', 3)],
        "session_id string, user_id string, product_id string, event_type string, timestamp string, "
        "price string, user_metadata string, product_metadata string, event_id long",
    )
    out = clean.clean_logs(df)
    assert rows(out, "event_id") == [(1,)]
    assert dict(out.dtypes)["timestamp"] == "timestamp_ntz"
    assert dict(out.dtypes)["price"] == "double"


def test_split_events_partitions_rows(spark):
    df = raw_df(spark, [log_row(i, event=e) for i, e in enumerate(["view", "cart", "purchase", "signup", "view"])])
    c = clean.clean_logs(df)
    v, ca, p = clean.split_events(c)
    assert (v.count(), ca.count(), p.count()) == (2, 1, 1)


def test_null_filter_reaches_parquet_scan(spark, tmp_path):
    df = raw_df(spark, [log_row(1)])
    path = str(tmp_path / "raw")
    df.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = clean.clean_logs(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(session_id)" in plan and "GreaterThan(price,0.0)" in plan


def test_timestamp_texts_of_ordinary_logs(spark):
    texts = ["2024-01-01 10:00:00", "2024-01-01T10:00:00", "2024-01-01T10:00:00Z", "2024-01-01 10:00:00.123",
             "2024-01-01T10:00:00.123456", "01/01/2024 10:00:00", "2024/01/01 10:00:00", "2024-01-01 10:00:00 UTC"]
    df = spark.createDataFrame([(t, "1.5") for t in [*texts, "soon", None]], "timestamp string, price string")
    got = [r.timestamp for r in clean.coerce_types(df).collect()]
    assert [str(t)[:19] for t in got[:-2]] == ["2024-01-01 10:00:00"] * len(texts) and got[-2:] == [None, None]
    bad = clean.unparsed(df)
    assert df.filter(bad["timestamp"]).count() == 1 and df.filter(bad["price"]).count() == 0


def test_zoned_timestamps_are_instants(spark):
    """Texts with a zone name one instant, told in the session zone; a text without one is a local time."""
    ten_utc = ["2024-01-01T10:00:00Z", "2024-01-01 15:00:00+05:00", "2024-01-01T05:00:00.000-0500", "2024-01-01 10:00:00 UTC",
               "2024-01-01 05:00:00 America/New_York", "2024-01-01 11:00:00.0 Europe/Berlin", "2024-01-01T10:00:00+00"]
    local = ["2024-01-01 10:00:00", "2024-01-01T10:00:00.000", "01/01/2024 10:00:00", "2024-03-10 02:30:00", "2024-01-05"]
    df = spark.createDataFrame([(t, "1") for t in ten_utc + local + ["2024-01-01 10:00:00 Mars/Base"]], "timestamp string, price string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone, hour in (("UTC", 10), ("America/Los_Angeles", 2), ("Asia/Karachi", 15)):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [str(r.timestamp) for r in clean.coerce_types(df).collect()]
            assert got[:len(ten_utc)] == [f"2024-01-01 {hour:02d}:00:00"] * len(ten_utc)
            assert got[len(ten_utc):] == ["2024-01-01 10:00:00"] * 3 + ["2024-03-10 02:30:00", "2024-01-05 00:00:00", "None"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
