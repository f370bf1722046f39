import datetime as dt

from shopsignal.fixtures import RAW_WITH_ID

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def log_row(event_id, session="S1", user="User_1", product="ITEM_1", event="view", ts=T0, price=10.0,
            umeta='{"device":"mobile"}', pmeta='{"category":"Home","brand":"B1"}'):
    return (session, user, product, event, ts, price, umeta, pmeta, event_id)


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_WITH_ID)
