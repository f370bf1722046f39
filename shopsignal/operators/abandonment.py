
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import key_bucket
from ..schemas import CART, PURCHASE

ITEM_KEYS = ["user_id", "session_id", "product_id"]

def purchase_sessions(clean: DataFrame) -> DataFrame:
    """Distinct sessions with at least one purchase."""
    return clean.filter(F.col("event_type") == PURCHASE).select("session_id").distinct()


def _existing_keys(purchases: DataFrame, keys: list[str]) -> DataFrame:
    """The purchase side of an anti join: each key once, in a shape that lets AQE split a hot key of the cart side.

    Keys are made distinct together with ``key_bucket`` (see there), so the
    join shuffles this side by itself and nothing but the keys is read.
    """
    return purchases.select(*keys, key_bucket(*keys)).distinct().select(*keys)


def abandoned_items(clean: DataFrame) -> DataFrame:
    """Cart rows whose (user, session, product) was never purchased; keys first."""
    carts = clean.filter(F.col("event_type") == CART)
    bought = _existing_keys(clean.filter(F.col("event_type") == PURCHASE), ITEM_KEYS)
    return carts.join(bought, on=ITEM_KEYS, how="left_anti")


def abandoned_sessions(clean: DataFrame) -> DataFrame:
    """Cart rows of sessions without any purchase; ``session_id`` first."""
    carts = clean.filter(F.col("event_type") == CART)
    sessions = _existing_keys(clean.filter(F.col("event_type") == PURCHASE), ["session_id"])
    return carts.join(sessions, on="session_id", how="left_anti")
