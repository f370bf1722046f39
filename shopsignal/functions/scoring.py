"""F1 / F2: conditional expressions of the affinity model and the campaign rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EVENT_WEIGHTS, HIGH_DISCOUNT, STANDARD_REMINDER


def event_weight(event_type: Column | str = "event_type", weights: Mapping[str, int] | None = None) -> Column:
    """Interest weight per event type; types without a weight give null (no ``otherwise``)."""
    col = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = None
    for name, w in (weights or EVENT_WEIGHTS).items():
        expr = (F.when(col == name, F.lit(w)) if expr is None else expr.when(col == name, F.lit(w)))
    return expr if expr is not None else F.lit(None).cast("int")


def offer_label(categories: Column | str, category: Column | str) -> Column:
    """High discount when the cart item's category is in the user's list, else a reminder.

    A null list (no profile) falls to the reminder, as in the reference.
    """
    cats = F.col(categories) if isinstance(categories, str) else categories
    cat = F.col(category) if isinstance(category, str) else category
    return F.when(F.array_contains(cats, cat), F.lit(HIGH_DISCOUNT)).otherwise(F.lit(STANDARD_REMINDER))
