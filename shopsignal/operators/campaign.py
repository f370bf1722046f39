
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import category_list
from ..functions.scoring import offer_label
from ..plans.joins import key_bucket
from ..schemas import HIGH_DISCOUNT, MARKETING_ACTION, STANDARD_REMINDER
from .abandonment import abandoned_sessions
from .affinity import affinity_scores, top_categories


def category_lists(profiles: DataFrame, top_k: int | None = None) -> DataFrame:
    """F8: ``(user_id, top_categories_list)``, optionally only the first ``top_k``."""
    return profiles.select("user_id", category_list("top_categories", top_k).alias("top_categories_list"))


def campaign(
    current: DataFrame,
    history: DataFrame | None = None,
    profiles: DataFrame | None = None,
    top_k: int | None = None,
) -> DataFrame:
    """Abandoned carts (session level) of ``current`` logs with an offer each.

    Profiles come from ``profiles`` (e.g. the profile store) or are ranked from
    ``history`` logs (default: ``current``).  ``top_k`` keeps only the first
    ``top_k`` categories of each profile.  Output: cart columns with
    ``user_id`` first, then ``marketing_action`` and ``discount_offer``.

    Without ``profiles`` the offer only asks whether the cart's category is one
    the user met (or one of their first ``top_k``), so no list is built: those
    (user, category) pairs of the logs are joined instead.

    The profile side reaches the join through its own shuffle (a stored table
    is a plain scan; pairs are grouped with ``key_bucket``), so AQE
    either broadcasts it from its measured size or splits a user with many
    abandoned carts over several tasks.
    """
    carts = abandoned_sessions(current)
    if profiles is None:
        past = history if history is not None else current
        keys = ["user_id", "category"]
        met = top_categories(affinity_scores(past), top_k) if top_k else past.select(*keys, key_bucket(*keys)).distinct()
        joined = carts.join(met.select(*keys, F.lit(True).alias("_met")), on=keys, how="left")
        label = F.when(F.col("_met"), F.lit(HIGH_DISCOUNT)).otherwise(F.lit(STANDARD_REMINDER))
        first = ["user_id", "session_id"]
        rest = [c for c in carts.columns if c not in first]
        return joined.select(*first, *rest, F.lit(MARKETING_ACTION).alias("marketing_action"), label.alias("discount_offer"))
    joined = carts.join(category_lists(profiles, top_k), on="user_id", how="left")
    return (
        joined.withColumn("marketing_action", F.lit(MARKETING_ACTION))
        .withColumn("discount_offer", offer_label("top_categories_list", "category"))
        .drop("top_categories_list")
    )


def offer_counts(campaign_df: DataFrame) -> DataFrame:
    """Rows per ``discount_offer``."""
    return campaign_df.groupBy("discount_offer").agg(F.count(F.lit(1)).alias("n"))
