
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import empty_string_array, first_category
from ..plans.joins import key_bucket
from ..schemas import PAIRS_PER_CATEGORY


def product_category_map(clean: DataFrame) -> DataFrame:
    """A10 / P10: distinct ``(item_1, item_category)``; a product may have several categories."""
    return clean.select(F.col("product_id").alias("item_1"), F.col("category").alias("item_category")).distinct()


def pairs_with_category(pairs: DataFrame, category_map: DataFrame) -> DataFrame:
    """Attach ``item_1``'s categories to each pair (fan-out for multi-category products).

    The map is catalogue-sized and comes out of a ``distinct`` on
    ``(item_1, item_category)``, so the join shuffles it again on ``item_1``:
    AQE broadcasts it from that measured size, or keeps the sort-merge join
    and splits a hot ``item_1`` of the pairs.
    """
    return pairs.join(category_map, "item_1")


def category_top_pairs(with_category: DataFrame, n: int = PAIRS_PER_CATEGORY) -> DataFrame:
    """W1 + P8: the ``n`` most frequent pairs per category, ``rn`` from 1.

    Ties by ``item_1, item_2`` make it deterministic.  ``row_number <= n`` plans
    as a partial WindowGroupLimit before the shuffle, so a hot category sends
    only ``n`` rows per task.  The window also keys on ``key_bucket`` (same
    groups), so its partitioning carries on to ``category_recommendations``.
    """
    w = Window.partitionBy("item_category", key_bucket("item_category")).orderBy(
        F.col("frequency").desc(), "item_1", "item_2"
    )
    return with_category.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def category_recommendations(top: DataFrame) -> DataFrame:
    """``(item_category, recommended_pairs)``, the pairs flattened in rank order.

    Grouped with ``key_bucket`` (as the window before it), so the profile join
    (J2) shuffles this side on its own: AQE broadcasts it from its measured
    size, or splits a category that is many users' first one.
    """
    grouped = top.groupBy("item_category", key_bucket("item_category")).agg(
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rn", "item_1", "item_2"))),
                lambda x: F.array(x.getField("item_1"), x.getField("item_2")),
            )
        ).alias("recommended_pairs")
    )
    return grouped.select("item_category", "recommended_pairs")


def recommendations_from_pairs(pairs: DataFrame, clean: DataFrame, n: int = PAIRS_PER_CATEGORY) -> DataFrame:
    """Pairs + logs -> one recommendation row per category."""
    with_cat = pairs_with_category(pairs, product_category_map(clean))
    return category_recommendations(category_top_pairs(with_cat, n))


def user_profiles(ranked: DataFrame, recommendations: DataFrame | None = None) -> DataFrame:
    """``(user_id, top_categories, recommended_pairs)``.

    Recommendations attach by the user's first category (left join).  With no
    recommendation table every user gets an empty list.

    Lazy.  The recommendation side has one row per category.  Where it is a
    written table (the phase runner writes it), the caller passes it through
    ``plans.joins.checked_broadcast``, and within the measured bounds the
    profiles, the largest table here, are joined where they are and never
    shuffled onto a handful of categories.  A side that is still to be computed reaches the join
    through its own shuffle: AQE broadcasts it from its measured size, or
    splits a category that is many users' first one.
    """
    if recommendations is None:
        return ranked.select("user_id", "top_categories", empty_string_array().alias("recommended_pairs"))
    with_primary = ranked.withColumn("primary_category", first_category("top_categories"))
    recs = recommendations.select("item_category", "recommended_pairs")
    return with_primary.join(recs, with_primary["primary_category"] == recs["item_category"], "left").select(
        "user_id",
        "top_categories",
        F.coalesce(F.col("recommended_pairs"), empty_string_array()).alias("recommended_pairs"),
    )
