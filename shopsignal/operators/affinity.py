
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import ranked_to_maps
from ..functions.scoring import event_weight
from ..plans.joins import key_bucket


def event_scores(clean: DataFrame, weights: Mapping[str, int] | None = None) -> DataFrame:
    """F1: append ``score`` (view 1, cart 3, purchase 5, anything else null)."""
    return clean.withColumn("score", event_weight("event_type", weights))


def affinity_scores(clean: DataFrame, weights: Mapping[str, int] | None = None) -> DataFrame:
    """``(user_id, category, total_score)``; null when no event of the pair has a weight.

    Map-side partial sums before the shuffle on ``(user_id, category)``, so a
    hot user costs one partial row per task.
    """
    return (
        event_scores(clean.select("user_id", "category", "event_type"), weights)
        .groupBy("user_id", "category")
        .agg(F.sum("score").alias("total_score"))
    )


def ranked_categories(affinity: DataFrame) -> DataFrame:
    """``(user_id, top_categories array<struct<category, score>>)``.

    All of a user's categories, ordered by score descending, ties by category
    descending, null scores last.  A group is one user's distinct categories.
    Categories are free text, so nothing but the user's own events bounds them;
    jobs that only ask whether a user met a category (the default campaign) do
    not build the list.  Grouped with ``key_bucket`` so a join on ``user_id`` (the campaign) can split a user
    with many carts or broadcast the profiles from their measured size.
    """
    grouped = affinity.groupBy("user_id", key_bucket("user_id")).agg(
        F.sort_array(F.collect_list(F.struct("total_score", "category")), asc=False).alias("_sorted")
    )
    return grouped.select(
        "user_id",
        F.transform(
            "_sorted",
            lambda x: F.struct(x.getField("category").alias("category"), x.getField("total_score").alias("score")),
        ).alias("top_categories"),
    )


def top_categories(affinity: DataFrame, k: int) -> DataFrame:
    """F8 as rows: each user's first ``k`` categories, ``(user_id, category)``, ranked as ``ranked_categories`` ranks them.

    ``row_number <= k`` plans as a group limit in front of the shuffle, so a
    user sends ``k`` rows a task however many categories they met, and no list
    is gathered.  ``key_bucket`` as in ``ranked_categories``.
    """
    best = Window.partitionBy("user_id", key_bucket("user_id")).orderBy(
        F.col("total_score").desc_nulls_last(), F.col("category").desc_nulls_last())
    ranked = affinity.withColumn("_rank", F.row_number().over(best))
    return ranked.filter(F.col("_rank") <= k).select("user_id", "category")


def ranked_category_maps(affinity: DataFrame) -> DataFrame:
    """F7 variant: ``top_categories`` as ``array<map<category, score>>``."""
    return ranked_categories(affinity).select("user_id", ranked_to_maps("top_categories").alias("top_categories"))
