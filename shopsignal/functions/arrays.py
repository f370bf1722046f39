"""Array / struct / map expressions (F5-F12) and flat text renderings of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_string_array() -> Column:
    """``array<string>`` with no elements (a bare ``array()`` is ``array<void>``)."""
    return F.array().cast("array<string>")


def first_category(top_categories: Column | str = "top_categories") -> Column:
    """category of the first ranked element; null for an empty or null array (ANSI-safe)."""
    return F.get(_c(top_categories), 0).getField("category")


def category_list(top_categories: Column | str = "top_categories", top_k: int | None = None) -> Column:
    """F8: the categories of a ranked list, optionally only the first ``top_k``."""
    cats = F.transform(_c(top_categories), lambda x: x.getField("category"))
    return F.slice(cats, 1, top_k) if top_k else cats


def ranked_to_maps(top_categories: Column | str = "top_categories") -> Column:
    """F7 variant: ``array<struct<category,score>>`` -> ``array<map<category,score>>``."""
    return F.transform(_c(top_categories), lambda x: F.create_map(x.getField("category"), x.getField("score")))


def _score_text(score: Column) -> Column:
    return F.coalesce(score.cast("string"), F.lit("null"))


def format_ranked(top_categories: Column | str = "top_categories") -> Column:
    """``category:score|...`` in list order; a null score prints as ``null``."""
    return F.array_join(
        F.transform(
            _c(top_categories),
            lambda x: F.concat(x.getField("category"), F.lit(":"), _score_text(x.getField("score"))),
        ),
        "|",
    )


def format_ranked_maps(top_maps: Column | str = "top_categories") -> Column:
    """``category=score|...`` for the map variant (each map has one entry)."""
    return F.array_join(
        F.transform(
            _c(top_maps),
            lambda m: F.concat(
                F.get(F.map_keys(m), 0), F.lit("="), _score_text(F.get(F.map_values(m), 0))
            ),
        ),
        "|",
    )


def format_pairs(pairs: Column | str = "recommended_pairs") -> Column:
    """Flat item list joined by a bar; empty list -> empty string."""
    return F.array_join(_c(pairs), "|")
