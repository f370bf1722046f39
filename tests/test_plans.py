"""Physical-plan properties of the headline jobs, read from ``explain("formatted")``.

Each assertion is a property we want at scale: filters and column pruning at
the Parquet scan, partial aggregation before every shuffle, one exchange
feeding both sides of the basket self-join, top-k operators instead of full
sorts, and no Python evaluation anywhere.
"""

import re

import pytest
from conftest import SF_SMALL

from shopsignal import fixtures
from shopsignal.operators import abandonment, affinity, basket, campaign, clean, quality, recommend
from shopsignal.plans.joins import checked_broadcast
from shopsignal.session import scratch_path
from shopsignal.sources import files

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.fixture(scope="module")
def logs(spark):
    path = files.write_parquet(clean.clean_logs(fixtures.raw_logs(spark, SF_SMALL)), scratch_path(spark, "plans"))
    return files.read_clean_parquet(spark, path)


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def read_schemas(plan: str) -> list[set[str]]:
    """Column names of every scan's ReadSchema."""
    out = []
    for m in re.finditer(r"ReadSchema: struct<(.*)>", plan):
        out.append({f.split(":")[0] for f in re.split(r",(?![^<]*>)", m.group(1))})
    return out


def node_ids(plan: str, name: str, text: str = "") -> list[int]:
    """Ids of detail blocks ``(id) name`` whose block contains ``text`` (ids grow from the scans up)."""
    blocks = re.split(r"\n(?=\(\d+\) )", plan)
    out = []
    for b in blocks:
        m = re.match(r"\((\d+)\) (\w+)", b)
        if m and m.group(2) == name and text in b:
            out.append(int(m.group(1)))
    return out


def n_scans(plan: str) -> int:
    return len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M))


def no_python(plan: str) -> bool:
    return not any(n in plan for n in PYTHON_NODES)


def test_campaign_pushes_filters_and_prunes_columns(logs):
    plan = formatted(campaign.campaign(logs))
    assert "EqualTo(event_type,cart)" in plan and "EqualTo(event_type,purchase)" in plan
    schemas = read_schemas(plan)
    # the purchase side of the anti join and the met categories read what they join on and nothing else
    assert {"session_id", "event_type"} in schemas
    assert {"user_id", "category"} in schemas
    assert no_python(plan)


def test_basket_scan_is_pruned_and_counts_combine_map_side(logs):
    df = basket.market_basket_pairs(logs)
    df.collect()  # AQE reuses exchanges when it creates query stages: read the final plan
    plan = formatted(df)
    assert "isFinalPlan=true" in plan and "EqualTo(event_type,purchase)" in plan
    assert {"session_id", "product_id", "event_type"} in read_schemas(plan)
    assert "SortMergeJoin" not in plan.split("Initial Plan")[0]  # no big basket: AQE dropped its joins
    assert "partial_count" in plan  # pair counts combine map-side
    assert no_python(plan)


def test_affinity_sums_partially_before_the_shuffle(logs):
    plan = formatted(affinity.affinity_scores(logs))
    assert read_schemas(plan) == [{"user_id", "event_type", "category"}]
    partial, final = node_ids(plan, "HashAggregate", "partial_sum"), node_ids(plan, "HashAggregate", "sum(score")
    (shuffle,) = node_ids(plan, "Exchange")
    assert partial and max(partial) < shuffle < min(set(final) - set(partial))  # partial sums, shuffle, merge
    assert no_python(plan)


def test_top_k_operators(logs):
    pairs = basket.market_basket_pairs(logs)
    assert "TakeOrderedAndProject" in formatted(basket.top_pairs(pairs, 10))
    with_cat = recommend.pairs_with_category(pairs, recommend.product_category_map(logs))
    plan = formatted(recommend.category_top_pairs(with_cat))
    assert "WindowGroupLimit" in plan and "Partial" in plan  # top-2 cut before the window's shuffle


def test_one_pass_counts_scan_once(logs):
    plan = formatted(quality.event_counts(logs))
    assert n_scans(plan) == 1 and read_schemas(plan) == [{"event_type"}]
    plan = formatted(abandonment.abandoned_items(logs))
    assert n_scans(plan) == 2 and no_python(plan)


def test_profiles_are_not_shuffled_on_the_first_category(spark, logs):
    """Beside a written and measured recommendation table; one still to be computed starts no job."""
    ranked = affinity.ranked_categories(affinity.affinity_scores(logs))
    sc = spark.sparkContext
    sc.setJobGroup("profiles", "building only")
    try:
        recs = recommend.recommendations_from_pairs(basket.market_basket_pairs(logs), logs)
        lazy = recommend.user_profiles(ranked, recs)
        assert not sc.statusTracker().getJobIdsForGroup("profiles")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    table = spark.read.parquet(files.write_parquet(recs, scratch_path(spark, "recommendations")))
    small = recommend.user_profiles(ranked, checked_broadcast(table))
    n = len(small.collect())
    assert not re.search(r"hashpartitioning\((primary_category|top_categories)", formatted(small))
    beyond = recommend.user_profiles(ranked, checked_broadcast(table, max_rows=1))
    assert n and sorted(map(str, lazy.collect())) == sorted(map(str, small.collect())) == sorted(map(str, beyond.collect()))


def test_campaign_top_k_cuts_each_user_before_the_shuffle(logs):
    df = campaign.campaign(logs, top_k=2)
    plan = formatted(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan and "collect_list" not in plan
    lists = campaign.campaign(logs, profiles=affinity.ranked_categories(affinity.affinity_scores(logs)), top_k=2)
    assert df.columns == lists.columns
    assert sorted(map(str, df.collect())) == sorted(map(str, lists.collect()))


def test_campaign_without_top_k_equals_the_array_form(logs):
    profiles = affinity.ranked_categories(affinity.affinity_scores(logs))
    lazy, arrays = campaign.campaign(logs), campaign.campaign(logs, profiles=profiles)
    assert lazy.columns == arrays.columns
    assert sorted(map(str, lazy.collect())) == sorted(map(str, arrays.collect()))
