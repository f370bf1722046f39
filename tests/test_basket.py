import itertools
import random
from collections import Counter

import pytest
from conftest import rows
from helpers import log_row, raw_df

from shopsignal.operators import basket, clean


def brute_pairs(items):
    """Reference semantics: distinct items per basket, all sorted 2-combinations, counted."""
    by_basket = {}
    for b, i in items:
        if b is not None and i is not None:
            by_basket.setdefault(b, set()).add(i)
    cnt = Counter()
    for s in by_basket.values():
        cnt.update(itertools.combinations(sorted(s), 2))
    return sorted((a, b, n) for (a, b), n in cnt.items())


def random_items(seed, n_baskets=30, n_items=40, hot=300):
    rnd = random.Random(seed)
    out = []
    for b in range(n_baskets):
        size = rnd.choice([1, 2, 3, 5, 8])
        out += [(f"S{b}", f"I{rnd.randrange(n_items)}") for _ in range(size)]
    # one hot basket holding most rows, with repeats
    out += [("HOT", f"I{rnd.randrange(n_items * 3)}") for _ in range(hot)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("block_size", [1024, 7, 3, 2, 1])
def test_pairs_match_brute_force_at_all_block_sizes(spark, block_size):
    items = random_items(block_size)
    df = spark.createDataFrame(items, "session_id string, product_id string").repartition(5)
    got = basket.pair_frequencies(df, block_size=block_size)
    assert rows(got) == brute_pairs(items)


def test_basket_pairs_each_pair_once_per_basket(spark):
    items = random_items(11)
    df = spark.createDataFrame(items, "session_id string, product_id string")
    bp = basket.basket_pairs(df, block_size=4)
    r = rows(bp)
    assert len(r) == len(set(r))
    assert all(a < b for _, a, b in r)
    sets = {}
    for b, i in items:
        sets.setdefault(b, set()).add(i)
    assert len(r) == sum(len(s) * (len(s) - 1) // 2 for s in sets.values())


def test_numeric_items_and_generic_columns(spark):
    items = [(1, 10), (1, 2), (1, 10), (2, 2), (2, 10), (2, 3), (3, 99)]
    df = spark.createDataFrame(items, "basket_id long, item long")
    got = basket.pair_frequencies(df, basket="basket_id", item="item", block_size=2)
    assert rows(got) == brute_pairs(items)


def test_single_item_and_repeat_purchase(spark):
    df = raw_df(spark, [
        log_row(1, session="A", product="X", event="purchase"),
        log_row(2, session="A", product="X", event="purchase"),
        log_row(3, session="B", product="X", event="purchase"),
        log_row(4, session="B", product="Y", event="purchase"),
        log_row(5, session="B", product="Z", event="cart"),
    ])
    pairs = basket.market_basket_pairs(clean.clean_logs(df))
    assert rows(pairs) == [("X", "Y", 1)]


def test_min_support_and_top(spark):
    items = [("a", "X"), ("a", "Y"), ("b", "X"), ("b", "Y"), ("c", "X"), ("c", "Z")]
    df = spark.createDataFrame(items, "session_id string, product_id string")
    assert rows(basket.pair_frequencies(df, min_support=2)) == [("X", "Y", 2)]
    top = basket.top_pairs(basket.pair_frequencies(df), 2).collect()
    assert [tuple(r) for r in top] == [("X", "Y", 2), ("X", "Z", 1)]


def test_session_baskets_have_one_shape_at_every_size(spark):
    items = [("a", "Y"), ("a", "X"), ("a", "Y"), ("b", "Z"), (None, "Q"), ("c", None)]
    items += [("HOT", f"I{i % 3000:04d}") for i in range(6000)]
    df = spark.createDataFrame(items, "session_id string, product_id string")
    got = {r.session_id: r["items"] for r in basket.session_baskets(df).collect()}
    assert got == {"a": ["X", "Y"], "b": ["Z"], "HOT": [f"I{i:04d}" for i in range(3000)]}
    assert rows(basket.session_items(df)) == sorted((b, i) for b, i in set(items) if b and i)


def test_repeat_heavy_basket_is_one_block(spark):
    items = [("BOT", f"I{i % 3}") for i in range(5000)] + [("s", "I0"), ("s", "I9")]
    df = spark.createDataFrame(items, "session_id string, product_id string")
    assert rows(basket.pair_frequencies(df, block_size=100)) == brute_pairs(items)


def test_building_the_pairs_starts_no_job(spark):
    df = spark.createDataFrame(random_items(3), "session_id string, product_id string")
    sc = spark.sparkContext
    sc.setJobGroup("pairs", "building only")
    try:
        basket.pair_frequencies(df, min_support=2, block_size=4)
        assert not sc.statusTracker().getJobIdsForGroup("pairs")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_big_basket_makes_no_more_candidates_than_pairs(spark):
    """Rows out of every Generate over the last step are the pairs themselves."""
    n = 1500
    df = spark.createDataFrame([("HOT", i) for i in range(n)], "session_id string, product_id long")
    pairs = basket.basket_pairs(df, block_size=200)
    assert pairs.count() == n * (n - 1) // 2 and pairs.distinct().count() == n * (n - 1) // 2
    assert pairs.filter("item_1 >= item_2").count() == 0


def test_min_support_equals_filtering_all_pairs(spark):
    df = spark.createDataFrame(random_items(21), "session_id string, product_id string")
    for support in (2, 3):
        want = [r for r in rows(basket.pair_frequencies(df, block_size=5)) if r[2] >= support]
        assert rows(basket.pair_frequencies(df, min_support=support, block_size=5)) == want


def test_invariants_on_fixture(spark):
    from conftest import SF_SMALL

    from shopsignal import fixtures

    c = clean.clean_logs(fixtures.raw_logs(spark, SF_SMALL))
    items = [tuple(r) for r in basket.purchase_items(c).collect()]
    pairs = rows(basket.market_basket_pairs(c))
    assert pairs == brute_pairs(items)
    assert len(pairs) == 163  # FIXTURES.md 4
    per_item = Counter()
    for s in {b for b, _ in items}:
        for i in {i for b2, i in items if b2 == s}:
            per_item[i] += 1
    assert all(n <= min(per_item[a], per_item[b]) for a, b, n in pairs)
