from conftest import rows
from helpers import log_row, raw_df

from shopsignal.operators import affinity, basket, clean, recommend


def _logs(spark, specs):
    return clean.clean_logs(raw_df(spark, [
        log_row(i, session=s, user=u, product=p, event=e, pmeta='{"category":"%s"}' % c)
        for i, (s, u, p, e, c) in enumerate(specs)
    ]))


def test_two_category_product_fans_out(spark):
    c = _logs(spark, [
        ("S1", "U1", "X", "purchase", "Home"), ("S1", "U1", "Y", "purchase", "Home"),
        ("S2", "U2", "X", "view", "Promo"),
    ])
    pairs = basket.market_basket_pairs(c)
    wc = recommend.pairs_with_category(pairs, recommend.product_category_map(c))
    assert rows(wc, "item_1", "item_2", "frequency", "item_category") == [
        ("X", "Y", 1, "Home"), ("X", "Y", 1, "Promo")]


def test_top2_per_category_ties_and_order(spark):
    pairs = spark.createDataFrame(
        [("A", "B", 5), ("A", "C", 5), ("A", "D", 9), ("A", "E", 1), ("K", "L", 2)],
        "item_1 string, item_2 string, frequency long")
    cmap = spark.createDataFrame([("A", "Cat1"), ("K", "Cat2")], "item_1 string, item_category string")
    top = recommend.category_top_pairs(recommend.pairs_with_category(pairs, cmap))
    assert rows(top, "item_category", "item_1", "item_2", "rn") == [
        ("Cat1", "A", "B", 2), ("Cat1", "A", "D", 1), ("Cat2", "K", "L", 1)]
    recs = {r.item_category: r.recommended_pairs for r in recommend.category_recommendations(top).collect()}
    assert recs == {"Cat1": ["A", "D", "A", "B"], "Cat2": ["K", "L"]}


def test_profiles_attach_by_primary_category_and_default_empty(spark):
    c = _logs(spark, [
        ("S1", "U1", "X", "purchase", "Home"), ("S1", "U1", "Y", "purchase", "Home"),
        ("S2", "U2", "Z", "purchase", "Toys"),
    ])
    ranked = affinity.ranked_categories(affinity.affinity_scores(c))
    recs = recommend.recommendations_from_pairs(basket.market_basket_pairs(c), c)
    prof = {r.user_id: r.recommended_pairs for r in recommend.user_profiles(ranked, recs).collect()}
    assert prof == {"U1": ["X", "Y"], "U2": []}
    none = recommend.user_profiles(ranked, None)
    assert dict(none.dtypes)["recommended_pairs"] == "array<string>"
    assert all(r.recommended_pairs == [] for r in none.collect())
