from helpers import log_row, raw_df

from shopsignal.operators import affinity, clean


def _clean(spark, specs):
    return clean.clean_logs(raw_df(spark, [
        log_row(i, user=u, event=e, pmeta='{"category":"%s"}' % c) for i, (u, e, c) in enumerate(specs)
    ]))


def test_scores_and_null_for_unweighted(spark):
    c = _clean(spark, [("U", "view", "A"), ("U", "cart", "A"), ("U", "purchase", "B"), ("U", "signup", "C")])
    got = {(r.user_id, r.category): r.total_score for r in affinity.affinity_scores(c).collect()}
    assert got == {("U", "A"): 4, ("U", "B"): 5, ("U", "C"): None}


def test_custom_weights(spark):
    c = _clean(spark, [("U", "view", "A"), ("U", "signup", "A")])
    got = affinity.affinity_scores(c, weights={"view": 2, "signup": 10}).first()
    assert got.total_score == 12


def test_ranking_ties_by_category_desc_nulls_last(spark):
    c = _clean(spark, [
        ("U", "cart", "Apple"), ("U", "cart", "Berry"), ("U", "purchase", "Cherry"),
        ("U", "error", "Date"), ("U", "view", "Elder"),
    ])
    r = affinity.ranked_categories(affinity.affinity_scores(c)).first()
    assert [(x.category, x.score) for x in r.top_categories] == [
        ("Cherry", 5), ("Berry", 3), ("Apple", 3), ("Elder", 1), ("Date", None)]


def test_map_variant(spark):
    c = _clean(spark, [("U", "cart", "A"), ("U", "view", "B")])
    r = affinity.ranked_category_maps(affinity.affinity_scores(c)).first()
    assert r.top_categories == [{"A": 3}, {"B": 1}]
