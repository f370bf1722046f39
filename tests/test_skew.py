"""A third of all rows on one key: results stay exact and the plan splits the hot key."""

from conftest import rows
from helpers import log_row, raw_df

from shopsignal.operators import abandonment, affinity, basket, campaign, clean

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _skewed_logs(spark, n=3000):
    specs = []
    for i in range(n):
        if i % 3 == 0:  # a third of all rows: one session of one user
            specs.append(("HOT", "User_hot", f"ITEM_{i % 40}", "cart" if i % 2 else "view"))
        else:
            s = i % 200
            specs.append((f"S{s}", f"User_{s % 50}", f"ITEM_{i % 17}", ["view", "cart", "purchase"][i % 3]))
    return clean.clean_logs(raw_df(spark, [
        log_row(i, session=s, user=u, product=p, event=e, pmeta='{"category":"C%d"}' % (0 if s == "HOT" else i % 5))
        for i, (s, u, p, e) in enumerate(specs)
    ])).repartition(16)


def _brute_abandoned_sessions(logs):
    bought = {r.session_id for r in logs if r.event_type == "purchase"}
    return sorted((r.event_id,) for r in logs if r.event_type == "cart" and r.session_id not in bought)


def test_hot_session_anti_join_is_split_and_exact(spark):
    logs = _skewed_logs(spark)
    local = logs.collect()

    def run():
        df = abandonment.abandoned_sessions(logs).select("event_id")
        got = sorted(tuple(r) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
        return got, plan

    got, plan = _with_conf(spark, SKEW_CONF, run)
    assert got == _brute_abandoned_sessions(local)
    assert "skew=true" in plan  # AQE split the hot session's partition


def test_hot_user_campaign_and_affinity_exact(spark):
    logs = _skewed_logs(spark)
    local = logs.collect()
    want = {}
    for r in local:
        w = {"view": 1, "cart": 3, "purchase": 5}.get(r.event_type)
        key = (r.user_id, r.category)
        if key not in want:
            want[key] = None
        if w is not None:
            want[key] = (want[key] or 0) + w
    got = _with_conf(spark, SKEW_CONF, lambda: {
        (r.user_id, r.category): r.total_score for r in affinity.affinity_scores(logs).collect()})
    assert got == want

    def run_campaign():
        df = campaign.campaign(logs, top_k=2).select("event_id", "discount_offer")
        n = len(df.collect())  # run df's own plan, so the final adaptive plan is shown
        return n, df._jdf.queryExecution().executedPlan().toString()

    n, plan = _with_conf(spark, SKEW_CONF, run_campaign)
    assert campaign.campaign(logs).count() == n
    assert n == len(_brute_abandoned_sessions(local))
    # the hot user's carts (of one category) are split against the first categories of every user
    assert any("skew=true" in line and "[user_id" in line for line in plan.splitlines()), plan


def test_hot_basket_pairs_exact_with_blocks(spark):
    items = [("HOT", f"I{i}") for i in range(120)] * 2 + [(f"S{i}", f"I{i % 7}") for i in range(200)]
    df = spark.createDataFrame(items, "session_id string, product_id string").repartition(8)
    got = _with_conf(spark, SKEW_CONF, lambda: rows(basket.pair_frequencies(df, block_size=16)))
    from test_basket import brute_pairs

    assert got == brute_pairs(items)


def test_hot_primary_category_profile_join_is_split_and_exact(spark):
    from shopsignal.operators import recommend

    # a third of all users rank C0 first; recommendations exist for every category
    n_users = 3000
    aff = spark.createDataFrame(
        [(f"User_{u}", "C0" if u % 3 == 0 else f"C{1 + u % 40}", 10) for u in range(n_users)]
        + [(f"User_{u}", "C99", 1) for u in range(0, n_users, 5)],
        "user_id string, category string, total_score bigint",
    ).repartition(16)
    recs = spark.createDataFrame(
        [(f"C{c}", f"ITEM_{c}", f"ITEM_{c + 100}", 5, 1) for c in range(41)],
        "item_category string, item_1 string, item_2 string, frequency bigint, rn int",
    )

    def run():
        df = recommend.user_profiles(affinity.ranked_categories(aff), recommend.category_recommendations(recs))
        got = {r.user_id: (r.top_categories[0].category, list(r.recommended_pairs)) for r in df.collect()}
        return got, df._jdf.queryExecution().executedPlan().toString()

    # AQE would coalesce this tiny upstream stage into one map output, and a
    # partition with a single map output cannot be split (at scale there are many)
    conf = dict(SKEW_CONF, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    got, plan = _with_conf(spark, conf, run)
    assert len(got) == n_users
    for u in range(n_users):
        first = "C0" if u % 3 == 0 else f"C{1 + u % 40}"
        c = int(first[1:])
        assert got[f"User_{u}"] == (first, [f"ITEM_{c}", f"ITEM_{c + 100}"])
    assert any("skew=true" in line and "primary_category" in line for line in plan.splitlines()), plan


def test_hot_cart_key_item_level_anti_join_is_split_and_exact(spark):
    # a third of all rows: carts of one (user, session, product) key
    specs = []
    for i in range(3000):
        if i % 3 == 0:
            specs.append(("HOT", "User_hot", "ITEM_hot", "cart"))
        else:
            s = i % 200
            specs.append((f"S{s}", f"User_{s % 50}", f"ITEM_{i % 17}", ["view", "cart", "purchase"][i % 3]))
    logs = clean.clean_logs(raw_df(spark, [
        log_row(i, session=s, user=u, product=p, event=e, pmeta='{"category":"C%d"}' % (i % 5))
        for i, (s, u, p, e) in enumerate(specs)
    ])).repartition(16)
    local = logs.collect()
    bought = {(r.user_id, r.session_id, r.product_id) for r in local if r.event_type == "purchase"}
    want = sorted((r.event_id,) for r in local
                  if r.event_type == "cart" and (r.user_id, r.session_id, r.product_id) not in bought)

    def run():
        df = abandonment.abandoned_items(logs).select("event_id")
        return sorted(tuple(r) for r in df.collect()), df._jdf.queryExecution().executedPlan().toString()

    got, plan = _with_conf(spark, SKEW_CONF, run)
    assert got == want
    assert "skew=true" in plan


def test_hot_item_pairs_category_join_is_split_and_exact(spark):
    from shopsignal.operators import recommend

    # one item is item_1 of a third of all pairs
    pairs = spark.createDataFrame(
        [("A_HOT", f"Z{i:04d}", 1) for i in range(1500)] + [(f"B{i % 300:03d}", f"Z{i:04d}", 2) for i in range(3000)],
        "item_1 string, item_2 string, frequency bigint",
    ).repartition(16)
    cmap = spark.createDataFrame(
        [("A_HOT", "C1"), ("A_HOT", "C2")] + [(f"B{i:03d}", f"C{i % 5}") for i in range(300)],
        "item_1 string, item_category string",
    ).repartition(4)

    def run():
        df = recommend.pairs_with_category(pairs, cmap).select("item_1", "item_2", "item_category")
        got = sorted(tuple(r) for r in df.collect())
        return got, df._jdf.queryExecution().executedPlan().toString()

    conf = dict(SKEW_CONF, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    got, plan = _with_conf(spark, conf, run)
    cats = {}
    for item, cat in [("A_HOT", "C1"), ("A_HOT", "C2")] + [(f"B{i:03d}", f"C{i % 5}") for i in range(300)]:
        cats.setdefault(item, []).append(cat)
    want = sorted((a, z, c) for a, z in [("A_HOT", f"Z{i:04d}") for i in range(1500)]
                  + [(f"B{i % 300:03d}", f"Z{i:04d}") for i in range(3000)] for c in cats[a])
    assert got == want  # multi-category fan-out kept
    assert any("skew=true" in line and "[item_1" in line for line in plan.splitlines()), plan


def _shuffled_rows(df):
    """Rows written by each shuffle of the plan that ran."""
    df.collect()
    out = []

    def walk(plan):
        if plan.nodeName().startswith("Exchange"):
            out.append(plan.metrics().apply("shuffleRecordsWritten").value())
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            children = [plan.executedPlan()]
        elif "QueryStage" in plan.nodeName():
            children = [plan.plan()]
        for c in children:
            walk(c)

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_repeats_in_a_hot_basket_are_never_shuffled(spark):
    """One item bought again and again in a hot session, alone and beside a big basket."""
    repeats = [("HOT", "SAME")] * 9000 + [("HOT", f"I{i}") for i in range(30)] + [(f"S{i}", f"I{i % 7}") for i in range(300)] * 3
    df = spark.createDataFrame(repeats, "session_id string, product_id string").repartition(8).persist()
    from test_basket import brute_pairs

    distinct = len(set(repeats))
    for block_size in (20_000, 16):  # no big basket; a big one
        pairs = basket.basket_pairs(df, block_size=block_size)
        assert max(_shuffled_rows(pairs)) <= 8 * distinct  # each of eight map tasks sends an item once at most
        assert rows(basket.pair_frequencies(df, block_size=block_size)) == brute_pairs(repeats)
    sets = basket.session_baskets(df)
    assert max(_shuffled_rows(sets)) <= 8 * distinct
    assert {r.session_id: r["items"] for r in sets.collect()}["HOT"] == sorted({i for b, i in repeats if b == "HOT"})
    df.unpersist()


def test_session_set_is_gathered_from_distinct_items_only(spark):
    """A session with a third of all rows: the task that builds its set reads each distinct item once."""
    items = [("HOT", f"I{i % 50}") for i in range(6000)] + [(f"S{i % 400}", f"I{i % 31}") for i in range(12000)]
    df = spark.createDataFrame(items, "session_id string, product_id string").repartition(8)
    written = _shuffled_rows(basket.session_baskets(df))
    assert written[0] <= len(set(items)) < sum(written)  # the last shuffle, which gathers, and that of the distinct rows
