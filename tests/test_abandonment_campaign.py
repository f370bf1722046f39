import datetime as dt

from conftest import SF_MID, SF_SMALL, rows
from helpers import log_row, raw_df
from pyspark.sql import functions as F

from shopsignal import fixtures
from shopsignal.operators import abandonment, affinity, campaign, clean


def _logs(spark, specs):
    return clean.clean_logs(raw_df(spark, [
        log_row(i, session=s, user=u, product=p, event=e, pmeta='{"category":"%s"}' % c)
        for i, (s, u, p, e, c) in enumerate(specs)
    ]))


def test_item_and_session_level(spark):
    c = _logs(spark, [
        ("S1", "U1", "X", "cart", "A"), ("S1", "U1", "X", "purchase", "A"),
        ("S1", "U1", "Y", "cart", "A"),
        ("S2", "U2", "Z", "cart", "B"),
    ])
    assert rows(abandonment.abandoned_items(c), "event_id") == [(2,), (3,)]
    assert rows(abandonment.abandoned_sessions(c), "event_id") == [(3,)]
    assert abandonment.abandoned_items(c).columns[:3] == ["user_id", "session_id", "product_id"]
    assert abandonment.abandoned_sessions(c).columns[0] == "session_id"


def test_campaign_offer_missing_profile_and_top_k(spark):
    cur = _logs(spark, [("S9", "U1", "X", "cart", "A"), ("S8", "U2", "Y", "cart", "C")])
    hist = _logs(spark, [
        ("H1", "U1", "P", "purchase", "B"), ("H1", "U1", "Q", "view", "A"),
    ])
    out = {r.user_id: r.discount_offer for r in campaign.campaign(cur, history=hist).collect()}
    assert out == {"U1": "High_Discount", "U2": "Standard_Reminder"}
    top1 = {r.user_id: r.discount_offer for r in campaign.campaign(cur, history=hist, top_k=1).collect()}
    assert top1 == {"U1": "Standard_Reminder", "U2": "Standard_Reminder"}
    cols = campaign.campaign(cur).columns
    assert cols[0] == "user_id" and cols[-2:] == ["marketing_action", "discount_offer"]


def test_campaign_from_profile_store_frame(spark):
    cur = _logs(spark, [("S9", "U1", "X", "cart", "A")])
    profiles = spark.createDataFrame(
        [("U1", [("A", None)])], "user_id string, top_categories array<struct<category:string,score:bigint>>")
    r = campaign.campaign(cur, profiles=profiles).first()
    assert r.discount_offer == "High_Discount"  # null score still matches


def test_fixture_counts_match_fixtures_md(spark):
    for sf, expect in [(SF_SMALL, dict(items=154, sessions=15, hi=15, top2=(7, 8), hist=(9, 0))),
                       (SF_MID, dict(items=1473, sessions=225, hi=225, top2=(122, 103), hist=(128, 2)))]:
        c = clean.clean_logs(fixtures.raw_logs(spark, sf))
        assert abandonment.abandoned_items(c).count() == expect["items"]
        assert abandonment.abandoned_sessions(c).count() == expect["sessions"]

        def counts(df):
            d = {r.discount_offer: r.n for r in campaign.offer_counts(df).collect()}
            return d.get("High_Discount", 0), d.get("Standard_Reminder", 0)

        assert counts(campaign.campaign(c)) == (expect["hi"], 0)
        assert counts(campaign.campaign(c, top_k=2)) == expect["top2"]
        split = F.lit(dt.datetime(2024, 1, 15))
        hist = counts(campaign.campaign(c.filter(F.col("timestamp") >= split),
                                        history=c.filter(F.col("timestamp") < split)))
        assert hist == expect["hist"]


def test_null_scores_in_fixture(spark):
    c = clean.clean_logs(fixtures.raw_logs(spark, SF_MID))
    assert affinity.affinity_scores(c).filter("total_score is null").count() == 9
