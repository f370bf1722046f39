"""

Every query reads the whole driver tables (``events`` + ``part`` through the
FIXTURES.md mapping, or ``lineitem``).  Outputs are flat: arrays are rendered
as bar-joined text so the oracle can produce identical values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures
from .fixtures import DUCKDB_CLEAN, DUCKDB_RAW
from .functions.arrays import category_list, first_category, format_pairs, format_ranked, format_ranked_maps
from .operators import abandonment, affinity, basket, campaign, clean, quality, recommend, store
from .fixtures import CLEAN_WITH_ID, RAW_WITH_ID
from .plans.layout import by_id, by_key, partition_sizes, round_robin
from .session import scratch_path
from .sources import files

Query = Callable[[SparkSession, str], DataFrame]

# Lookup arguments of the store queries (fixed demo values).
LOOKUP_USER = "User_1"
LOOKUP_CATEGORY = "ECONOMY"
LOOKUP_ITEM = "ITEM_25"
LOOKUP_ITEM_MISSING = "ITEM_1874"
HISTORY_SPLIT = "2024-01-15 00:00:00"
_SECONDS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# ------------------------------------------------------------------ shared
def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.raw_logs(spark, sf)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_logs(_raw(spark, sf))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return basket.market_basket_pairs(_clean(spark, sf))


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    return affinity.ranked_categories(affinity.affinity_scores(_clean(spark, sf)))


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    c = _clean(spark, sf)
    ranked = affinity.ranked_categories(affinity.affinity_scores(c))
    recs = recommend.recommendations_from_pairs(basket.market_basket_pairs(c), c)
    return recommend.user_profiles(ranked, recs)


def _flat_profiles(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id",
        format_ranked("top_categories").alias("top_categories"),
        format_pairs("recommended_pairs").alias("recommended_pairs"),
    )


def _history_campaign(spark: SparkSession, sf: str) -> DataFrame:
    c = _clean(spark, sf)
    split = F.lit(HISTORY_SPLIT).cast("timestamp_ntz")
    return campaign.campaign(c.filter(F.col("timestamp") >= split), history=c.filter(F.col("timestamp") < split))


# ------------------------------------------------------------------ queries
def q_scan_csv_logs(spark, sf):
    return _typed(files.read_raw_csv(spark, files.write_csv(_raw(spark, sf), scratch_path(spark, "raw_csv"))))


def _typed(logs: DataFrame) -> DataFrame:
    return clean.coerce_types(logs, {"event_id": "bigint"})


def _foreign_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The raw logs from a CSV as others write it: columns in another order, one more of them, a space in the time."""
    raw = _raw(spark, sf)
    text = raw.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).withColumn("note", F.lit("a, b"))
    path = files.write_csv(text.select(sorted(text.columns, reverse=True)), scratch_path(spark, "foreign_csv"))
    return files.read_raw_csv(spark, path)


def q_scan_csv_logs_by_name(spark, sf):
    return _typed(_foreign_csv(spark, sf)).select(RAW_WITH_ID.names)


def q_scan_csv_logs_zoned(spark, sf):
    """The raw logs from a CSV whose times are texts in four zones: none, UTC, an offset and a region."""
    raw, zone = _raw(spark, sf), F.current_timezone()

    def in_zone(name: str, behind: str):
        return F.concat(F.date_format(F.convert_timezone(zone, F.lit(name), F.col("timestamp")), _SECONDS), F.lit(behind))

    kind = F.col("event_id") % 4
    text = (F.when(kind == 0, F.date_format("timestamp", _SECONDS)).when(kind == 1, in_zone("UTC", "Z"))
            .when(kind == 2, in_zone("Asia/Karachi", "+05:00")).otherwise(in_zone("America/New_York", " America/New_York")))
    path = files.write_csv(raw.withColumn("timestamp", text), scratch_path(spark, "zoned_csv"))
    return _typed(files.read_raw_csv(spark, path))


def q_clean_csv_logs(spark, sf):
    return clean.clean_logs(_typed(_foreign_csv(spark, sf))).select(CLEAN_WITH_ID.names)


def q_scan_parquet_logs(spark, sf):
    path = files.write_parquet(_clean(spark, sf), scratch_path(spark, "clean_parquet"))
    return files.read_clean_parquet(spark, path)


def q_cleaned_csv_roundtrip(spark, sf):
    path = files.write_clean_csv(_clean(spark, sf), scratch_path(spark, "clean_csv"))
    return files.read_clean_csv(spark, path, CLEAN_WITH_ID)


def q_scan_pairs_csv(spark, sf):
    path = files.write_csv(_pairs(spark, sf), scratch_path(spark, "pairs_csv"))
    return files.read_pairs_csv(spark, path)


def q_scan_profiles_json(spark, sf):
    path = files.write_json(_profiles(spark, sf), scratch_path(spark, "profiles_json"))
    return _flat_profiles(files.read_profiles_json(spark, path))


def q_scan_profile_store(spark, sf):
    paths = store.publish_profiles(_profiles(spark, sf), scratch_path(spark, "store"))
    df = files.read_profile_store(spark, paths["profiles"])
    return df.select("user_id", format_ranked("top_categories").alias("top_categories"))


def q_affinity_roundtrip(spark, sf):
    aff = affinity.affinity_scores(_clean(spark, sf))
    path = files.write_parquet(aff, scratch_path(spark, "affinity"), n_partitions=8)
    return files.read_affinity_parquet(spark, path)


def q_abandoned_csv_roundtrip(spark, sf):
    path = files.write_csv(abandonment.abandoned_items(_clean(spark, sf)), scratch_path(spark, "abandoned_csv"))
    return _typed(files.read_abandoned_csv(spark, path))


def q_campaign_roundtrip(spark, sf):
    path = files.write_parquet(campaign.campaign(_clean(spark, sf)), scratch_path(spark, "campaign"), n_partitions=8)
    return files.read_campaign_parquet(spark, path)


def q_metadata_preview(spark, sf):
    return _raw(spark, sf).select("event_id", "user_metadata", "product_metadata").orderBy("event_id").limit(5)


def q_json_extract(spark, sf):
    from .functions.json import metadata_field

    return _raw(spark, sf).select(
        "event_id", *[metadata_field(n).alias(n) for n in ("category", "brand", "device")]
    )


def q_clean_logs(spark, sf):
    return _clean(spark, sf)


def _events(kind: str) -> Query:
    return lambda spark, sf: clean.events_of_type(_clean(spark, sf), kind)


def q_raw_shape(spark, sf):
    return quality.table_shape(_raw(spark, sf))


def q_null_counts(spark, sf):
    return quality.null_counts(_raw(spark, sf))


def q_dropped_rows(spark, sf):
    return clean.dropped_rows(_raw(spark, sf))


def q_distinct_event_types(spark, sf):
    return quality.distinct_values(_clean(spark, sf), "event_type")


def q_event_counts(spark, sf):
    return quality.event_counts(_clean(spark, sf))


def q_row_count(spark, sf):
    return quality.row_count(_clean(spark, sf), "total_rows")


def q_abandoned_count(spark, sf):
    return quality.row_count(abandonment.abandoned_items(_clean(spark, sf)), "abandoned")


def q_partition_sizes(spark, sf):
    """Rows of each of 8 partitions, three of them empty."""
    return partition_sizes(by_id(_clean(spark, sf), F.col("event_id") % 5, 8), 8)


def q_partition_sizes_beyond(spark, sf):
    """Five partitions where two are asked for: all rows are reported."""
    return partition_sizes(by_id(_clean(spark, sf), F.col("event_id") % 5, 5), 2)


def q_layout_round_robin(spark, sf):
    return round_robin(_clean(spark, sf), 8)


def q_layout_by_session(spark, sf):
    parts = by_key(_clean(spark, sf), "session_id", 8).withColumn("p", F.spark_partition_id())
    return parts.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p").alias("partitions"))


def q_reuse_written_logs(spark, sf):
    """One written table serves two jobs, event counts and purchase sessions: ``(figure, n)``."""
    path = files.write_parquet(_clean(spark, sf), scratch_path(spark, "reused"))
    logs = files.read_clean_parquet(spark, path)
    sessions = quality.row_count(abandonment.purchase_sessions(logs), "purchase_sessions")
    counts = quality.event_counts(logs).unpivot([], ["views", "carts", "purchases"], "figure", "n")
    return counts.unionByName(sessions.unpivot([], ["purchase_sessions"], "figure", "n"))


def q_session_baskets(spark, sf):
    b = basket.session_baskets(basket.purchase_items(_clean(spark, sf)))
    return b.select("session_id", F.array_join("items", "|").alias("items"))


def q_session_items(spark, sf):
    return basket.session_items(basket.purchase_items(_clean(spark, sf)))


def q_basket_pairs_small_blocks(spark, sf):
    return basket.basket_pairs(basket.purchase_items(_clean(spark, sf)), block_size=3)


def q_basket_pairs(spark, sf):
    return basket.basket_pairs(basket.purchase_items(_clean(spark, sf)))


def q_market_basket_pairs(spark, sf):
    return _pairs(spark, sf)


def q_top10_pairs(spark, sf):
    return basket.top_pairs(_pairs(spark, sf), 10)


def q_lineitem_basket_pairs(spark, sf):
    return basket.pair_frequencies(fixtures.lineitem_baskets(spark, sf), basket="basket_id", item="item")


def q_event_scores(spark, sf):
    return affinity.event_scores(_clean(spark, sf)).select("event_id", "score")


def q_affinity_scores(spark, sf):
    return affinity.affinity_scores(_clean(spark, sf))


def q_ranked_categories(spark, sf):
    return _ranked(spark, sf).select("user_id", format_ranked("top_categories").alias("top_categories"))


def q_ranked_category_maps(spark, sf):
    maps = affinity.ranked_category_maps(affinity.affinity_scores(_clean(spark, sf)))
    return maps.select("user_id", format_ranked_maps("top_categories").alias("top_categories"))


def q_primary_category(spark, sf):
    return _ranked(spark, sf).select("user_id", first_category("top_categories").alias("primary_category"))


def q_category_lists(spark, sf):
    return _ranked(spark, sf).select(
        "user_id", F.array_join(category_list("top_categories"), "|").alias("top_categories_list")
    )


def q_product_category_map(spark, sf):
    return recommend.product_category_map(_clean(spark, sf))


def _pairs_with_category(spark, sf):
    c = _clean(spark, sf)
    return recommend.pairs_with_category(basket.market_basket_pairs(c), recommend.product_category_map(c))


def q_pairs_with_category(spark, sf):
    return _pairs_with_category(spark, sf).select("item_1", "item_2", "frequency", "item_category")


def q_category_top_pairs(spark, sf):
    return recommend.category_top_pairs(_pairs_with_category(spark, sf)).select(
        "item_category", "item_1", "item_2", "frequency", "rn"
    )


def q_category_recommendations(spark, sf):
    c = _clean(spark, sf)
    recs = recommend.recommendations_from_pairs(basket.market_basket_pairs(c), c)
    return recs.select("item_category", format_pairs("recommended_pairs").alias("recommended_pairs"))


def q_user_profiles(spark, sf):
    return _flat_profiles(_profiles(spark, sf))


def q_profiles_no_recs(spark, sf):
    return _flat_profiles(recommend.user_profiles(_ranked(spark, sf), None))


def q_purchase_sessions(spark, sf):
    return abandonment.purchase_sessions(_clean(spark, sf))


def q_abandoned_items(spark, sf):
    return abandonment.abandoned_items(_clean(spark, sf))


def q_abandoned_sessions(spark, sf):
    return abandonment.abandoned_sessions(_clean(spark, sf))


def q_campaign(spark, sf):
    return campaign.campaign(_clean(spark, sf))


def q_campaign_top2(spark, sf):
    return campaign.campaign(_clean(spark, sf), top_k=2)


def q_campaign_history(spark, sf):
    return _history_campaign(spark, sf)


def q_offer_counts(spark, sf):
    return campaign.offer_counts(campaign.campaign(_clean(spark, sf)))


def q_offer_counts_history(spark, sf):
    return campaign.offer_counts(_history_campaign(spark, sf))


def q_profile_by_user(spark, sf):
    return _flat_profiles(store.profile_by_user(_profiles(spark, sf), LOOKUP_USER))


def q_users_by_category(spark, sf):
    return store.users_by_category(_profiles(spark, sf), LOOKUP_CATEGORY, 3)


def q_users_by_item(spark, sf):
    return store.users_by_item(_profiles(spark, sf), LOOKUP_ITEM, 5)


def q_users_by_item_empty(spark, sf):
    return store.users_by_item(_profiles(spark, sf), LOOKUP_ITEM_MISSING, 5)


def q_store_by_category(spark, sf):
    return store.category_index(_profiles(spark, sf)).withColumn("rank", F.col("rank").cast("int"))


def q_store_by_item(spark, sf):
    return store.item_index(_profiles(spark, sf))


def q_quality_report(spark, sf):
    from .plans.phases import quality_report

    return quality_report(_raw(spark, sf))


def q_users_by_category_indexed(spark, sf):
    paths = store.publish_profiles(_profiles(spark, sf), scratch_path(spark, "store_idx"))
    by_category, parts = (spark.read.parquet(paths[t]) for t in ("by_category", "by_category_parts"))
    return store.users_by_category_indexed(by_category, parts, LOOKUP_CATEGORY, 3)


def q_store_versions(spark, sf):
    """A store published twice, first without recommendations: the profiles each version has."""
    root = scratch_path(spark, "store_versions")
    store.publish_profiles(recommend.user_profiles(_ranked(spark, sf), None), root)
    store.publish_profiles(_profiles(spark, sf), root)
    read = [store.read_store(spark, root, version=v) for v in store.versions(spark, root)]
    figures = [F.count(F.lit(1)).alias("users"), F.sum(F.size("recommended_pairs")).alias("recommended")]
    return read[0].agg(F.lit(1).alias("version"), *figures).unionByName(read[-1].agg(F.lit(2).alias("version"), *figures))


def q_users_by_item_indexed(spark, sf):
    paths = store.publish_profiles(_profiles(spark, sf), scratch_path(spark, "store_item_idx"))
    return store.users_by_item_indexed(spark.read.parquet(paths["by_item"]), LOOKUP_ITEM, 5)


def q_profile_by_user_indexed(spark, sf):
    root = scratch_path(spark, "store_user_idx")
    store.publish_profiles(_profiles(spark, sf), root)
    return _flat_profiles(store.profile_by_user(store.read_store(spark, root), LOOKUP_USER))


QUERIES: dict[str, Query] = {
    "scan_csv_logs": q_scan_csv_logs,
    "scan_csv_logs_by_name": q_scan_csv_logs_by_name,
    "scan_csv_logs_zoned": q_scan_csv_logs_zoned,
    "clean_csv_logs": q_clean_csv_logs,
    "scan_parquet_logs": q_scan_parquet_logs,
    "cleaned_csv_roundtrip": q_cleaned_csv_roundtrip,
    "scan_pairs_csv": q_scan_pairs_csv,
    "scan_profiles_json": q_scan_profiles_json,
    "scan_profile_store": q_scan_profile_store,
    "affinity_roundtrip": q_affinity_roundtrip,
    "abandoned_csv_roundtrip": q_abandoned_csv_roundtrip,
    "campaign_roundtrip": q_campaign_roundtrip,
    "metadata_preview": q_metadata_preview,
    "json_extract": q_json_extract,
    "clean_logs": q_clean_logs,
    "events_view": _events("view"),
    "events_cart": _events("cart"),
    "events_purchase": _events("purchase"),
    "raw_shape": q_raw_shape,
    "null_counts": q_null_counts,
    "dropped_rows": q_dropped_rows,
    "distinct_event_types": q_distinct_event_types,
    "event_counts": q_event_counts,
    "row_count": q_row_count,
    "abandoned_count": q_abandoned_count,
    "partition_sizes": q_partition_sizes,
    "partition_sizes_beyond": q_partition_sizes_beyond,
    "layout_round_robin": q_layout_round_robin,
    "layout_by_session": q_layout_by_session,
    "reuse_written_logs": q_reuse_written_logs,
    "session_items": q_session_items,
    "basket_pairs_small_blocks": q_basket_pairs_small_blocks,
    "session_baskets": q_session_baskets,
    "basket_pairs": q_basket_pairs,
    "market_basket_pairs": q_market_basket_pairs,
    "top10_pairs": q_top10_pairs,
    "lineitem_basket_pairs": q_lineitem_basket_pairs,
    "event_scores": q_event_scores,
    "affinity_scores": q_affinity_scores,
    "ranked_categories": q_ranked_categories,
    "ranked_category_maps": q_ranked_category_maps,
    "primary_category": q_primary_category,
    "category_lists": q_category_lists,
    "product_category_map": q_product_category_map,
    "pairs_with_category": q_pairs_with_category,
    "category_top_pairs": q_category_top_pairs,
    "category_recommendations": q_category_recommendations,
    "user_profiles": q_user_profiles,
    "profiles_no_recs": q_profiles_no_recs,
    "purchase_sessions": q_purchase_sessions,
    "abandoned_items": q_abandoned_items,
    "abandoned_sessions": q_abandoned_sessions,
    "campaign": q_campaign,
    "campaign_top2": q_campaign_top2,
    "campaign_history": q_campaign_history,
    "offer_counts": q_offer_counts,
    "offer_counts_history": q_offer_counts_history,
    "profile_by_user": q_profile_by_user,
    "users_by_category": q_users_by_category,
    "users_by_item": q_users_by_item,
    "users_by_item_empty": q_users_by_item_empty,
    "store_by_category": q_store_by_category,
    "store_by_item": q_store_by_item,
    "quality_report": q_quality_report,
    "users_by_category_indexed": q_users_by_category_indexed,
    "store_versions": q_store_versions,
    "users_by_item_indexed": q_users_by_item_indexed,
    "profile_by_user_indexed": q_profile_by_user_indexed,
}


# ------------------------------------------------------------------ oracle (DuckDB SQL)
def _with(*ctes: str) -> str:
    return "with " + ",\n".join([DUCKDB_RAW, DUCKDB_CLEAN, *ctes]) + "\n"


_PURCHASE_ITEMS = "pitems as (select distinct session_id, product_id from clean where event_type = 'purchase')"
_BASKET_PAIRS = (
    "bpairs as (select a.session_id, a.product_id item_1, b.product_id item_2 from pitems a "
    "join pitems b on a.session_id = b.session_id and a.product_id < b.product_id)"
)
_PAIRS = "pairs as (select item_1, item_2, count(*) frequency from bpairs group by item_1, item_2)"
_AFFINITY = (
    "affinity as (select user_id, category, cast(sum(case event_type when 'view' then 1 when 'cart' then 3 "
    "when 'purchase' then 5 end) as bigint) total_score from clean group by user_id, category)"
)
_RANKED = (
    "ranked as (select user_id, category, total_score, cast(row_number() over (partition by user_id "
    "order by total_score desc nulls last, category desc) as integer) pos from affinity)"
)
_RANKED_TEXT = (
    "ranked_text as (select user_id, string_agg(category || ':' || coalesce(cast(total_score as varchar), 'null'), "
    "'|' order by pos) top_categories from ranked group by user_id)"
)
_PCM = "pcm as (select distinct product_id item_1, category item_category from clean)"
_PWC = (
    "pwc as (select p.item_1, p.item_2, p.frequency, m.item_category from pairs p join pcm m on p.item_1 = m.item_1)"
)
_TOP = (
    "toppairs as (select * from (select item_category, item_1, item_2, frequency, cast(row_number() over "
    "(partition by item_category order by frequency desc, item_1, item_2) as integer) rn from pwc) where rn <= 2)"
)
_RECS = (
    "recs as (select item_category, string_agg(item_1 || '|' || item_2, '|' order by rn) recommended_pairs "
    "from toppairs group by item_category)"
)
_PROFILES = (
    "profiles as (select t.user_id, t.top_categories, coalesce(r.recommended_pairs, '') recommended_pairs "
    "from ranked_text t join ranked p on p.user_id = t.user_id and p.pos = 1 "
    "left join recs r on r.item_category = p.category)"
)
_PROFILE_CTES = (
    _PURCHASE_ITEMS, _BASKET_PAIRS, _PAIRS, _AFFINITY, _RANKED, _RANKED_TEXT, _PCM, _PWC, _TOP, _RECS, _PROFILES
)
_ABANDONED_ITEMS = (
    "ab_items as (select c.* from clean c where c.event_type = 'cart' and not exists (select 1 from clean p "
    "where p.event_type = 'purchase' and p.user_id = c.user_id and p.session_id = c.session_id "
    "and p.product_id = c.product_id))"
)


def _campaign_sql(current: str, history: str, top_k: int | None) -> str:
    keep = f"where pos <= {top_k}" if top_k else ""
    return _with(
        f"cur as (select * from clean where {current})",
        f"hist as (select * from clean where {history})",
        "aff as (select user_id, category, cast(sum(case event_type when 'view' then 1 when 'cart' then 3 "
        "when 'purchase' then 5 end) as bigint) total_score from hist group by user_id, category)",
        "rk as (select user_id, category, row_number() over (partition by user_id order by total_score desc "
        "nulls last, category desc) pos from aff)",
        f"lists as (select user_id, list(category) cats from rk {keep} group by user_id)",
        "ab as (select c.* from cur c where c.event_type = 'cart' and not exists (select 1 from cur p "
        "where p.event_type = 'purchase' and p.session_id = c.session_id))",
    ) + (
        "select ab.*, 'Send cart recovery email' marketing_action, case when list_contains(l.cats, ab.category) "
        "then 'High_Discount' else 'Standard_Reminder' end discount_offer from ab left join lists l "
        "on l.user_id = ab.user_id"
    )


def _dq(name: str) -> str:
    """Column name as DuckDB SQL (``timestamp`` is a keyword there)."""
    return f'"{name}"' if name == "timestamp" else name


_RAW_COLS = ", ".join(_dq(f.name) for f in RAW_WITH_ID.fields)
_CAMPAIGN = _campaign_sql("true", "true", None)
_ALL = "true"
_SPLIT = f"\"timestamp\" >= timestamp '{HISTORY_SPLIT}'"
_BEFORE = f"\"timestamp\" < timestamp '{HISTORY_SPLIT}'"

ORACLE: dict[str, str] = {
    "scan_csv_logs": _with() + f"select {_RAW_COLS} from raw",
    "scan_csv_logs_by_name": _with() + f"select {_RAW_COLS} from raw",
    "scan_csv_logs_zoned": _with() + f"select {_RAW_COLS} from raw",
    "clean_csv_logs": _with() + "select * from clean",
    "scan_parquet_logs": _with() + "select * from clean",
    "cleaned_csv_roundtrip": _with() + "select * from clean",
    "scan_pairs_csv": _with(_PURCHASE_ITEMS, _BASKET_PAIRS, _PAIRS) + "select * from pairs",
    "scan_profiles_json": _with(*_PROFILE_CTES) + "select * from profiles",
    "scan_profile_store": _with(_AFFINITY, _RANKED, _RANKED_TEXT) + "select * from ranked_text",
    "affinity_roundtrip": _with(_AFFINITY) + "select * from affinity",
    "abandoned_csv_roundtrip": _with(_ABANDONED_ITEMS) + "select * from ab_items",
    "campaign_roundtrip": _CAMPAIGN,
    "metadata_preview": _with() + "select event_id, user_metadata, product_metadata from raw order by event_id limit 5",
    "json_extract": _with() + "select event_id, category, brand, device from raw",
    "clean_logs": _with() + "select * from clean",
    "events_view": _with() + "select * from clean where event_type = 'view'",
    "events_cart": _with() + "select * from clean where event_type = 'cart'",
    "events_purchase": _with() + "select * from clean where event_type = 'purchase'",
    "raw_shape": _with() + f"select count(*) n_rows, {len(RAW_WITH_ID.fields)} n_columns from raw",
    "null_counts": _with()
    + "select "
    + ", ".join(f"count(*) - count({_dq(f.name)}) {_dq(f.name)}" for f in RAW_WITH_ID.fields)
    + " from raw",
    "dropped_rows": _with()
    + "select r.n raw_rows, c.n clean_rows, r.n - c.n dropped_rows from (select count(*) n from raw) r, "
    "(select count(*) n from clean) c",
    "distinct_event_types": _with() + "select distinct event_type from clean",
    "event_counts": _with()
    + "select views, carts, purchases, views + carts + purchases total, all_rows, "
    "views + carts + purchases = all_rows reconciles from (select count(*) filter (where event_type = 'view') views, "
    "count(*) filter (where event_type = 'cart') carts, count(*) filter (where event_type = 'purchase') purchases, "
    "count(*) all_rows from clean)",
    "row_count": _with() + "select count(*) total_rows from clean",
    "abandoned_count": _with(_ABANDONED_ITEMS) + "select count(*) abandoned from ab_items",
    "partition_sizes": _with() + "select p::integer \"partition\", count(event_id) \"rows\" "
    "from range(8) r(p) left join clean on event_id % 5 = p group by p",
    "partition_sizes_beyond": _with() + "select (event_id % 5)::integer \"partition\", count(*) \"rows\" from clean group by 1",
    "layout_round_robin": _with() + "select * from clean",
    "layout_by_session": _with() + "select session_id, count(*) n, 1 partitions from clean group by session_id",
    "reuse_written_logs": _with()
    + "select event_type || 's' figure, count(*) n from clean where event_type in ('view', 'cart', 'purchase') group by 1 "
    "union all select 'purchase_sessions', count(distinct session_id) from clean where event_type = 'purchase'",
    "session_items": _with(_PURCHASE_ITEMS) + "select * from pitems",
    "basket_pairs_small_blocks": _with(_PURCHASE_ITEMS, _BASKET_PAIRS) + "select * from bpairs",
    "session_baskets": _with(_PURCHASE_ITEMS)
    + "select session_id, string_agg(product_id, '|' order by product_id) items from pitems "
    "group by session_id",
    "basket_pairs": _with(_PURCHASE_ITEMS, _BASKET_PAIRS) + "select * from bpairs",
    "market_basket_pairs": _with(_PURCHASE_ITEMS, _BASKET_PAIRS, _PAIRS) + "select * from pairs",
    "top10_pairs": _with(_PURCHASE_ITEMS, _BASKET_PAIRS, _PAIRS)
    + "select * from pairs order by frequency desc, item_1, item_2 limit 10",
    "lineitem_basket_pairs": "with li as (select distinct l_orderkey, l_partkey from lineitem) "
    "select a.l_partkey item_1, b.l_partkey item_2, count(*) frequency from li a join li b "
    "on a.l_orderkey = b.l_orderkey and a.l_partkey < b.l_partkey group by 1, 2",
    "event_scores": _with()
    + "select event_id, case event_type when 'view' then 1 when 'cart' then 3 when 'purchase' then 5 end score "
    "from clean",
    "affinity_scores": _with(_AFFINITY) + "select * from affinity",
    "ranked_categories": _with(_AFFINITY, _RANKED, _RANKED_TEXT) + "select * from ranked_text",
    "ranked_category_maps": _with(_AFFINITY, _RANKED)
    + "select user_id, string_agg(category || '=' || coalesce(cast(total_score as varchar), 'null'), '|' "
    "order by pos) top_categories from ranked group by user_id",
    "primary_category": _with(_AFFINITY, _RANKED) + "select user_id, category primary_category from ranked where pos = 1",
    "category_lists": _with(_AFFINITY, _RANKED)
    + "select user_id, string_agg(category, '|' order by pos) top_categories_list from ranked group by user_id",
    "product_category_map": _with(_PCM) + "select * from pcm",
    "pairs_with_category": _with(_PURCHASE_ITEMS, _BASKET_PAIRS, _PAIRS, _PCM, _PWC) + "select * from pwc",
    "category_top_pairs": _with(_PURCHASE_ITEMS, _BASKET_PAIRS, _PAIRS, _PCM, _PWC, _TOP) + "select * from toppairs",
    "category_recommendations": _with(_PURCHASE_ITEMS, _BASKET_PAIRS, _PAIRS, _PCM, _PWC, _TOP, _RECS)
    + "select * from recs",
    "user_profiles": _with(*_PROFILE_CTES) + "select * from profiles",
    "profiles_no_recs": _with(_AFFINITY, _RANKED, _RANKED_TEXT)
    + "select user_id, top_categories, '' recommended_pairs from ranked_text",
    "purchase_sessions": _with() + "select distinct session_id from clean where event_type = 'purchase'",
    "abandoned_items": _with(_ABANDONED_ITEMS) + "select * from ab_items",
    "abandoned_sessions": _with()
    + "select c.* from clean c where c.event_type = 'cart' and not exists (select 1 from clean p "
    "where p.event_type = 'purchase' and p.session_id = c.session_id)",
    "campaign": _CAMPAIGN,
    "campaign_top2": _campaign_sql(_ALL, _ALL, 2),
    "campaign_history": _campaign_sql(_SPLIT, _BEFORE, None),
    "offer_counts": "with cmp as (" + _CAMPAIGN + ") select discount_offer, count(*) n from cmp group by discount_offer",
    "offer_counts_history": "with cmp as (" + _campaign_sql(_SPLIT, _BEFORE, None)
    + ") select discount_offer, count(*) n from cmp group by discount_offer",
    "profile_by_user": _with(*_PROFILE_CTES) + f"select * from profiles where user_id = '{LOOKUP_USER}'",
    "users_by_category": _with(_AFFINITY)
    + f"select user_id, total_score score from affinity where category = '{LOOKUP_CATEGORY}' "
    "order by score desc nulls last, user_id limit 3",
    "users_by_item": _with(*_PROFILE_CTES)
    + f"select user_id from profiles where list_contains(string_split(recommended_pairs, '|'), '{LOOKUP_ITEM}') "
    "order by user_id limit 5",
    "users_by_item_empty": _with(*_PROFILE_CTES)
    + f"select user_id from profiles where list_contains(string_split(recommended_pairs, '|'), "
    f"'{LOOKUP_ITEM_MISSING}') order by user_id limit 5",
    "store_by_category": _with(_AFFINITY, _RANKED)
    + "select category, pos rank, user_id, total_score score from ranked",
    "quality_report": _with()
    + "select r.*, c.clean_rows, r.n_rows - c.clean_rows dropped_rows, c.views, c.carts, c.purchases, "
    "c.n_event_types, c.views + c.carts + c.purchases = c.clean_rows reconciles from (select count(*) n_rows, "
    + f"{len(RAW_WITH_ID.fields)} n_columns, "
    + ", ".join(f"count(*) - count({_dq(f.name)}) null_{f.name}" for f in RAW_WITH_ID.fields)
    + ", 0 unparsed_timestamp, 0 unparsed_price from raw) r, (select count(*) clean_rows, count(*) filter (where event_type = 'view') views, "
    "count(*) filter (where event_type = 'cart') carts, count(*) filter (where event_type = 'purchase') purchases, "
    "count(distinct event_type) n_event_types from clean) c",
    "users_by_category_indexed": _with(_AFFINITY)
    + f"select user_id, total_score score from affinity where category = '{LOOKUP_CATEGORY}' "
    "order by score desc nulls last, user_id limit 3",
    "store_versions": _with(*_PROFILE_CTES)
    + "select 1 version, count(*) users, 0::bigint recommended from profiles union all select 2, count(*), "
    "sum(case when recommended_pairs = '' then 0 else len(string_split(recommended_pairs, '|')) end)::bigint from profiles",
    "users_by_item_indexed": _with(*_PROFILE_CTES)
    + f"select user_id from profiles where list_contains(string_split(recommended_pairs, '|'), '{LOOKUP_ITEM}') "
    "order by user_id limit 5",
    "profile_by_user_indexed": _with(*_PROFILE_CTES) + f"select * from profiles where user_id = '{LOOKUP_USER}'",
    "store_by_item": _with(*_PROFILE_CTES)
    + "select distinct u.item, p.user_id from profiles p, unnest(string_split(p.recommended_pairs, '|')) u(item) "
    "where p.recommended_pairs <> ''",
}
