"""End-to-end batch run in the reference's order, as Spark jobs writing tables.

    python -m shopsignal.plans.phases --raw logs.csv --out /shared/run1
    python -m shopsignal.plans.phases --sf-dir /root/testdata/sf0.01 --out /shared/run1

Phase outputs are written tables, so each phase reads its input from shared
storage (and a lost executor only recomputes from the last written table):

1. ``clean_and_basket``  raw CSV -> ``cleaned_logs`` (Parquet), ``market_basket`` (CSV + header),
   plus the quality report (``reports/quality``), observed during the same pass.
2. ``profiles``          cleaned logs + pairs -> ``affinity_scores``, ``recommendations`` (Parquet), ``user_profiles`` (JSON).
3. ``store``             profiles JSON -> a new version of the profile store (clustered Parquet tables).
4. ``campaign``          cleaned logs + store -> ``campaign`` (Parquet); ``abandoned_items`` (CSV).
5. ``validate``          campaign -> offer counts, row count text (``reports``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.json import parse_metadata
from ..operators import abandonment, affinity, basket, campaign, quality, recommend, store
from ..operators.clean import coerce_types, keep_condition, unparsed
from ..schemas import CART, PURCHASE, ROW_COUNT_LABEL, VIEW
from ..session import checkpoint_root, remove_scratch
from ..sources import files
from .joins import checked_broadcast
from .layout import round_robin, spread

# Whether a raw row has a text that is no timestamp / no price.
BAD = {"timestamp": "_bad_timestamp", "price": "_bad_price"}


def _parsed(raw: DataFrame) -> DataFrame:
    """Typed raw logs with their metadata fields and a flag for each text that did not parse."""
    flags = {BAD[c]: bad for c, bad in unparsed(raw).items()}
    return parse_metadata(coerce_types(raw.withColumns(flags)))


def _quality_aggregates(raw_columns: list[str]) -> list[Column]:
    """The report's plain aggregates over parsed raw rows (no distinct, so they also work in ``observe``)."""
    keep = keep_condition()
    et = F.col("event_type")
    return [
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"null_{c}") for c in raw_columns],
        *[F.count_if(F.col(flag)).alias(f"unparsed_{c}") for c, flag in BAD.items()],
        F.count_if(keep).alias("clean_rows"),
        F.count_if(keep & (et == VIEW)).alias("views"),
        F.count_if(keep & (et == CART)).alias("carts"),
        F.count_if(keep & (et == PURCHASE)).alias("purchases"),
    ]


def _report(figures: DataFrame, raw_columns: list[str]) -> DataFrame:
    typed = F.col("views") + F.col("carts") + F.col("purchases")
    return figures.select(
        "n_rows",
        F.lit(len(raw_columns)).alias("n_columns"),
        *[f"null_{c}" for c in raw_columns],
        *[f"unparsed_{c}" for c in BAD],
        "clean_rows",
        (F.col("n_rows") - F.col("clean_rows")).alias("dropped_rows"),
        "views",
        "carts",
        "purchases",
        "n_event_types",
        (typed == F.col("clean_rows")).alias("reconciles"),
    )


def quality_report(raw: DataFrame) -> DataFrame:
    """A1-A5 in a single scan of the raw logs (the reference runs one job per figure).

    One row: ``n_rows``, ``n_columns``, ``null_<column>`` per raw column,
    ``unparsed_timestamp`` and ``unparsed_price`` (texts that are there but
    do not parse; they count as null too), ``clean_rows``, ``dropped_rows``, ``views``, ``carts``, ``purchases``,
    ``n_event_types`` (distinct types among clean rows) and ``reconciles``.

    The types themselves are ``quality.distinct_values`` (A4), a distributed
    DataFrame: gathering them into this one row would put every distinct
    value, however many the raw data holds, into a single task.  A single
    ``count_distinct`` beside plain aggregates is planned as a shuffle on the
    type, so each task counts only its share of the values.
    """
    parsed = _parsed(raw)
    n_types = F.count_distinct(F.when(keep_condition(), F.col("event_type"))).alias("n_event_types")
    return _report(parsed.agg(*_quality_aggregates(raw.columns), n_types), raw.columns)


def _paths(out: str) -> dict[str, str]:
    root = out.rstrip("/")
    names = ["cleaned_logs", "market_basket", "affinity_scores", "recommendations", "user_profiles", "store", "campaign",
             "abandoned_items", "reports/quality", "reports/offer_counts", "reports/row_count"]
    return {n: f"{root}/{n}" for n in names}


def clean_and_basket(raw: DataFrame, out: str, n_partitions: int | None = None) -> dict[str, str]:
    """Phase 1 with one pass over the raw logs.

    The quality report's figures are observed on the parsed rows while the
    cleaned logs are written (``observe``), so the raw input, the biggest
    table of the whole run, is read once rather than once more for the
    report.  Only the distinct event-type count, which ``observe`` cannot
    take, is read from the written ``event_type`` column.

    Rows are dealt out before anything is parsed: to ``n_partitions``, or,
    if the scan has fewer splits than the cluster has cores (a multi-line CSV
    is one split a file), to as many as there are.  That comes *before* the
    observation too, so the figures are always taken in the write's final stage,
    where Spark applies each task's update exactly once.  In a shuffle-map
    stage a stage re-run after a lost executor could count rows twice.
    """
    p = _paths(out)
    spark = raw.sparkSession
    parsed = _parsed(round_robin(raw, n_partitions) if n_partitions else spread(raw))
    seen = Observation()
    observed = parsed.observe(seen, *_quality_aggregates(raw.columns)).filter(keep_condition())
    observed = observed.drop(*BAD.values())
    files.write_parquet(observed, p["cleaned_logs"])
    cleaned = files.read_clean_parquet(spark, p["cleaned_logs"])
    figures = dict(seen.get)
    figures["n_event_types"] = cleaned.agg(F.count_distinct("event_type")).first()[0]
    schema = ", ".join(f"`{k}` bigint" for k in figures)
    files.write_json(_report(spark.createDataFrame([tuple(figures.values())], schema), raw.columns),
                     p["reports/quality"])
    files.write_csv(basket.market_basket_pairs(cleaned), p["market_basket"])
    return p


def profiles(spark: SparkSession, out: str, n_partitions: int | None = None, with_pairs: bool = True) -> dict[str, str]:
    p = _paths(out)
    cleaned = files.read_clean_parquet(spark, p["cleaned_logs"])
    aff = affinity.affinity_scores(cleaned)
    files.write_parquet(aff, p["affinity_scores"], n_partitions)
    aff = files.read_affinity_parquet(spark, p["affinity_scores"])
    recs = None
    if with_pairs:
        pairs = files.read_pairs_csv(spark, p["market_basket"])
        files.write_parquet(recommend.recommendations_from_pairs(pairs, cleaned), p["recommendations"])
        recs = checked_broadcast(spark.read.parquet(p["recommendations"]))  # measured on the small written table
    files.write_json(recommend.user_profiles(affinity.ranked_categories(aff), recs), p["user_profiles"], n_partitions)
    return p


def publish(spark: SparkSession, out: str, n_partitions: int | None = None) -> dict[str, str]:
    p = _paths(out)
    store.publish_profiles(files.read_profiles_json(spark, p["user_profiles"]), p["store"], n_partitions)
    return p


def campaign_phase(spark: SparkSession, out: str, n_partitions: int | None = None,
                   top_k: int | None = None) -> dict[str, str]:
    p = _paths(out)
    cleaned = files.read_clean_parquet(spark, p["cleaned_logs"])
    prof = files.read_profile_store(spark, store.table_paths(spark, p["store"])["profiles"])
    files.write_parquet(campaign.campaign(cleaned, profiles=prof, top_k=top_k), p["campaign"], n_partitions)
    files.write_csv(abandonment.abandoned_items(cleaned), p["abandoned_items"])
    return p


def validate(spark: SparkSession, out: str) -> dict[str, str]:
    p = _paths(out)
    cmp = files.read_campaign_parquet(spark, p["campaign"])
    files.write_json(campaign.offer_counts(cmp), p["reports/offer_counts"])
    cleaned = files.read_clean_parquet(spark, p["cleaned_logs"])
    quality.row_count(cleaned).select(
        F.concat(F.lit(ROW_COUNT_LABEL), F.col("total_rows").cast("string")).alias("value")
    ).write.mode("overwrite").text(p["reports/row_count"])
    return p


def run_all(raw: DataFrame, out: str, n_partitions: int | None = None, top_k: int | None = None,
            with_pairs: bool = True) -> dict[str, str]:
    """All phases; ``with_pairs=False`` leaves recommendations empty (S5: a run without a pair table)."""
    spark = raw.sparkSession
    clean_and_basket(raw, out, n_partitions)
    profiles(spark, out, n_partitions, with_pairs)
    publish(spark, out, n_partitions)
    campaign_phase(spark, out, n_partitions, top_k)
    return validate(spark, out)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="raw click-log CSV (file or directory)")
    src.add_argument("--sf-dir", help="derive raw logs from a test-data directory (FIXTURES.md)")
    ap.add_argument("--out", required=True, help="output root on shared storage")
    ap.add_argument("--partitions", type=int, default=None, help="output partitions (reference: 48)")
    ap.add_argument("--top-k", type=int, default=None)
    ap.add_argument("--no-recommendations", action="store_true", help="profiles without recommended pairs")
    ap.add_argument(
        "--single-line", action="store_true",
        help="raw CSV has no quoted line breaks: read it line by line without looking "
             "(by default large files are looked through, and those without such a break are split over many tasks)",
    )
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("shopsignal").getOrCreate()
    checkpoint_root(spark)  # a cluster without a shared checkpoint folder fails here, before any job
    from .config import apply_missing, input_bytes, recommended

    apply_missing(spark, recommended(input_bytes(spark, args.raw or args.sf_dir)))
    if args.raw:
        raw = files.read_raw_csv(spark, args.raw, multi_line=False if args.single_line else None)
    else:
        from ..fixtures import raw_logs

        raw = raw_logs(spark, args.sf_dir)
    for name, path in run_all(raw, args.out, args.partitions, args.top_k, not args.no_recommendations).items():
        print(f"{name}\t{path}")
    remove_scratch(spark)


if __name__ == "__main__":
    main()
