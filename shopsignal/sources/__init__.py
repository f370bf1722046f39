
from .files import (  # noqa: F401
    read_abandoned_csv,
    read_affinity_parquet,
    read_campaign_parquet,
    read_clean_csv,
    read_clean_parquet,
    read_pairs_csv,
    read_profile_store,
    read_profiles_json,
    read_raw_csv,
    write_clean_csv,
    write_csv,
    write_json,
    write_parquet,
)
