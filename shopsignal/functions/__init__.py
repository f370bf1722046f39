"""Column-expression builders (all JVM-side built-ins, no Python UDFs)."""

from .arrays import (  # noqa: F401
    category_list,
    empty_string_array,
    first_category,
    format_pairs,
    format_ranked,
    format_ranked_maps,
    ranked_to_maps,
)
from .json import metadata_field, parse_metadata  # noqa: F401
from .scoring import event_weight, offer_label  # noqa: F401
