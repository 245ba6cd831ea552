"""Column functions: Column in, Column out, all evaluated by Spark's built-in expressions."""

from tidemill.functions.clock import as_ntz, day, days_since, event_time, in_trailing, proc_time, stamp, with_ingest_ts
from tidemill.functions.text import (
    clean_text,
    full_name,
    full_name_strict,
    norm_category,
    norm_email,
    tokens,
    url_item_id,
    url_page,
    utm,
    valid_email,
)
from tidemill.functions.values import clamp_non_negative, engagement_segment, safe_ratio, total_price
from tidemill.functions.vector import cosine_distance, dot, norm, normalised, similarity, similarity_text

__all__ = [
    "as_ntz", "day", "days_since", "event_time", "in_trailing", "proc_time", "stamp", "with_ingest_ts",
    "clean_text", "full_name", "full_name_strict", "norm_category", "norm_email", "tokens", "url_item_id", "url_page",
    "utm", "valid_email",
    "clamp_non_negative", "engagement_segment", "safe_ratio", "total_price",
    "cosine_distance", "dot", "norm", "normalised", "similarity", "similarity_text",
]
