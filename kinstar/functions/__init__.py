"""Scalar column helpers (built-in Spark expressions only)."""

from kinstar.functions.columns import (  # noqa: F401
    asc_last,
    attr_hash,
    date_key,
    day_of_week_sunday0,
    desc_last,
    full_name,
    generation_label,
    later_of,
    lit_date,
    marriage_end_reason,
    marriage_outcome,
    sibling_role_code,
    spouse_role_code,
    upper_code,
    year_boundaries_between,
)
