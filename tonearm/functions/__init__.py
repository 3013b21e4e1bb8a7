"""Column functions: every one is built from Spark's own expressions."""

from .text import (  # noqa: F401
    clip_name,
    count_label,
    fold_name,
    item_count,
    names_or_none,
    normalise_name,
    parse_count,
    seed_name,
    short_id,
    slug,
    split_items,
)
from .numbers import bucket_label, overlap_count, overlap_percent, percent  # noqa: F401
from .dates import decade, decade_label, start_year  # noqa: F401
