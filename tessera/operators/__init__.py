"""Relational operators that Spark lacks or that need care at scale."""

from .chunks import chunked_map  # noqa: F401
from .joins import asof_join, hot_keys, interval_join, ordered_pairs, overlap_join, range_join, salted_join, skew_join  # noqa: F401
from .ranks import ntile, ranks, row_numbers, running  # noqa: F401
from .theta import inequality_totals  # noqa: F401
from .windows import sessions, top_per_group  # noqa: F401
