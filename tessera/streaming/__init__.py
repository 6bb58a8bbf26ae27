"""Structured Streaming operators on event time."""

from .events import Landing, deduplicated, event_time, first_seen, interval_pairs, interval_pairs_or_none, kind_counts, not_followed, rocksdb_state, run_to_table, running_totals, session_counts, sliding, tumbling  # noqa: F401
from .upserts import upsert  # noqa: F401
