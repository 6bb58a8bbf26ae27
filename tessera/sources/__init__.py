"""Sources and sinks over a configurable base URI."""

from .commit_log import register_commit_log  # noqa: F401
from .tables import TABLES, deleted, exists, load, load_all, materialised, object_store, rate_stream, read, scratch, stream, write, write_bucketed  # noqa: F401
