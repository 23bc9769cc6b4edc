"""Sources: the raw session scan and cleaning, and the test-table session view."""

from .ingest import clean_sessions, detect_formats, normalise_headers, read_sessions, rejected_values, typed_sessions
from .testtables import dirty_sessions, sessions

__all__ = [
    "clean_sessions",
    "detect_formats",
    "dirty_sessions",
    "normalise_headers",
    "read_sessions",
    "rejected_values",
    "sessions",
    "typed_sessions",
]
