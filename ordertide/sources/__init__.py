"""Readers and writers."""

from .readers import (
    at_snapshot, clean_tracker, coerce_dates, conform, null_profile, promote_header, read_jdbc,
    read_mapping_csv, read_mapping_tabs, read_table, small_table,
)
from .sinks import (
    as_text, current_version, prune_versions, publish, read_published, split_errors, switch_version, write_csv, write_json,
    write_report,
)

__all__ = [
    "as_text", "at_snapshot", "clean_tracker", "coerce_dates", "conform", "current_version", "null_profile",
    "promote_header", "prune_versions", "publish", "read_jdbc", "read_mapping_csv", "read_mapping_tabs", "read_published",
    "read_table", "small_table", "split_errors", "switch_version", "write_csv", "write_json", "write_report",
]
