"""Column expressions shared by the operators — all built-in, JVM-side."""

from hitparade.functions.columns import (
    DATE_PARTITION_PATTERN,
    calendar_parts,
    has_json_key,
    month_snapshot,
    out_of_range,
    path_snapshot_date,
    present,
    validated_date,
)

__all__ = [
    "DATE_PARTITION_PATTERN",
    "calendar_parts",
    "has_json_key",
    "month_snapshot",
    "out_of_range",
    "path_snapshot_date",
    "present",
    "validated_date",
]
