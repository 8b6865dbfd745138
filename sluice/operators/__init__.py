from .filechecks import file_stats
from .keys import duplicate_groups, duplicate_groups_two_phase, with_key_counts
from .reports import data_invalid, row_counts, rows_stats
from .rowchecks import annotate, normalise, spread, typed_valid, violation_columns, with_parsed

__all__ = [
    "annotate",
    "data_invalid",
    "duplicate_groups",
    "duplicate_groups_two_phase",
    "file_stats",
    "normalise",
    "row_counts",
    "rows_stats",
    "spread",
    "typed_valid",
    "violation_columns",
    "with_key_counts",
    "with_parsed",
]
