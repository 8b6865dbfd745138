"""sluice: rule-driven data-quality checks for landing files on Spark.

Rules (JSON) declare header, types, required and key columns; a YAML registry
lists tables. ``check_landing`` reads every landing file of a table in one
scan and returns four DataFrames: file_stats, rows_stats, data_invalid and the
typed valid rows. ``run_landing`` runs the registry and writes the tables.
"""

from .plans import CheckResult, check_landing, check_records, run_landing
from .rules import ColumnRule, RunConfig, TableConfig, TableRules
from .sinks import append_reports, export_csv, load_valid

__all__ = [
    "CheckResult",
    "ColumnRule",
    "RunConfig",
    "TableConfig",
    "TableRules",
    "append_reports",
    "check_landing",
    "check_records",
    "export_csv",
    "load_valid",
    "run_landing",
]
