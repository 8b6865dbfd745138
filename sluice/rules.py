"""Declarative rule sets: one JSON rule file per table, one YAML registry.

A rule file names the landing prefix, per-format read options and an ordered
list of column rules. The last two column rules must be the lineage columns
``source_filename`` and ``execution_datetime``; they are added by the engine,
not read from the file.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

# --- fixed values: rule files and registry format ---------------------------
LINEAGE_COLUMNS = ("source_filename", "execution_datetime")
KNOWN_TYPES = ("STRING", "INTEGER", "FLOAT", "FLOAT64", "DATE", "DATETIME")
WRITE_MODES = ("APPEND", "TRUNCATE")
# Pipeline name written in every report row.
PIPELINE_NAME = "0_landing_to_raw"
# Registry (YAML) keys: per table, then the quality-report section.
REG_TABLES = "tables"
REG_TO_REQUEST = "to_request"
REG_RULES_FILE = "source_file_params"
REG_DATASET = "destination_bq_dataset_name"
REG_TABLE = "destination_bq_table_name"
REG_WRITE_MODE = "write_mode"
REG_QUALITY = "data_quality"
REG_QUALITY_DATASET = "bq_dataset_name"
REG_FILE_STATS = "bq_file_stats_table_name"
REG_ROWS_STATS = "bq_rows_stats_table_name"
REG_DATA_INVALID = "bq_data_invalid_table_name"
# ---------------------------------------------------------------------------


class RuleError(ValueError):
    """A rule file or table registry entry that cannot be compiled."""


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str
    expected_file_name: str | None = None
    mode: str = "NULLABLE"
    unique_identifier: bool = False
    date_format: str | None = None
    float_thousand_separator: str | None = None
    float_decimal_separator: str | None = None

    @property
    def required(self) -> bool:
        return self.mode == "REQUIRED"

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> "ColumnRule":
        return cls(
            name=d["name"],
            type=str(d.get("type", "STRING")).upper(),
            expected_file_name=d.get("expected_file_name"),
            mode=str(d.get("mode") or "NULLABLE").upper(),
            unique_identifier=bool(d.get("unique_identifier", d.get("key", False))),
            date_format=d.get("date_format"),
            float_thousand_separator=d.get("float_thousand_separator"),
            float_decimal_separator=d.get("float_decimal_separator"),
        )


@dataclass(frozen=True)
class TableRules:
    """Compiled rule set of one table."""

    columns: tuple[ColumnRule, ...]
    source_path: str = ""
    formats: dict[str, dict[str, Any]] = field(default_factory=dict)
    # Reference behaviour: a null in a NULLABLE date column is parsed as the
    # text 1900-01-01 with the column's format (so it fails for most formats).
    # True gives the evidently intended meaning: nulls pass.
    null_dates_pass: bool = False

    def __post_init__(self):
        names = [c.name for c in self.columns]
        if tuple(names[-2:]) != LINEAGE_COLUMNS:
            raise RuleError(
                "the last two schema entries must be source_filename, execution_datetime"
            )
        if len(set(names)) != len(names):
            raise RuleError(f"duplicate column names in {names}")
        for c in self.columns:
            if c.type not in KNOWN_TYPES:
                raise RuleError(f"column {c.name}: unknown type {c.type}")
            if c.name not in LINEAGE_COLUMNS and not c.expected_file_name:
                raise RuleError(f"column {c.name}: expected_file_name is missing")
        # Compile every date format once so bad formats fail at load time.
        from .functions.parsing import compile_strptime

        for c in self.columns:
            if c.type in ("DATE", "DATETIME") and c.date_format:
                compile_strptime(c.date_format)

    # -- derived column lists (P5) -------------------------------------------
    @property
    def data_columns(self) -> list[ColumnRule]:
        return [c for c in self.columns if c.name not in LINEAGE_COLUMNS]

    @property
    def header(self) -> list[str]:
        return [c.expected_file_name for c in self.data_columns]

    @property
    def header_matchable(self) -> bool:
        """pandas renames a repeated header name ('a', 'a.1'), so a rule set that
        expects the same name twice can never match a file header."""
        return len(set(self.header)) == len(self.header)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def key_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.unique_identifier]

    def format_options(self, ext: str) -> dict[str, Any]:
        return dict(self.formats.get(ext) or {})

    @classmethod
    def from_dict(cls, d: dict[str, Any], **kw) -> "TableRules":
        file_info = d.get("file_info") or {}
        return cls(
            columns=tuple(ColumnRule.from_dict(c) for c in d["schema"]),
            source_path=d.get("source_path", ""),
            formats={k: dict(v or {}) for k, v in (file_info.get("format") or {}).items()},
            **kw,
        )

    @classmethod
    def load(cls, path: str | Path, **kw) -> "TableRules":
        with open(path, encoding="utf-8") as fh:
            return cls.from_dict(json.load(fh), **kw)


@dataclass(frozen=True)
class TableConfig:
    """One entry of the table registry."""

    name: str
    rules_file: str
    dataset: str
    table: str
    write_mode: str = "APPEND"
    to_request: bool = True

    def __post_init__(self):
        if self.write_mode not in WRITE_MODES:
            raise RuleError(f"table {self.name}: write_mode must be one of {WRITE_MODES}")


@dataclass(frozen=True)
class RunConfig:
    tables: tuple[TableConfig, ...]
    quality_dataset: str = "data_quality"
    file_stats_table: str = "file_stats"
    rows_stats_table: str = "rows_stats"
    data_invalid_table: str = "data_invalid"
    pipeline_name: str = PIPELINE_NAME

    @classmethod
    def from_dict(cls, d: dict[str, Any], base_dir: str | Path = ".") -> "RunConfig":
        tables = []
        for name, t in (d.get(REG_TABLES) or {}).items():
            rules_file = Path(t.get(REG_RULES_FILE) or t["rules_file"])
            if not rules_file.is_absolute() and not rules_file.exists():
                rules_file = Path(base_dir) / rules_file
            tables.append(
                TableConfig(
                    name=name,
                    rules_file=str(rules_file),
                    dataset=t.get(REG_DATASET) or t.get("dataset") or "raw",
                    table=t.get(REG_TABLE) or t.get("table") or name,
                    write_mode=str(t.get(REG_WRITE_MODE) or "APPEND").upper(),
                    # The registry test is "== False": a missing flag means run.
                    to_request=t.get(REG_TO_REQUEST) is not False,
                )
            )
        dq = d.get(REG_QUALITY) or {}
        return cls(
            tables=tuple(tables),
            quality_dataset=dq.get(REG_QUALITY_DATASET) or dq.get("dataset") or "data_quality",
            file_stats_table=dq.get(REG_FILE_STATS) or "file_stats",
            rows_stats_table=dq.get(REG_ROWS_STATS) or "rows_stats",
            data_invalid_table=dq.get(REG_DATA_INVALID) or "data_invalid",
            pipeline_name=d.get("pipeline_name") or PIPELINE_NAME,
        )

    @classmethod
    def load(cls, path: str | Path) -> "RunConfig":
        import yaml

        with open(path, encoding="utf-8") as fh:
            return cls.from_dict(yaml.safe_load(fh), base_dir=Path(path).parent)
