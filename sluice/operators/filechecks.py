"""File-level checks (F1-F4): readability, header, one file_stats row per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FILE_BAD_COLUMNS_TEXT, FILE_UNREADABLE_TEXT, FILE_VALID_TEXT
from ..sources.listing import HIDDEN, PATH
from .reports import _ts

UNREADABLE = FILE_UNREADABLE_TEXT

# --- fixed values: our own error tails (the reference prints library errors)
NO_COLUMNS = "No columns to parse from file"
BAD_UTF8 = "invalid UTF-8 byte sequence"
OPEN_QUOTE = "Error tokenizing data. EOF inside string"
SHIFTED = "first data row has more fields than the header"
HIDDEN_NAME = "Error when reading the file : names that begin with _ or . are not read"
BAD_JSON = "document is not a JSON array of objects"
# --------------------------------------------------------------------------


def _csv_description() -> Column:
    u = F.lit(UNREADABLE["csv"])
    header, first = F.col("header_fields"), F.col("first_fields")
    # Extra fields on the first data row become index columns in pandas: rows
    # are too long only beyond the wider of the header and that row.
    allowed = F.greatest(header, F.coalesce(first, header))
    return (
        F.when(F.col("n_records").isNull(), F.concat(u, F.lit(NO_COLUMNS)))
        .when(F.col("bad_utf8"), F.concat(u, F.lit(BAD_UTF8)))
        .when(F.col("open_quote"), F.concat(u, F.lit(OPEN_QUOTE)))
        .when(
            F.col("max_fields") > allowed,
            F.concat(
                u, F.lit("Error tokenizing data. Expected "), allowed.cast("string"),
                F.lit(" fields, saw "), F.col("max_fields").cast("string"),
            ),
        )
        .when(~F.col("header_ok"), F.lit(FILE_BAD_COLUMNS_TEXT))
        # Deviation: pandas would shift the columns silently; reported instead.
        .when(first > header, F.concat(u, F.lit(SHIFTED)))
        .otherwise(F.lit(FILE_VALID_TEXT))
    )


def _json_description() -> Column:
    u = F.lit(UNREADABLE["json"])
    return (
        F.when(F.col("bad_utf8"), F.concat(u, F.lit(BAD_UTF8)))
        .when(~F.coalesce(F.col("parse_ok"), F.lit(False)), F.concat(u, F.lit(BAD_JSON)))
        .when(~F.col("header_ok"), F.lit(FILE_BAD_COLUMNS_TEXT))
        .otherwise(F.lit(FILE_VALID_TEXT))
    )


def _workbook_description() -> Column:
    u = F.lit(UNREADABLE["xlsx"])
    return (
        F.when(~F.coalesce(F.col("parse_ok"), F.lit(False)), F.concat(u, F.col("error")))
        .when(~F.col("header_ok"), F.lit(FILE_BAD_COLUMNS_TEXT))
        .otherwise(F.lit(FILE_VALID_TEXT))
    )


def file_stats(
    listing: DataFrame,
    csv_facts: DataFrame | None,
    json_facts: DataFrame | None,
    workbook_facts: DataFrame | None,
    pipeline: str,
    dataset: str,
    table: str,
    ingest_ts,
    small: bool = False,
) -> DataFrame:
    """One row per non-empty listed file; keeps ``_path`` for the row filter (F4).

    ``small``: the caller bounded the file count; the per-file facts are then
    broadcast into the listing instead of shuffled."""
    parts = []
    ext = F.col("ext")

    def b(df):
        return F.broadcast(df) if small else df

    if csv_facts is not None:
        parts.append(
            listing.where(ext == "csv").join(b(csv_facts), PATH, "left")
            .select(PATH, "source_filename", _csv_description().alias("description"))
        )
    if json_facts is not None:
        parts.append(
            listing.where(ext == "json").join(b(json_facts), PATH, "left")
            .select(PATH, "source_filename", _json_description().alias("description"))
        )
    if workbook_facts is not None:
        parts.append(
            listing.where(ext.isin("xlsx", "xlsm")).join(b(workbook_facts), PATH, "left")
            .select(PATH, "source_filename", _workbook_description().alias("description"))
        )
    handled = [k for k, f in (("csv", csv_facts), ("json", json_facts)) if f is not None]
    if workbook_facts is not None:
        handled += ["xlsx", "xlsm"]
    # Unknown extension: nothing is read, so the header test fails (S1c). Names
    # that Spark does not read are reported as such.
    parts.append(
        listing.where(~ext.isin(*handled) if handled else F.lit(True))
        .select(
            PATH, "source_filename",
            F.when(ext == HIDDEN, F.lit(HIDDEN_NAME)).otherwise(F.lit(FILE_BAD_COLUMNS_TEXT)).alias("description"),
        )
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        PATH,
        F.lit(pipeline).alias("pipeline"),
        F.lit(dataset).alias("dataset"),
        F.lit(table).alias("table"),
        "source_filename",
        _ts(ingest_ts).alias("date_ingest"),
        (F.col("description") != FILE_VALID_TEXT).alias("is_invalid"),
        "description",
    )
