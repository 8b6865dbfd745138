"""Text helpers used by the scans and the checks (built-in expressions only)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Field texts that pandas.read_csv turns into missing values (quoted or not).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Quoted section of a CSV field: "..." with "" as an escaped quote.
QUOTED_SECTION = r'"[^"]*+(?:""[^"]*+)*+"'
# Printed for a null member of a key tuple.
NULL_KEY_TEXT = "nan"
# --------------------------------------------------------------------------


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_TOKENS), c)


def newline_to_space(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(" "))


def extension(path: Column) -> Column:
    """Last suffix of the file name, without the dot (case kept)."""
    return F.regexp_extract(path, r"\.([^./]+)$", 1)


def python_list_text(names: list[str]) -> str:
    """``str(list)`` of column names: ['a', 'b']."""
    return "[" + ", ".join(repr(n) for n in names) + "]"


def key_value_text(cols: list[Column]) -> Column:
    """Key tuple as text: ['v1','v2'] with nulls printed as nan."""
    parts = [F.coalesce(c, F.lit(NULL_KEY_TEXT)) for c in cols]
    return F.concat(F.lit("['"), F.concat_ws("','", *parts), F.lit("']"))


def _field_start(sep: str) -> str:
    return "(^|" + re.escape(sep) + ")"


def unquoted(raw: Column, sep: str) -> Column:
    """Raw record without the closed quoted sections at the starts of fields; quotes
    elsewhere are text (cheap path if there is no quote)."""
    return F.when(F.instr(raw, '"') == 0, raw).otherwise(
        F.regexp_replace(raw, _field_start(sep) + QUOTED_SECTION, "$1")
    )


def count_char(text: Column, ch: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def open_quote(raw_unquoted: Column, sep: str) -> Column:
    """A quote left at a field start after closed sections are removed
    (the regex only runs on text that still holds a quote)."""
    has_quote = F.instr(raw_unquoted, '"') > 0
    return has_quote & raw_unquoted.rlike(_field_start(sep) + '"')
