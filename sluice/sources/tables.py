"""Tables as landing text: any DataFrame -> the records contract of the checks.

Used when the rows already live in a table (e.g. parquet) and only the
quality checks are wanted: each column becomes text, a column expression
names the pseudo file and another gives the per-file ordinal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import na_to_null
from ..rules import TableRules


def table_records(
    df: DataFrame,
    rules: TableRules,
    file: Column | str,
    index: Column | str,
    texts: dict[str, Column] | None = None,
    na_tokens: bool = True,
    spread_rows: bool = True,
) -> DataFrame:
    """Project ``df`` to (source_filename, index, <data columns as text>).

    ``texts`` maps a header name (``expected_file_name``) to a Column; header
    names without an entry are taken from the column of the same name.
    ``spread_rows``: a table with fewer partitions than task slots is spread
    round-robin first, so the text derivation and checks use every core.
    """
    if spread_rows:
        from ..operators.rowchecks import spread

        df = spread(df)
    texts = texts or {}
    file = F.col(file) if isinstance(file, str) else file
    index = F.col(index) if isinstance(index, str) else index
    cols = []
    for rule in rules.data_columns:
        c = texts.get(rule.expected_file_name, F.col(rule.expected_file_name))
        c = c.cast("string")
        cols.append((na_to_null(c) if na_tokens else c).alias(rule.name))
    return df.select(
        file.cast("string").alias("source_filename"), index.cast("bigint").alias("index"), *cols
    )
