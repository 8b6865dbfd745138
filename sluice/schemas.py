"""Fixed report schemas and codes (column order matters)."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
CODE_NULL = "NULL_VALUE_NOT_EXPECTED"
CODE_KEY = "KEY_NOT_UNIQUE"
CODE_PARSE = "COLUMN_NOT_PARSABLE"
#: Our own: the check lets the value pass, but no bigint holds it (the reference's load job fails on it).
CODE_LOAD = "VALUE_NOT_LOADABLE"
# Violation reasons; {col} is a column name, {cols} the Python list text of the
# key columns, {n} the group size.
REASON_REQUIRED = "{col} is NULL whereas it is REQUIRED"
REASON_KEY = "{cols} is not unique : {n} occurences"
REASON_PARSE = "{col} is not parsable to {type}"
REASON_LOAD = "{col} holds a number that cannot be loaded as {type}"
FILE_VALID_TEXT = "File is VALID"
FILE_BAD_COLUMNS_TEXT = "Columns do not respect the columns definition"
FILE_UNREADABLE_TEXT = {
    "csv": "Error when reading the CSV file : ",
    "json": "Error when reading the JSON file : ",
    "xlsx": "Error when reading the Excel file : ",
    "xlsm": "Error when reading the Excel file : ",
}
# --------------------------------------------------------------------------

VIOLATION = T.StructType(
    [
        T.StructField("invalid_reason", T.StringType()),
        T.StructField("invalid_code", T.StringType()),
        T.StructField("invalid_col_name", T.StringType()),
        T.StructField("invalid_col_value", T.StringType()),
    ]
)

DATA_INVALID = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("source_filename", T.StringType()),
        T.StructField("index", T.LongType()),
        T.StructField("invalid_reason", T.StringType()),
        T.StructField("invalid_code", T.StringType()),
        T.StructField("invalid_col_name", T.StringType()),
        T.StructField("invalid_col_value", T.StringType()),
        T.StructField("date_ingest", T.TimestampNTZType()),
    ]
)

ROWS_STATS = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("source_filename", T.StringType()),
        T.StructField("date_ingest", T.TimestampNTZType()),
        T.StructField("nb_valid_lines", T.LongType()),
        T.StructField("nb_invalid_lines", T.LongType()),
        T.StructField(f"nb_invalid_lines_{CODE_NULL}", T.LongType()),
        T.StructField(f"nb_invalid_lines_{CODE_KEY}", T.LongType()),
        T.StructField(f"nb_invalid_lines_{CODE_PARSE}", T.LongType()),
    ]
)

FILE_STATS = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("source_filename", T.StringType()),
        T.StructField("date_ingest", T.TimestampNTZType()),
        T.StructField("is_invalid", T.BooleanType()),
        T.StructField("description", T.StringType()),
    ]
)
