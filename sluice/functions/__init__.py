from .parsing import (
    compile_strptime,
    datetime_value,
    float_number,
    integer_number,
    integral,
    number,
    strptime,
)
from .text import NA_TOKENS, key_value_text, na_to_null, newline_to_space, python_list_text

__all__ = [
    "NA_TOKENS",
    "compile_strptime",
    "datetime_value",
    "float_number",
    "integer_number",
    "integral",
    "key_value_text",
    "na_to_null",
    "newline_to_space",
    "number",
    "python_list_text",
    "strptime",
]
