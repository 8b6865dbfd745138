"""Type-parse expressions against pandas (the behaviour to match), case by case."""

import random
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.functions.parsing import compile_strptime, float_number, integer_number, number, strptime

NUMBER_CASES = [
    " 12 ", "12", "1.", ".5", "+1.5", "-0", "1e3", "1E+3", "inf", "-inf", "Infinity", "INF",
    "+inf", "nan", "NaN", "1_000", "0x10", "1,5", "1 000", "12L", "1d", "1f", "3D", "1e400",
    "", "  ", "\t5\t", "1e", "e5", ".", "-.5e-3", "1.5.", "00012", "1e-400", "True", "5\n",
    "12345678901234567890123", "0x1p3", "1.5E-3", "+.5", "-1.", "1e+", "٣٤",
]


def pandas_number_ok(values):
    s = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce", downcast="float")
    return [not x for x in s.isna()]


def spark_ok(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", expr(F.col("v")).isNotNull().alias("ok")).orderBy("i").collect()
    return [r.ok for r in rows]


def test_number_matches_pandas(spark):
    assert spark_ok(spark, NUMBER_CASES, number) == pandas_number_ok(NUMBER_CASES)


def test_number_random_texts_match_pandas(spark):
    rng = random.Random(7)
    alphabet = "0123456789..,eE+- \tinfINF"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 7))) for _ in range(1500)]
    assert spark_ok(spark, values, number) == pandas_number_ok(values)


def reference_integer_ok(values):
    s = pd.Series(values, dtype=object).fillna("0")
    s = s.str.replace(pat="^[0-9]*[.,][1-9]+$", repl="ERROR_COMMA", regex=True)
    return [not x for x in pd.to_numeric(s, errors="coerce", downcast="integer").isna()]


INTEGER_OK = ["10", "10.0", "1e3", "10.05", "10.50", "-10.1", "+1.5"]
INTEGER_BAD = ["10.1", ".5", "10,1", "10,0", "1_000", "0x10", "x"]


def test_integer_cases(spark):
    got = spark_ok(spark, INTEGER_OK + INTEGER_BAD, integer_number)
    assert got == [True] * len(INTEGER_OK) + [False] * len(INTEGER_BAD)
    assert got == reference_integer_ok(INTEGER_OK + INTEGER_BAD)


def test_integer_random_texts_match_pandas(spark):
    rng = random.Random(11)
    alphabet = "0123456789..,,e-"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))) for _ in range(1000)]
    assert spark_ok(spark, values, integer_number) == reference_integer_ok(values)


def test_float_separators(spark):
    ok = ["1.234,5", "7", "inf"]
    bad = ["1,2,3", "1d", "12L", "1 000", "1e400"]
    got = spark_ok(spark, ok + bad, lambda c: float_number(c, ".", ","))
    assert got == [True] * len(ok) + [False] * len(bad)


DATE_CASES = {
    "%d %B %Y": [
        "1 January 2020", "01 JANUARY 2020", " 1 January 2020", "1  January 2020", "1\tJanuary 2020",
        "1 Jan 2020", "31 February 2020", "1 January 2020 ", "01 January 2300", " 01 January 2020",
        "1900-01-01", "22 September 1677", "21 September 1677", "11 April 2262", "12 April 2262",
        "29 February 2021", "29 February 2020", "1 January 0001", "1January 2020",
    ],
    "%d/%m/%Y": [
        "1/2/2020", "22/09/1677", "11/04/2262", "01/02/20", "01-02-2020", "01/13/2020",
        "21/09/1677", "12/04/2262", "1/ 2/2020", " 1/2/2020", "001/02/2020", "1/02/2020 ",
    ],
    "%Y-%m-%d %H:%M:%S": [
        "2020-01-02 03:04:05", "2020-1-2 3:4:5", "2020-01-02T03:04:05", "2020-01-02 03:04",
        "2020-01-02 24:00:00", "2020-01-02  03:04:05", "2020-01-02 03:04:60", "2020-01-02 03:04:61",
    ],
    "%Y-%m-%d": ["2020-01-02", "2020-1-2", "2020-01-02 00:00:00", "20200102", "2020-02-30", "2020/01/02"],
    "%d.%m.%y %I:%M %p": ["01.02.20 01:05 PM", "01.02.69 12:05 am", "01.02.68 1:05 pm", "01.02.20 13:05 PM"],
    "%Y%m%d": ["20200102", "2020012", "202011"],
    "%Y-%m-%dT%H:%M:%S.%f": ["2020-01-02T03:04:05.5", "2020-01-02T03:04:05.123456", "2020-01-02T03:04:05"],
    "%d-%b-%Y": ["01-Jan-2020", "1-jan-2020", "01-JAN-2020", "01-January-2020", "31-Feb-2020", "01-Sept-2020"],
    "%Y-%j": ["2020-001", "2020-366", "2021-366", "2020-60", "2020-0", "2020-367"],
    "%B %d, %Y": ["March 3, 2021", "march 03, 2021", "March 3,2021", "March  3, 2021"],
}


@pytest.mark.parametrize("fmt", list(DATE_CASES))
def test_strptime_matches_pandas(spark, fmt):
    values = DATE_CASES[fmt]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        expected = pd.to_datetime(pd.Series(values, dtype=object), format=fmt, errors="coerce")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.t for r in df.select("i", strptime(F.col("v"), fmt).alias("t")).orderBy("i").collect()]
    want = [None if pd.isna(x) else x.to_pydatetime() for x in expected]
    assert got == want


def test_unsupported_directive_rejected():
    with pytest.raises(ValueError):
        compile_strptime("%d %Z")


def test_integer_values_are_exact(spark):
    from sluice.functions.parsing import integer_number, integral

    texts = ["9007199254740993", "9223372036854775807", "-9223372036854775808", " 12 ", "1e3", "10.0", "10.05", "9223372036854775808", "x", None, "inf"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(integral(F.col("t"), integer_number(F.col("t")))).collect()]
    assert got == [9007199254740993, 2**63 - 1, -(2**63), 12, 1000, 10, None, None, None, None, None]
