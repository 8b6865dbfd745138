"""Type checks as built-in Column expressions (no Python UDFs).

Each check returns a Column that is null when the text does not parse, so a
violation is simply ``parsed.isNull()``. Parsers with a ``plain`` form read most texts by a
cast alone; ``plain_value`` is null where a text is not in that form, and the stages then decide. The grammar follows pandas 2.x:
``to_numeric`` for numbers and the ``strptime`` directive set for dates.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Characters of a finite number that pandas.to_numeric accepts.
NUMBER_CHARS = "0123456789+-.eE"
# Infinity spellings pandas.to_numeric accepts (compared lower-cased).
INFINITY_WORDS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
# INTEGER columns reject a non-zero fraction written with '.' or ','.
INTEGER_FRACTION_REJECT = r"^[0-9]*[.,][1-9]+\n?\z"
ASCII_SPACE = " \t\n\x0b\x0c\r"
# Text substituted for nulls before the type test.
NULL_NUMBER_TEXT = "0"
NULL_DATE_TEXT = "1900-01-01"
# pandas datetime64[ns] bounds.
TS_MIN = "1677-09-21 00:12:43.145225"
TS_MAX = "2262-04-11 23:47:16.854775"
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
MONTHS_ABBR = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# strptime directive -> (regex, field). Same alternatives as the C library order.
DIRECTIVES = {
    "d": (r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])", "day"),
    "m": (r"(1[0-2]|0[1-9]|[1-9])", "month"),
    "Y": (r"([0-9][0-9][0-9][0-9])", "year"),
    "y": (r"([0-9][0-9])", "year2"),
    "H": (r"(2[0-3]|[0-1][0-9]|[0-9])", "hour"),
    "I": (r"(1[0-2]|0[1-9]|[1-9])", "hour12"),
    "M": (r"([0-5][0-9]|[0-9])", "minute"),
    "S": (r"(6[0-1]|[0-5][0-9]|[0-9])", "second"),
    "f": (r"([0-9]{1,6})", "fraction"),
    "p": (r"(am|pm)", "ampm"),
    "j": (r"(36[0-6]|3[0-5][0-9]|[12][0-9][0-9]|0[1-9][0-9]|00[1-9]|[1-9][0-9]|0[1-9]|[1-9])", "yday"),
    "B": ("(" + "|".join(MONTHS) + ")", "month_name"),
    "b": ("(" + "|".join(MONTHS_ABBR) + ")", "month_abbr"),
}
# --------------------------------------------------------------------------


class NumberParser:
    """pandas ``to_numeric`` on text, in three stages (see ``Staged``).

    No regex on the value path: after trimming, the text must consist of
    number characters (digits, sign, point, exponent) and cast to a finite
    double, or be one of the infinity spellings. Overflow (``1e400``) is
    unparsable. The character test rules out what Java's parser accepts and
    pandas does not (``1d``, ``1f``, hex floats, ``NaN``). FLOAT columns drop
    the thousand separator and map the decimal one to '.' first (literal
    replacements). INTEGER columns first reject a non-zero fraction
    (``^[0-9]*[.,][1-9]+$``), the regex running only on text with '.' or ','.
    """

    def __init__(self, thousand: str | None = None, decimal: str | None = None, integer: bool = False):
        self.thousand, self.decimal, self.integer = thousand, decimal, integer

    def prepare(self, text: Column) -> dict[str, Column]:
        t = text
        if self.thousand is not None:
            t = F.replace(t, F.lit(self.thousand), F.lit(""))
        if self.decimal is not None:
            t = F.replace(t, F.lit(self.decimal), F.lit("."))
        prep = {"s": F.btrim(t, F.lit(ASCII_SPACE))}
        if self.integer:
            has_sep = (F.instr(text, ".") > 0) | (F.instr(text, ",") > 0)
            prep["frac"] = F.when(has_sep, text.rlike(INTEGER_FRACTION_REJECT)).otherwise(F.lit(False))
        return prep

    def raw(self, prep: dict[str, Column]) -> Column:
        return prep["s"].try_cast("double")

    def final(self, prep: dict[str, Column], raw: Column) -> Column:
        s = prep["s"]
        numeric = (F.translate(s, NUMBER_CHARS, "") == "") & (F.abs(raw) < F.lit(float("inf")))
        ok = numeric | F.lower(s).isin(*INFINITY_WORDS)
        if self.integer:
            ok = ok & ~prep["frac"]
        return F.when(ok, raw)

    def plain(self, text: Column) -> tuple[Column, Column]:
        t = text
        if self.thousand is not None:
            t = F.replace(t, F.lit(self.thousand), F.lit(""))
        if self.decimal is not None:
            t = F.replace(t, F.lit(self.decimal), F.lit("."))
        return t, t.try_cast("bigint" if self.integer else "double")

    def plain_value(self, text: Column, t: Column, raw: Column) -> Column:
        # What casts to a number, begins with a sign, point or digit and ends with a digit (or a point) has blanks
        # and control characters nowhere and no suffix; only a hex float is still to be told apart.
        ends = t.between("+", ":") & F.substring(t, -1, 1).between("0" if self.integer else ".", "9")
        if self.integer:
            return F.when(ends, raw)
        return F.when(ends & (F.instr(t, "x") == 0) & (F.instr(t, "X") == 0) & (F.abs(raw) < F.lit(float("inf"))), raw)

    def __call__(self, text: Column) -> Column:
        prep = self.prepare(text)
        return self.final(prep, self.raw(prep))


def number(text: Column) -> Column:
    """pandas ``to_numeric`` on one text value: double, or null if unparsable."""
    return NumberParser()(text)


def float_number(text: Column, thousand: str | None, decimal: str | None) -> Column:
    """FLOAT rule: literal separator replacement (thousand first), then parse."""
    return NumberParser(thousand, decimal)(text)


def integer_number(text: Column) -> Column:
    """INTEGER rule: reject a non-zero fraction, then parse as a number."""
    return NumberParser(integer=True)(text)


def integral(text: Column, value: Column) -> Column:
    """Typed value of an INTEGER column whose parsed number is ``value``: the
    bigint that the text says, digit by digit (no detour through a double);
    null when the number is not integral or no bigint."""
    s = F.btrim(text, F.lit(ASCII_SPACE))
    exact = s.try_cast("decimal(38,9)")  # 1e3, 10.0
    whole = F.when((value == F.floor(value)) & (exact == F.floor(exact)), exact.try_cast("bigint"))
    return F.when(value.isNotNull(), F.coalesce(s.try_cast("bigint"), whole))


@dataclass(frozen=True)
class StrptimeFormat:
    fmt: str
    regex: str
    fields: tuple[str, ...]  # field of each capture group, in order

    @property
    def has_time(self) -> bool:
        return any(f in self.fields for f in ("hour", "hour12", "minute", "second", "fraction"))


@lru_cache(maxsize=None)
def compile_strptime(fmt: str) -> StrptimeFormat:
    """Translate a strptime format into an anchored, case-insensitive regex."""
    out, fields, i = [], [], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "%":
            if i + 1 >= len(fmt):
                raise ValueError(f"format {fmt!r} ends with a lone %")
            d = fmt[i + 1]
            i += 2
            if d == "%":
                out.append("%")
                continue
            if d not in DIRECTIVES:
                raise ValueError(f"unsupported strptime directive %{d} in {fmt!r}")
            rx, field = DIRECTIVES[d]
            if field in fields:
                raise ValueError(f"directive %{d} repeated in {fmt!r}")
            out.append(rx)
            fields.append(field)
        elif ch.isspace():
            while i < len(fmt) and fmt[i].isspace():
                i += 1
            out.append(r"\s+")
        else:
            out.append(re.escape(ch))
            i += 1
    return StrptimeFormat(fmt, "(?i)^" + "".join(out) + r"\z", tuple(fields))


def _month_from_name(name: Column, names: tuple[str, ...]) -> Column:
    lowered = F.lower(name)
    expr = F.lit(None).cast("int")
    for n, month in reversed(list(enumerate(names, start=1))):
        expr = F.when(lowered == month, F.lit(n)).otherwise(expr)
    return expr


MATCH_MARK = "\u0000"
FIELD_SEP = "\u0001"


class StrptimeParser:
    """Text -> TIMESTAMP_NTZ with a strptime format, in three stages.

    prepare: one regex evaluation; the anchored format regex rewrites a
    matching text to MARK g1 SEP g2 ... (a text that does not match comes
    back unchanged, without MARK). raw: the timestamp built from the fields.
    final: null unless the text matched, the date exists (no 31 February)
    and it lies in the pandas nanosecond range, like
    ``pd.to_datetime(..., format=fmt, errors='coerce')``.
    """

    def __init__(self, fmt: str):
        self.spec = compile_strptime(fmt)

    def prepare(self, text: Column) -> dict[str, Column]:
        k = len(self.spec.fields)
        repl = MATCH_MARK + FIELD_SEP.join(f"${n + 1}" for n in range(k))
        return {"canon": F.regexp_replace(text, self.spec.regex, repl)}

    def raw(self, prep: dict[str, Column]) -> Column:
        fields = self.spec.fields
        parts = F.split(F.substring(prep["canon"], 2, 1 << 30), FIELD_SEP, -1)
        g = {f: F.try_element_at(parts, F.lit(n + 1)) for n, f in enumerate(fields)}

        def num(f):
            return F.trim(g[f]).try_cast("int")

        if "year" in g:
            year = num("year")
        elif "year2" in g:
            y2 = num("year2")
            year = F.when(y2 <= 68, y2 + 2000).otherwise(y2 + 1900)
        else:
            year = F.lit(1900)
        if "month" in g:
            month = num("month")
        elif "month_name" in g:
            month = _month_from_name(g["month_name"], MONTHS)
        elif "month_abbr" in g:
            month = _month_from_name(g["month_abbr"], MONTHS_ABBR)
        else:
            month = F.lit(1)
        day = num("day") if "day" in g else F.lit(1)
        if "hour" in g:
            hour = num("hour")
        elif "hour12" in g:
            h12 = num("hour12") % 12
            hour = h12 + F.when(F.lower(g["ampm"]) == "pm", 12).otherwise(0) if "ampm" in g else h12
        else:
            hour = F.lit(0)
        minute = num("minute") if "minute" in g else F.lit(0)
        if "yday" in g and not ({"month", "month_name", "month_abbr"} & set(g)):
            base = F.try_make_timestamp_ntz(year, F.lit(1), F.lit(1), hour, minute, F.lit(0))
            base = F.timestamp_add("DAY", num("yday") - 1, base)
        else:
            base = F.try_make_timestamp_ntz(year, month, day, hour, minute, F.lit(0))
        if "second" in g or "fraction" in g:
            second = num("second") if "second" in g else F.lit(0)
            micros = F.rpad(g["fraction"], 6, "0").try_cast("int") if "fraction" in g else F.lit(0)
            # seconds 60 and 61 roll over, as in pandas
            base = F.timestamp_add("MICROSECOND", second.cast("bigint") * 1000000 + micros, base)
        return base

    def final(self, prep: dict[str, Column], raw: Column) -> Column:
        canon = prep["canon"]
        matched = F.startswith(canon, F.lit(MATCH_MARK))
        k = len(self.spec.fields)
        shape = F.size(F.split(F.substring(canon, 2, 1 << 30), FIELD_SEP, -1)) == k
        in_range = raw.between(F.lit(TS_MIN).cast("timestamp_ntz"), F.lit(TS_MAX).cast("timestamp_ntz"))
        return F.when(matched & shape & in_range, raw)

    def plain(self, text: Column) -> tuple[Column, Column] | None:
        """The date in ISO order, of formats of full-width numbers in fixed places; None for other formats."""
        at = self._places()
        if at is None:
            return None
        cut = lambda f: F.substring(text, at[f], 4 if f == "Y" else 2)
        clock = "H" in at
        if self.spec.fmt == ("%Y-%m-%d %H:%M:%S" if clock else "%Y-%m-%d"):
            iso = text
        else:
            iso = F.concat(cut("Y"), F.lit("-"), cut("m"), F.lit("-"), cut("d"))
            if clock:
                iso = F.concat(iso, F.lit(" "), cut("H"), F.lit(":"), cut("M"), F.lit(":"), cut("S"))
        return iso, iso.try_cast("timestamp_ntz" if clock else "date")

    def plain_value(self, text: Column, iso: Column, raw: Column) -> Column:
        # What the value prints as is what the text says, digit by digit; marks between the numbers are compared.
        at = self._places()
        same = raw.cast("string") == iso
        if self.spec.fmt != ("%Y-%m-%d %H:%M:%S" if "H" in at else "%Y-%m-%d"):
            same = same & (F.length(text) == at["width"])
            for place, mark in at["marks"]:
                same = same & (F.substring(text, place, len(mark)) == F.lit(mark))
        value = raw.cast("timestamp_ntz")
        in_range = value.between(F.lit(TS_MIN).cast("timestamp_ntz"), F.lit(TS_MAX).cast("timestamp_ntz"))
        return F.when(same & in_range & (F.length(iso) == (19 if "H" in at else 10)), value)

    def _places(self) -> dict | None:
        """Place of each directive and mark in a text of full-width numbers."""
        parts = re.findall(r"%.|[^%]+", self.spec.fmt)
        names = sorted(p[1] for p in parts if p[0] == "%")
        if names not in (["Y", "d", "m"], ["H", "M", "S", "Y", "d", "m"]):
            return None
        at, place = {"marks": []}, 1
        for p in parts:
            if p[0] == "%":
                at[p[1]] = place
                place += 4 if p[1] == "Y" else 2
            else:
                at["marks"].append((place, p))
                place += len(p)
        return {**at, "width": place - 1}

    def __call__(self, text: Column) -> Column:
        prep = self.prepare(text)
        return self.final(prep, self.raw(prep))


def strptime(text: Column, fmt: str) -> Column:
    """Parse text with a strptime format to TIMESTAMP_NTZ; null when invalid."""
    return StrptimeParser(fmt)(text)


# --- fixed values -----------------------------------------------------------
# Date parts that a first value may show, in the order in which pandas prefers them
# (month before day); a time part may follow after a blank or T.
FIRST_VALUE_FORMATS = (
    "%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%Y %m %d", "%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d-%m-%Y", "%m.%d.%Y", "%d.%m.%Y",
    "%d %B %Y", "%d %b %Y", "%d-%B-%Y", "%d-%b-%Y", "%B %d, %Y", "%b %d, %Y", "%Y%m%d", "%Y%m%d%H%M%S", "%Y-%m", "%Y",
)
TIME_PART = r"[T ][0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2}(?:\.[0-9]{1,6})?)?\z"
# --------------------------------------------------------------------------


class FirstValueParser:
    """DATE/DATETIME without a format: pandas takes the format of the column's first
    value in the file and reads all others by it.

    ``date`` and ``time``: columns with the number of the file's date format and the
    shape of its time part (see ``first_value_format``); where ``date`` is null, because the
    first value shows no known format, or not given, each value is read by the
    first format that fits it. ``used``: the date formats that occur (None: any may), ``alone``: whether
    the date may be null. Formats with a zone, weekday or two-digit year are not known.
    """

    def __init__(self, date: Column | None = None, time: Column | None = None, used: tuple[int, ...] | None = None, alone: bool = True):
        self.date, self.time, self.alone = date, time, alone
        self.used = range(len(FIRST_VALUE_FORMATS)) if used is None else used

    def prepare(self, text: Column) -> dict[str, Column]:
        date = F.when(F.instr(text, ":") > 0, F.regexp_replace(text, TIME_PART, "")).otherwise(text)
        return {"d": date, "t": F.substr(text, F.length(date) + 1)}

    def raw(self, prep: dict[str, Column]) -> Column:
        value = F.lit(None).cast("timestamp_ntz")
        if self.alone or self.date is None:
            any_format = F.coalesce(*[strptime(prep["d"], f) for f in FIRST_VALUE_FORMATS])
            if self.date is None:
                return any_format
            value = F.when(self.date.isNull(), any_format)
        for k in self.used:
            value = F.when(self.date == k, strptime(prep["d"], FIRST_VALUE_FORMATS[k])).otherwise(value)
        return value

    def final(self, prep: dict[str, Column], raw: Column) -> Column:
        value = raw + _time_of(prep["t"])
        if self.date is not None:
            value = F.when(self.date.isNull() | (time_shape(prep["t"]) == self.time), value)
        return F.when(value.between(F.lit(TS_MIN).cast("timestamp_ntz"), F.lit(TS_MAX).cast("timestamp_ntz")), value)

    def __call__(self, text: Column) -> Column:
        prep = self.prepare(text)
        return self.final(prep, self.raw(prep))


def time_shape(part: Column) -> Column:
    """0 for no time; else hours to minutes 1, seconds 2, fractions 3, and 10 more after a T."""
    seconds = F.when(F.instr(part, ".") > 0, 3).when(F.length(part) - F.length(F.replace(part, F.lit(":"), F.lit(""))) == 2, 2).otherwise(1)
    return F.when(part == "", 0).otherwise(seconds + F.when(F.startswith(part, F.lit("T")), 10).otherwise(0))


def _time_of(part: Column) -> Column:
    """A time part as an interval; null if it is no time."""
    n = [F.try_element_at(F.split(F.substr(part, F.lit(2)), ":"), F.lit(k)) for k in (1, 2, 3)]
    hour, minute, second = n[0].try_cast("int"), n[1].try_cast("int"), F.coalesce(n[2].try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
    fits = (hour < 24) & (minute < 60) & (second < 62)
    known = F.when(part == "", F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0)))
    return F.when(part == "", known).when(fits, F.make_dt_interval(F.lit(0), hour, minute, second))


def first_value_format(text: Column) -> Column:
    """(date, time) of a first value: the number of its date format and the shape of its
    time part; a null date if it shows none."""
    parser = FirstValueParser()
    prep = parser.prepare(text)
    date = F.coalesce(*[F.when(strptime(prep["d"], f).isNotNull(), F.lit(k)) for k, f in enumerate(FIRST_VALUE_FORMATS)])
    return F.struct(F.when(_time_of(prep["t"]).isNotNull(), date).alias("date"), time_shape(prep["t"]).alias("time"))


def seldom(parser, text: Column) -> Column:
    """``parser(text)``, its stages in lambdas, which Spark interprets: for texts that are not in the plain form.
    Generated code, and so the method that each row runs through, stays small."""
    one = F.transform(F.array(text), lambda t: F.struct(*[c.alias(k) for k, c in parser.prepare(t).items()]))
    refs = lambda p: {k: p[k] for k in parser.prepare(text)}
    one = F.transform(one, lambda p: F.struct(p.alias("prep"), parser.raw(refs(p)).alias("raw")))
    return F.get(F.transform(one, lambda p: parser.final(refs(p["prep"]), p["raw"])), F.lit(0))


def datetime_value(text: Column, fmt: str | None) -> Column:
    return strptime(text, fmt) if fmt else FirstValueParser()(text)


def parser_for(type_: str, fmt: str | None = None, thousand: str | None = None, decimal: str | None = None):
    """The staged parser of a rule type (None for STRING)."""
    if type_ in ("FLOAT", "FLOAT64"):
        return NumberParser(thousand, decimal)
    if type_ == "INTEGER":
        return NumberParser(integer=True)
    if type_ in ("DATE", "DATETIME"):
        return StrptimeParser(fmt) if fmt else FirstValueParser()
    return None
