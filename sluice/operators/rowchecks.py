"""Row-level checks (R1-R6) as one violations array per row.

Input contract (``records``): ``source_filename`` (string), ``index`` (bigint,
per-file ordinal) and the data columns of the rule set, already named by
their target names, all strings, NA tokens already null.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import NULL_DATE_TEXT, NULL_NUMBER_TEXT, FirstValueParser, first_value_format, integral, parser_for, seldom
from ..functions.text import key_value_text, newline_to_space, python_list_text
from ..rules import LINEAGE_COLUMNS, ColumnRule, TableRules
from ..schemas import CODE_KEY, CODE_LOAD, CODE_NULL, CODE_PARSE, REASON_KEY, REASON_LOAD, REASON_PARSE, REASON_REQUIRED
from ..session import broadcast_budget
from .keys import KEY_COUNT, with_key_counts

VIOLATIONS = "violations"
FILE = "source_filename"
INDEX = "index"


def ingest_text(ts) -> str:
    """Ingestion time as 'YYYY-MM-DD HH:MM:SS' (second precision, UTC)."""
    return ts if isinstance(ts, str) else ts.strftime("%Y-%m-%d %H:%M:%S")


FILE_ID = "_file_id"


def normalise(records: DataFrame, rules: TableRules, ingest_ts) -> DataFrame:
    """P1 drop all-null rows, P2 newline to space, P3 lineage columns.

    A ``_file_id`` column (compact per-file key), when present, is kept.
    """
    data = [c.name for c in rules.data_columns]
    extra = [F.col(FILE_ID)] if FILE_ID in records.columns else []
    return (
        records.na.drop(how="all", subset=data)
        .select(
            F.col(FILE),
            *extra,
            F.col(INDEX).cast("bigint").alias(INDEX),
            *[newline_to_space(F.col(c)).alias(c) for c in data],
        )
        .withColumn("execution_datetime", F.lit(ingest_text(ingest_ts)))
    )


def parsed_value(rule: ColumnRule, text: Column) -> Column:
    """Typed value of a text column under its rule (null when unparsable)."""
    parser = _parser(rule)
    return text if parser is None else parser(text)


def parsed_col(name: str) -> str:
    return f"_p_{name}"


def _parser(rule: ColumnRule):
    return parser_for(
        rule.type, rule.date_format, rule.float_thousand_separator, rule.float_decimal_separator
    )


def checked_input(rule: ColumnRule, text: Column, null_dates_pass: bool) -> Column:
    """The text the type test parses: nulls replaced as the reference does."""
    if rule.type in ("DATE", "DATETIME"):
        return text if null_dates_pass else F.coalesce(text, F.lit(NULL_DATE_TEXT))
    return F.coalesce(text, F.lit(NULL_NUMBER_TEXT))


def checked_value(rule: ColumnRule, text: Column, null_dates_pass: bool) -> Column | None:
    """The value the type test looks at (null = not parsable); None for STRING."""
    parser = _parser(rule)
    return None if parser is None else parser(checked_input(rule, text, null_dates_pass))


def parse_failure(rule: ColumnRule, text: Column, null_dates_pass: bool) -> Column | None:
    """True when the column value fails its type (R3); None for STRING."""
    value = checked_value(rule, text, null_dates_pass)
    if value is None:
        return None
    if rule.type in ("DATE", "DATETIME") and null_dates_pass:
        return text.isNotNull() & value.isNull()
    return value.isNull()


def loaded_col(name: str) -> str:
    return f"_i_{name}"


#: Memory of a file's date formats in a broadcast.
FORMAT_BYTES = 128


def with_first_value_formats(
    rows: DataFrame, counted: DataFrame, rules: TableRules, file_key: str, budget: int | None = None
) -> tuple[DataFrame, dict[str, FirstValueParser], DataFrame | None]:
    """X9: the date format of each file's first value, for date columns without a format.

    ``counted``: the same rows before a repartition. One small aggregate gives each file's first
    value of each such column (nulls read as the reference fills them); its format, two
    numbers, is joined to the file's rows. Returns the rows, the parsers that read
    by these columns, and the cached table of formats."""
    rs = [r for r in _checked_rules(rules) if r.type in ("DATE", "DATETIME") and not r.date_format]
    if not rs:
        return rows, {}, None
    firsts = []
    for k, r in enumerate(rs):
        text = checked_input(r, F.col(r.name), rules.null_dates_pass)
        firsts.append(F.min_by(text, F.when(text.isNotNull(), F.col(INDEX))).alias(f"v{k}"))
    files = counted.groupBy(F.col(file_key).alias("_format_file")).agg(*firsts)
    files = files.select("_format_file", *[first_value_format(F.col(f"v{k}")).alias(f"_f_{k}") for k in range(len(rs))])
    files = files.persist(StorageLevel.MEMORY_AND_DISK)
    found = files.agg(F.count(F.lit(1)).alias("n"), *[F.collect_set(F.coalesce(f"_f_{k}.date", F.lit(-1))).alias(f"s{k}") for k in range(len(rs))]).first()
    budget = broadcast_budget(rows.sparkSession) if budget is None else budget
    small = F.broadcast(files) if found["n"] * FORMAT_BYTES <= budget else files
    rows = rows.join(small, F.col(file_key) == F.col("_format_file"), "left").drop("_format_file")
    parsers = {}
    for k, r in enumerate(rs):
        used = set(found[f"s{k}"])
        parsers[r.name] = FirstValueParser(F.col(f"_f_{k}.date"), F.col(f"_f_{k}.time"), tuple(sorted(used - {-1})), -1 in used)
    return rows, parsers, files


def with_parsed(df: DataFrame, rules: TableRules, parsers: dict[str, FirstValueParser] | None = None) -> DataFrame:
    """Add ``_p_<col>`` (parsed value, null when unparsable) for checked columns, and
    ``_i_<col>`` (the bigint) for INTEGER columns.

    The parse runs in stacked projections (prepare -> raw -> final): each
    stage's expensive expression is referenced more than once by the next,
    so the optimizer keeps the stages apart and every value is computed once
    per row instead of once per reference. Texts in a parser's plain form are read by a cast; the
    stages for the others lie in lambdas (see ``seldom``). ``parsers``: those of date columns
    that are read by their file's first value.
    """
    rs = _checked_rules(rules)
    if not rs:
        return df
    by = {r.name: (parsers or {}).get(r.name) or _parser(r) for r in rs}
    prep_cols, raws, refs, plain = {}, {}, {}, {}
    for r in rs:
        text = checked_input(r, F.col(r.name), rules.null_dates_pass)
        parser = by[r.name]
        form = parser.plain(text) if hasattr(parser, "plain") else None
        if form is not None:
            prep_cols[f"_a_{r.name}_t"], prep_cols[f"_a_{r.name}_n"] = form[0], form[1]
            plain[r.name] = parser.plain_value(text, F.col(f"_a_{r.name}_t"), F.col(f"_a_{r.name}_n"))
            continue
        refs[r.name] = {}
        for k, expr in parser.prepare(text).items():
            prep_cols[f"_a_{r.name}_{k}"] = expr
            refs[r.name][k] = F.col(f"_a_{r.name}_{k}")
    df = df.withColumns(prep_cols)
    raws = {f"_r_{r.name}": plain[r.name] if r.name in plain else by[r.name].raw(refs[r.name]) for r in rs}
    df = df.withColumns(raws)
    final = {}
    for r in rs:
        raw = F.col(f"_r_{r.name}")
        if r.name in plain:
            text = checked_input(r, F.col(r.name), rules.null_dates_pass)
            final[parsed_col(r.name)] = F.coalesce(raw.cast("double") if r.type == "INTEGER" else raw, seldom(by[r.name], text))
        else:
            final[parsed_col(r.name)] = by[r.name].final(refs[r.name], raw)
    df = df.withColumns(final)
    whole = {}
    for r in rs:
        if r.type == "INTEGER":
            text, value = F.col(r.name), F.col(parsed_col(r.name))
            odd = F.get(F.transform(F.array(text), lambda t: integral(t, value)), F.lit(0))
            whole[loaded_col(r.name)] = F.when(text.isNotNull(), F.coalesce(f"_r_{r.name}", odd))
    return (df.withColumns(whole) if whole else df).drop(*prep_cols, *raws)


def _checked_rules(rules: TableRules) -> list[ColumnRule]:
    return [r for r in rules.columns if r.name not in LINEAGE_COLUMNS and r.type != "STRING"]


def _violation(reason: Column | str, code: str, col_name: str, value: Column | None) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    value = F.lit(None).cast("string") if value is None else value.cast("string")
    return F.struct(
        reason.alias("invalid_reason"),
        F.lit(code).alias("invalid_code"),
        F.lit(col_name).alias("invalid_col_name"),
        value.alias("invalid_col_value"),
    )


def _checks(rules: TableRules) -> list[tuple[Column, Column]]:
    """(fails, violation struct) per (rule, column), in report order."""
    out = []
    for name in rules.required_columns:
        out.append((F.col(name).isNull(), _violation(REASON_REQUIRED.format(col=name), CODE_NULL, name, None)))
    keys = rules.key_columns
    if keys:
        label = python_list_text(keys)
        head, tail = REASON_KEY.format(cols=label, n="\0").split("\0")
        reason = F.concat(F.lit(head), F.col(KEY_COUNT).cast("string"), F.lit(tail))
        out.append((F.col(KEY_COUNT) > 1, _violation(reason, CODE_KEY, label, key_value_text([F.col(k) for k in keys]))))
    for rule in _checked_rules(rules):
        value = F.col(parsed_col(rule.name))
        if rule.type in ("DATE", "DATETIME") and rules.null_dates_pass:
            fails = F.col(rule.name).isNotNull() & value.isNull()
        else:
            fails = value.isNull()
        reason = REASON_PARSE.format(col=rule.name, type=rule.type)
        out.append((fails, _violation(reason, CODE_PARSE, rule.name, F.col(rule.name))))
    return out


def violation_columns(rules: TableRules) -> list[Column]:
    """One nullable violation struct per (rule, column), in report order."""
    return [F.when(fails, violation) for fails, violation in _checks(rules)]


_NO_VIOLATIONS = "array<struct<invalid_reason:string,invalid_code:string,invalid_col_name:string,invalid_col_value:string>>"


def violations_array(rules: TableRules) -> Column:
    """The violations of a row; the array is only put together for rows that have one."""
    checks = _checks(rules)
    none = F.array().cast(_NO_VIOLATIONS)
    if not checks:
        return none
    some = reduce(Column.__or__, [F.coalesce(fails, F.lit(False)) for fails, _ in checks])
    return F.when(some, F.array_compact(F.array(*violation_columns(rules)))).otherwise(none)


def lost_values(rules: TableRules) -> Column:
    """Cells of a valid row that load as null: numbers that pass the INTEGER test, which
    no bigint holds. An array of violation structs."""
    lost = [
        F.when(
            F.col(r.name).isNotNull() & F.col(loaded_col(r.name)).isNull(),
            _violation(REASON_LOAD.format(col=r.name, type=r.type), CODE_LOAD, r.name, F.col(r.name)),
        )
        for r in _checked_rules(rules) if r.type == "INTEGER"
    ]
    none = F.array().cast(_NO_VIOLATIONS)
    return F.when(F.size(VIOLATIONS) == 0, F.array_compact(F.array(*lost))).otherwise(none) if lost else none


def spread(df: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Round-robin the rows over the cluster when the input is narrower than it.

    The checks are CPU work per row; an input with fewer partitions than task
    slots (a few big files, one parquet row group) would leave cores idle.
    Wide inputs (the large-scale case) are left as they are: no shuffle.
    """
    target = parallelism or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def annotate(
    norm: DataFrame, rules: TableRules, budget: int | None = None, spread_rows: bool | None = False
):
    """Add the ``violations`` array (R1-R4). Returns (frame, cached side tables).

    ``spread_rows``: None decides from the input's partition count (see
    ``spread``), True always repartitions round-robin, False never.
    """
    if spread_rows is None:
        rows = spread(norm)
    elif spread_rows:
        rows = norm.repartition(norm.sparkSession.sparkContext.defaultParallelism)
    else:
        rows = norm
    # Key groups are per file: a compact file id, when the source gives one,
    # keeps the duplicate table small (a path is ~100 bytes per group).
    file_key = FILE_ID if FILE_ID in norm.columns else FILE
    # Free-text keys may be wide (a document as key): count them through
    # hashes so only 16 bytes per row are shuffled (exact, see keys.py).
    wide = any(c.type == "STRING" for c in rules.columns if c.unique_identifier)
    rows, parsers, formats = with_first_value_formats(rows, norm, rules, file_key, budget)
    # Parse above the key-count join: where it shuffles, only the texts travel.
    with_counts, dups = with_key_counts(
        rows, rules.key_columns, file_key, budget, count_from=norm, two_phase=wide,
    )
    parsed = with_parsed(with_counts, rules, parsers).drop(*[f"_f_{k}" for k in range(len(parsers))])
    out = parsed.withColumn(VIOLATIONS, violations_array(rules)).drop(KEY_COUNT, FILE_ID)
    return out, [d for d in (dups, formats) if d is not None]


def _typed(rule: ColumnRule, annotated_cols: set[str]) -> Column:
    """Typed value from the shared parsed column (null text stays null)."""
    text = F.col(rule.name)
    p = parsed_col(rule.name)
    value = F.col(p) if p in annotated_cols else _parser(rule)(text)
    return F.when(text.isNotNull(), value)


def typed_valid(annotated: DataFrame, rules: TableRules, extra: tuple[str, str] | None = None) -> DataFrame:
    """R5 + R6: rows without violations, typed per rule, rule column order.

    ``extra``: names under which the file and its row index come along (O2)."""
    cols = [F.col(c).alias(name) for c, name in zip(("source_filename", "index"), extra)] if extra else []
    have = set(annotated.columns)
    for rule in rules.columns:
        c = F.col(rule.name)
        if rule.name == "execution_datetime":
            cols.append(c.try_cast("timestamp_ntz").alias(rule.name))
        elif rule.type == "STRING":
            cols.append(c.alias(rule.name))
        elif rule.type in ("FLOAT", "FLOAT64"):
            cols.append(_typed(rule, have).alias(rule.name))
        elif rule.type == "INTEGER":
            whole = F.col(loaded_col(rule.name)) if loaded_col(rule.name) in have else integral(c, _typed(rule, have))
            cols.append(whole.alias(rule.name))
        elif rule.type == "DATE":
            cols.append(_typed(rule, have).cast("date").alias(rule.name))
        else:  # DATETIME
            cols.append(_typed(rule, have).alias(rule.name))
    # A row passes when its violations array is empty. Written as a 0-or-1
    # element inline rather than a filter: a filter on the computed array is
    # pushed below the parse projections and would evaluate them twice.
    passed = F.when(F.size(VIOLATIONS) == 0, F.array(F.struct(*cols)))
    return annotated.select(F.inline(passed))
