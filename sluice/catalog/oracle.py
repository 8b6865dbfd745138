"""DuckDB SQL for the same checks, written from a rule set.

This is the independent side of the correctness gate: plain SQL (window
count for keys, UNION ALL of per-rule selects, try_strptime for dates) over
a text CTE that the caller writes by hand for each driver table.
"""

from __future__ import annotations

from ..rules import LINEAGE_COLUMNS, ColumnRule, TableRules

# --- fixed values, written out here so that a wrong text in the engine shows ---
CODE_NULL = "NULL_VALUE_NOT_EXPECTED"
CODE_KEY = "KEY_NOT_UNIQUE"
CODE_PARSE = "COLUMN_NOT_PARSABLE"
CODE_LOAD = "VALUE_NOT_LOADABLE"
REASON_LOAD = "{col} holds a number that cannot be loaded as {type}"
REASON_REQUIRED = "{col} is NULL whereas it is REQUIRED"
REASON_KEY = "{cols} is not unique : {n} occurences"
REASON_PARSE = "{col} is not parsable to {type}"
NULL_NUMBER_TEXT = "0"
NULL_DATE_TEXT = "1900-01-01"
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# -------------------------------------------------------------------------------


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def ident(s: str) -> str:
    return '"' + s.replace('"', '""') + '"'


NUM_RX = r"\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*"
INF_RX = r"\s*[+-]?(?i:inf|infinity)\s*"


def sql_number(x: str) -> str:
    d = f"TRY_CAST(trim({x}) AS DOUBLE)"
    return (
        f"(CASE WHEN regexp_full_match({x}, {q(NUM_RX)}) AND "
        f"(NOT isinf({d}) OR regexp_full_match({x}, {q(INF_RX)})) THEN {d} END)"
    )


def sql_float(x: str, th: str | None, dec: str | None) -> str:
    if th is not None:
        x = f"replace({x}, {q(th)}, '')"
    if dec is not None:
        x = f"replace({x}, {q(dec)}, '.')"
    return sql_number(x)


def sql_integer(x: str) -> str:
    return f"(CASE WHEN NOT regexp_full_match({x}, '[0-9]*[.,][1-9]+') THEN {sql_number(x)} END)"


def sql_bigint(x: str) -> str:
    """The integer that a number's text says, from the text: a double would lose digits."""
    d, e = sql_integer(x), f"TRY_CAST(trim({x}) AS DECIMAL(38,9))"
    return f"(CASE WHEN {d} IS NOT NULL AND {e} = floor({e}) THEN TRY_CAST({e} AS BIGINT) END)"


def sql_datetime(x: str, fmt: str | None) -> str:
    if fmt is None:
        return f"TRY_CAST({x} AS TIMESTAMP)"
    ts = f"try_strptime({x}, {q(fmt)})"
    return (
        f"(CASE WHEN {ts} BETWEEN TIMESTAMP '1677-09-21 00:12:43.145225' "
        f"AND TIMESTAMP '2262-04-11 23:47:16.854775' THEN {ts} END)"
    )


def sql_value(rule: ColumnRule, x: str) -> str:
    t = rule.type
    if t in ("FLOAT", "FLOAT64"):
        return sql_float(x, rule.float_thousand_separator, rule.float_decimal_separator)
    if t == "INTEGER":
        return sql_integer(x)
    if t in ("DATE", "DATETIME"):
        return sql_datetime(x, rule.date_format)
    return x


def sql_fails(rule: ColumnRule, null_dates_pass: bool) -> str | None:
    c = ident(rule.name)
    if rule.type == "STRING":
        return None
    if rule.type in ("DATE", "DATETIME"):
        if null_dates_pass:
            return f"({c} IS NOT NULL AND {sql_value(rule, c)} IS NULL)"
        return f"({sql_value(rule, f'coalesce({c}, {q(NULL_DATE_TEXT)})')} IS NULL)"
    return f"({sql_value(rule, f'coalesce({c}, {q(NULL_NUMBER_TEXT)})')} IS NULL)"


def na_null(x: str) -> str:
    return f"(CASE WHEN {x} IN ({', '.join(q(t) for t in NA_TOKENS)}) THEN NULL ELSE {x} END)"


def ctes(rules: TableRules, text_sql: str, ingest_ts: str) -> str:
    """CTEs t (text), n (normalised), k (key counts), v (violations)."""
    data = [c.name for c in rules.data_columns]
    all_null = " AND ".join(f"{ident(c)} IS NULL" for c in data)
    norm_cols = ", ".join(f"replace({ident(c)}, chr(10), ' ') AS {ident(c)}" for c in data)
    keys = rules.key_columns
    key_count = (
        f"count(*) OVER (PARTITION BY source_filename, {', '.join(ident(k) for k in keys)})"
        if keys
        else "CAST(NULL AS BIGINT)"
    )
    parts = []
    for name in rules.required_columns:
        if name in LINEAGE_COLUMNS:
            continue
        parts.append(
            f"SELECT source_filename, \"index\", {q(REASON_REQUIRED.format(col=name))} AS r, "
            f"{q(CODE_NULL)} AS c, {q(name)} AS cn, CAST(NULL AS VARCHAR) AS cv FROM k "
            f"WHERE {ident(name)} IS NULL"
        )
    if keys:
        label = "[" + ", ".join(repr(k) for k in keys) + "]"
        sep = " || " + q("','") + " || "
        value = sep.join(f"coalesce({ident(k)}, 'nan')" for k in keys)
        head, tail = REASON_KEY.format(cols=label, n="\0").split("\0")
        parts.append(
            f"SELECT source_filename, \"index\", {q(head)} || CAST(_key_count AS VARCHAR) "
            f"|| {q(tail)} AS r, {q(CODE_KEY)} AS c, {q(label)} AS cn, "
            f"'[''' || {value} || ''']' AS cv FROM k WHERE _key_count > 1"
        )
    for rule in rules.columns:
        if rule.name in LINEAGE_COLUMNS:
            continue
        f = sql_fails(rule, rules.null_dates_pass)
        if f is None:
            continue
        parts.append(
            f"SELECT source_filename, \"index\", {q(REASON_PARSE.format(col=rule.name, type=rule.type))} AS r, "
            f"{q(CODE_PARSE)} AS c, {q(rule.name)} AS cn, {ident(rule.name)} AS cv FROM k WHERE {f}"
        )
    if not parts:
        parts.append(
            "SELECT source_filename, \"index\", CAST(NULL AS VARCHAR) AS r, CAST(NULL AS VARCHAR) AS c, "
            "CAST(NULL AS VARCHAR) AS cn, CAST(NULL AS VARCHAR) AS cv FROM k WHERE false"
        )
    union = "\n  UNION ALL ".join(parts)
    return (
        f"WITH t AS ({text_sql}),\n"
        f"n AS (SELECT source_filename, CAST(\"index\" AS BIGINT) AS \"index\", {norm_cols}, "
        f"{q(ingest_ts)} AS execution_datetime FROM t WHERE NOT ({all_null})),\n"
        f"k AS (SELECT *, {key_count} AS _key_count FROM n),\n"
        f"v AS ({union})\n"
    )


def data_invalid_sql(rules, text_sql, ingest_ts, pipeline, dataset, table, where: str | None = None,
                     columns: list[str] | None = None) -> str:
    cols = columns or [
        f"{q(pipeline)} AS pipeline", f"{q(dataset)} AS dataset", f"{q(table)} AS \"table\"",
        "source_filename", "\"index\"", "r AS invalid_reason", "c AS invalid_code",
        "cn AS invalid_col_name", "cv AS invalid_col_value",
        f"CAST({q(ingest_ts)} AS TIMESTAMP) AS date_ingest",
    ]
    w = f" WHERE {where}" if where else ""
    return ctes(rules, text_sql, ingest_ts) + f"SELECT {', '.join(cols)} FROM v{w}"


REPORT_COLS = [
    "source_filename", "\"index\"", "r AS invalid_reason", "c AS invalid_code",
    "cn AS invalid_col_name", "cv AS invalid_col_value",
]


def not_loadable_sql(rules, text_sql, ingest_ts) -> str:
    """Cells of valid rows whose number no bigint holds."""
    parts = [
        f"SELECT source_filename, \"index\", {q(REASON_LOAD.format(col=r.name, type=r.type))} AS invalid_reason, {q(CODE_LOAD)} AS invalid_code, "
        f"{q(r.name)} AS invalid_col_name, {ident(r.name)} AS invalid_col_value FROM good "
        f"WHERE {ident(r.name)} IS NOT NULL AND {sql_bigint(ident(r.name))} IS NULL"
        for r in rules.columns if r.type == "INTEGER"
    ]
    return ctes(rules, text_sql, ingest_ts) + (
        ", good AS (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.source_filename = k.source_filename "
        "AND v.\"index\" = k.\"index\"))\n" + " UNION ALL ".join(parts)
    )


def rows_stats_sql(rules, text_sql, ingest_ts, pipeline, dataset, table,
                   file_col: str = "k.source_filename") -> str:
    return ctes(rules, text_sql, ingest_ts) + (
        "SELECT " + f"{q(pipeline)} AS pipeline, {q(dataset)} AS dataset, {q(table)} AS \"table\", "
        f"{file_col}, CAST({q(ingest_ts)} AS TIMESTAMP) AS date_ingest, "
        "count(*) FILTER (WHERE f.\"index\" IS NULL) AS nb_valid_lines, "
        "count(*) FILTER (WHERE f.\"index\" IS NOT NULL) AS nb_invalid_lines, "
        f"count(*) FILTER (WHERE f.has_null) AS nb_invalid_lines_{CODE_NULL}, "
        f"count(*) FILTER (WHERE f.has_key) AS nb_invalid_lines_{CODE_KEY}, "
        f"count(*) FILTER (WHERE f.has_parse) AS nb_invalid_lines_{CODE_PARSE} "
        "FROM k LEFT JOIN (SELECT source_filename, \"index\", "
        f"bool_or(c = {q(CODE_NULL)}) AS has_null, bool_or(c = {q(CODE_KEY)}) AS has_key, "
        f"bool_or(c = {q(CODE_PARSE)}) AS has_parse FROM v GROUP BY source_filename, \"index\") f "
        "ON k.source_filename = f.source_filename AND k.\"index\" = f.\"index\" "
        "GROUP BY k.source_filename"
    )


def valid_sql(rules: TableRules, text_sql, ingest_ts, replace: dict[str, str] | None = None) -> str:
    cols = []
    for rule in rules.columns:
        c = ident(rule.name)
        if replace and rule.name in replace:
            cols.append(replace[rule.name])
        elif rule.name == "execution_datetime":
            cols.append(f"CAST({c} AS TIMESTAMP) AS {c}")
        elif rule.type == "STRING":
            cols.append(c)
        elif rule.type in ("FLOAT", "FLOAT64"):
            cols.append(f"{sql_value(rule, c)} AS {c}")
        elif rule.type == "INTEGER":
            cols.append(f"{sql_bigint(c)} AS {c}")
        elif rule.type == "DATE":
            cols.append(f"CAST({sql_value(rule, c)} AS DATE) AS {c}")
        else:
            cols.append(f"{sql_value(rule, c)} AS {c}")
    return ctes(rules, text_sql, ingest_ts) + (
        f"SELECT {', '.join(cols)} FROM k WHERE NOT EXISTS (SELECT 1 FROM v "
        "WHERE v.source_filename = k.source_filename AND v.\"index\" = k.\"index\")"
    )


def normalised_sql(rules: TableRules, text_sql, ingest_ts, columns: list[str]) -> str:
    return ctes(rules, text_sql, ingest_ts) + f"SELECT {', '.join(columns)} FROM n"
