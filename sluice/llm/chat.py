"""Chat formatting by schema fingerprints (DataFrame expressions only).

A record's layout is the set of nested field paths it fills. The paths are
hashed; the hash selects a declarative mapping that turns the record into
canonical turns (role, text). Turns are rendered with control strings as
markers; a control string inside a text or role gets a backslash after its
first character, which reading back removes.

Layouts: message rows, message lists, prompt / response pairs, instruction
records with or without input. A record of an unknown layout keeps its row,
with no turns and a null layout.

Defined results: a null text or role is empty; rows of one conversation are
ordered by turn (nulls first), then role, then text; repeated rows are repeated
turns; a null conversation id is one conversation; an empty table gives no row.
A conversation is one training sample and becomes one row.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from .common import let

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that trainers treat as control tokens; none may appear in a text as such.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_REST = "|".join(sorted("".join("\\" + x if x in "|[]<>/" else x for x in c[1:]) for c in CONTROL))
_CONTROL = rf"([<\[])(\\*)(?=(?:{_REST}))"
_ESCAPED = rf"([<\[])\\(\\*)(?=(?:{_REST}))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def escape_role(role: Column) -> Column:
    """A role is one line: percent signs and newlines are written %25 and %0A."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


# --- layouts ---------------------------------------------------------------

TURN = "struct<ord:bigint,role:string,text:string>"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _turn(ord_: Column, role: Column, text: Column) -> Column:
    return F.struct(ord_.cast("long").alias("ord"), _text(role).alias("role"), _text(text).alias("text"))


@dataclass(frozen=True)
class Layout:
    """Field paths (``[]`` marks list elements) and how they become turns."""

    name: str
    paths: frozenset[str]
    turns: Callable[[Callable[[str], Column]], Column]

    @property
    def fingerprint(self) -> str:
        return hashlib.md5("\n".join(sorted(self.paths)).encode()).hexdigest()


def _pair(user: str, assistant: str, context: str | None = None):
    def turns(col):
        ask = _text(col(user)) if context is None else F.concat_ws("\n\n", col(user), col(context))
        return F.array(_turn(F.lit(0), F.lit("user"), ask), _turn(F.lit(1), F.lit("assistant"), col(assistant)))
    return turns


def _list(field: str, role: str, text: str):
    return lambda col: F.transform(col(field), lambda m, i: _turn(i, m[role], m[text]))


LAYOUTS: tuple[Layout, ...] = (
    Layout("message_rows", frozenset({"turn", "role", "text"}), lambda col: F.array(_turn(col("turn"), col("role"), col("text")))),
    Layout("messages", frozenset({"messages[].role", "messages[].content"}), _list("messages", "role", "content")),
    Layout("conversations", frozenset({"conversations[].from", "conversations[].value"}), _list("conversations", "from", "value")),
    Layout("prompt_response", frozenset({"prompt", "response"}), _pair("prompt", "response")),
    Layout("prompt_completion", frozenset({"prompt", "completion"}), _pair("prompt", "completion")),
    Layout("instruction", frozenset({"instruction", "output"}), _pair("instruction", "output")),
    Layout("instruction_input", frozenset({"instruction", "input", "output"}), _pair("instruction", "output", "input")),
)


def field_paths(kind: DataType, prefix: str = "") -> list[str]:
    """Leaf paths of a type, list elements marked by ``[]``."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, ArrayType):
        return field_paths(kind.elementType, prefix + "[]")
    return [prefix]


def fingerprint(schema: StructType, fields: Sequence[str]) -> Column:
    """Hash of the sorted paths of those top-level fields that the record fills.

    Fields in ``always`` positions of a typed table (message rows) may be null
    in a record: a table with one layout only is recognised by its schema."""
    parts = sorted((p, f) for f in fields for p in field_paths(schema[f].dataType, f))
    filled = [F.when(F.col(f"`{f}`").isNotNull(), F.lit(p)) for p, f in parts]
    return F.md5(F.concat_ws("\n", *filled).cast("binary"))


def canonical(records: DataFrame, keep: Sequence[str], layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``keep`` columns plus (layout, turns): each record by its own layout.

    If all fields besides ``keep`` together are one known layout, it holds for
    every record, nulls included; else a record's filled fields decide."""
    fields = [f.name for f in records.schema if f.name not in keep]
    known = {p for x in layouts for p in x.paths}
    fields = [f for f in fields if any(p in known for p in field_paths(records.schema[f].dataType, f))]
    schema_paths = frozenset(p for f in fields for p in field_paths(records.schema[f].dataType, f))
    col = lambda f: F.col(f"`{f}`")
    whole = next((x for x in layouts if x.paths == schema_paths), None)
    if whole is not None:
        mark = F.lit(whole.fingerprint)
    else:
        mark = fingerprint(records.schema, fields) if fields else F.lit("")
    able = [x for x in layouts if x.paths <= schema_paths]
    empty = F.array().cast(f"array<{TURN}>")
    layout, turns = F.lit(None).cast("string"), empty
    for x in able:
        here = mark == x.fingerprint
        layout = F.when(here, F.lit(x.name)).otherwise(layout)
        turns = F.when(here, F.coalesce(x.turns(col).cast(f"array<{TURN}>"), empty)).otherwise(turns)
    return records.select(*[col(k) for k in keep], layout.alias("layout"), turns.alias("turns"))


# --- template ----------------------------------------------------------------


def render(turns: Column) -> Column:
    """Segments (text, loss) whose texts joined are the formatted sample; the
    loss mask covers each assistant text and nothing else."""
    def one(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        )
    return F.flatten(F.transform(turns, one))


def format_conversations(messages: DataFrame, conv_id: str = "conv_id", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """One row per conversation: (conv_id, formatted, segments).

    Works for message rows (several records of a conversation) and for record
    tables (one record each) alike."""
    records = canonical(messages, [conv_id], layouts)
    joined = records.select(F.col(f"`{conv_id}`").alias("conv_id"), F.explode_outer("turns").alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("turns")
    )
    return joined.select("conv_id", render(F.col("turns")).alias("segments")).select(
        "conv_id", F.array_join("segments.text", "").alias("formatted"), "segments"
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted sample."""
    blocks = F.slice(F.split(formatted, "<\\|im_start\\|>"), 2, 2_000_000_000)

    def turn(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        size = F.length(b) - F.length(role) - 1 - len(END) - 1
        return F.struct(
            unescape_role(role).alias("role"), unescape(F.substring(b, F.length(role) + 2, size)).alias("text")
        )

    return F.transform(blocks, turn)


def query(conversations: DataFrame) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    spark = conversations.sparkSession
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    out = format_conversations(conversations.select("conv_id", "turn", "role", "text").unionByName(extra))
    lines = F.transform(F.col("back"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return out.select("conv_id", "formatted", "segments", read_back(F.col("formatted")).alias("back"), learnt.alias("learnt")).select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g') AS etext,
    regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g') AS erole
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(erole) + length(etext) + 24)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
