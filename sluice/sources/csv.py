"""CSV landing scan (S2) with exact per-file ordinals (I1) and file facts (F1, F2).

Every file of a table is read in one scan, all columns as text, plus one
extra column and the raw record (multi-line mode: the CSV reader; line mode:
the text source + ``from_csv``, splittable). From the raw record each row gets
its field count (separators outside quotes) and an unterminated-quote flag;
invalid UTF-8 is found on the raw bytes.

Row ordinals: blank records are dropped, then ``monotonically_increasing_id``
numbers the rows inside each scan block. One small aggregate per (file, block)
gives the block's first id and size; a running sum over the blocks of a file
gives each block's offset. What is joined back is two numbers a block (a 64-bit
key, proven unique, and the shift from row id to ordinal), so that a million
blocks are still broadcast; names are joined per file. No global sort, no
shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import ASCII_SPACE
from ..functions.text import count_char, na_to_null, open_quote, unquoted
from ..rules import TableRules
from ..session import broadcast_budget, ship_code, staged_frame
from .listing import FILE_ID, FILE_URI, PATH, decoded_path, file_id, inputs, reader, relative_name
from .records import ASSEMBLED, FOLDED, assemble, block_states, fold, line_code, whole_records

RAW = "_raw"
EXTRA = "_extra"
RID = "_rid"
BLOCK = "_block"
BLOCK_KEY = "_block_key"
#: Memory of a broadcast row: a long key and one long; a long key and a name.
BLOCK_BYTES, FILE_BYTES = 64, 512
#: Seeds tried until the 64-bit keys of all blocks (or files) differ.
SEEDS = range(8)
REPLACEMENT_CHAR = "�"
#: Files with quoted newlines that are read by name; beyond, all files are read and these picked.
NAMES = 1000


def spark_charset(encoding: str) -> str:
    """Python codec name (as the rules give it, for pandas) -> Spark charset."""
    import codecs

    try:
        name = codecs.lookup(encoding).name  # canonical Python name
    except LookupError:
        return encoding
    return {
        "utf-8": "UTF-8",
        "utf-8-sig": "UTF-8",
        "latin-1": "ISO-8859-1",
        "iso8859-1": "ISO-8859-1",
        "ascii": "US-ASCII",
        "utf-16": "UTF-16",
        "utf-16-be": "UTF-16BE",
        "utf-16-le": "UTF-16LE",
        "utf-32": "UTF-32",
    }.get(name, name)


@dataclass
class CsvScan:
    rows: DataFrame  # source_filename, index, data columns (NA tokens null)
    facts: DataFrame  # _path, header_fields, header_ok, max_fields, open_quote, bad_utf8, n_records, first_fields
    cached: list
    blocks: DataFrame | None = None  # rows per (file, block), cached
    nblocks: int = 0


def block_key(seed: int):
    return F.xxhash64(F.lit(seed), F.col(FILE_ID), F.col(BLOCK))


def _fields(raw_unq, sep: str):
    if len(sep) == 1:
        return count_char(raw_unq, sep) + 1
    return (F.length(raw_unq) - F.length(F.replace(raw_unq, F.lit(sep), F.lit("")))) / len(sep) + 1


def _csv_options(sep: str) -> dict[str, str]:
    return {
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def _without_bom(block: Column) -> Column:
    return F.when(block == 0, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))


def _cells(value: Column, sep: str, text_cols: list[str]) -> Column:
    """The cells of a line, an array. A line without a quote is cut at the separators; only
    lines with quotes go through the CSV parser (in a lambda, so once a line)."""
    parsed = F.from_csv(value, F.lit(", ".join(f"{c} STRING" for c in (*text_cols, EXTRA))), _csv_options(sep))
    quoted = F.get(F.transform(F.array(parsed), lambda s: F.array(*[s[c] for c in text_cols])), F.lit(0))
    literal = "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c for c in sep)
    return F.when(F.instr(value, '"') == 0, F.split(value, literal, -1)).otherwise(quoted)


def _cell(cells: str, i: int) -> Column:
    cell = F.get(F.col(cells), F.lit(i))
    return F.when(cell != "", cell)  # as the CSV parser has it


def _line_is_header(rules: TableRules, raw: Column, sep: str, text_cols: list[str], fields: Column) -> Column:
    """As ``_header_ok``, of a line; only lines that hold the first names are parsed for it."""
    may = fields == len(text_cols)
    for h in [h for h in rules.header if h.isascii() and '"' not in h][:2]:
        may = may & (F.instr(raw, h) > 0)
    parsed = F.from_csv(raw, F.lit(", ".join(f"{c} STRING" for c in (*text_cols, EXTRA))), _csv_options(sep))
    same = lambda s: reduce(Column.__and__, [F.coalesce(s[c] == F.lit(h), F.lit(False)) for c, h in zip(text_cols, rules.header)])
    ok = F.get(F.transform(F.array(parsed), same), F.lit(0))
    return F.when(may, ok & F.lit(rules.header_matchable)).otherwise(F.lit(False))


def _header_ok(rules: TableRules, text_cols: list[str], fields: Column) -> Column:
    """Column by column with short-circuit: a data row fails at its first cell."""
    ok = F.lit(True)
    for c, h in zip(text_cols, rules.header):
        ok = ok & F.coalesce(F.col(c) == F.lit(h), F.lit(False))
    return (fields == len(text_cols)) & ok & F.lit(rules.header_matchable)


def scan_csv(
    spark: SparkSession,
    root: str,
    rules: TableRules,
    sep: str | None = None,
    encoding: str | None = None,
    multi_line: bool = True,
    paths: list[str] | None = None,
    cache_scan: bool = True,
    seed: int = 0,
    skip_open: bool = False,
) -> CsvScan:
    """Scan every CSV landing file of the table once (see module doc).

    ``cache_scan``: the numbered records feed four passes (block table, first
    data row, key sizes, rows). Cached, the files are parsed once; not cached,
    once for each pass, which keeps executor memory and local disk free on very
    large inputs. Either way the ids agree: the same splits give the same ids.
    ``seed`` is that of the listing's file keys. ``skip_open`` leaves out the
    rows of files in which a line ends inside quotes (see ``scan_csv_files``).

    UTF-8 files are validated on their raw bytes: in multi-line mode by an
    extra, splittable line pass, in line mode on the lines themselves. In
    other encodings U+FFFD in the decoded records marks bytes that they lack.
    """
    opts = rules.format_options("csv")
    sep = sep or opts.get("separator") or ","
    encoding = spark_charset(encoding or opts.get("encoding") or "utf-8")
    data = [c.name for c in rules.data_columns]
    n = len(data)
    text_cols = [f"_c{i}" for i in range(n)]
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in (*text_cols, EXTRA, RAW)]
    )
    csv_options = _csv_options(sep)
    line_mode = not multi_line and _is_utf8(encoding)
    if line_mode:
        # One record per line: the text source splits big files into blocks and
        # keeps the raw line; ``_cells`` cuts it as the CSV reader would.
        lines = reader(spark, "csv").text(inputs(root, rules.source_path, paths))
        block = F.col("_metadata.file_block_start")
        value = _without_bom(block)
        df = lines.select(
            _cells(value, sep, text_cols).alias("_cells"),
            value.alias(RAW),
            F.is_valid_utf8("value").alias("_utf8_ok"),
            F.col("_metadata.file_path").alias("_file_path"),
            block.alias("_file_block"),
        )
        df = df.select("*", *[_cell("_cells", i).alias(c) for i, c in enumerate(text_cols)]).drop("_cells")
        bad_utf8 = ~F.col("_utf8_ok")
    else:
        df = (
            reader(spark, "csv")
            .schema(schema)
            .options(**csv_options)
            .option("encoding", encoding)
            .option("header", "false")
            # Spark's line-by-line CSV reader keeps no raw record for short
            # rows, so non-UTF-8 files (no line mode) are read multi-line.
            .option("multiLine", "true")
            .option("columnNameOfCorruptRecord", RAW)
            .csv(inputs(root, rules.source_path, paths))
            .select(
                *text_cols,
                RAW,
                F.col("_metadata.file_path").alias("_file_path"),
                F.col("_metadata.file_block_start").alias("_file_block"),
            )
        )
        # The decoder substitutes U+FFFD for invalid bytes.
        bad_utf8 = F.coalesce(F.instr(F.col(RAW), REPLACEMENT_CHAR) > 0, F.lit(False))
    raw = F.col(RAW)
    unq = unquoted(raw, sep)
    # In the CSV reader a record with exactly n+1 fields fills the extra column
    # and keeps no raw text.
    fields = F.when(raw.isNull(), F.lit(n + 1)).otherwise(_fields(unq, sep)).cast("int")
    if line_mode:
        header_ok = _line_is_header(rules, raw, sep, text_cols, fields)
    else:
        header_ok = _header_ok(rules, text_cols, fields)
    numbered = (
        df.select(
            *text_cols,
            RAW,
            bad_utf8.alias("_bad_utf8"),
            F.col("_file_path").alias(FILE_URI),
            file_id(F.col("_file_path"), seed).alias(FILE_ID),
            F.col("_file_block").alias(BLOCK),
        )
        # Blank and whitespace-only records are not rows (must precede numbering).
        .where(raw.isNull() | (F.btrim(raw, F.lit(ASCII_SPACE)) != ""))
        .select(
            *text_cols,
            FILE_URI,
            FILE_ID,
            BLOCK,
            fields.alias("_fields"),
            F.coalesce(open_quote(unq, sep), F.lit(False)).alias("_open_quote"),
            "_bad_utf8",
            header_ok.alias("_header_ok"),
            F.monotonically_increasing_id().alias(RID),
        )
    )
    if cache_scan:
        numbered = numbered.persist(StorageLevel.MEMORY_AND_DISK)
    # One row per (file, block): map-side combined, so the shuffle is tiny.
    # Per-file texts (decoded path, report name) are computed here, once per block.
    blocks = numbered.groupBy(FILE_ID, FILE_URI, BLOCK).agg(
        F.min(RID).alias("_first"),
        F.count(F.lit(1)).alias("_n"),
        F.min_by("_fields", RID).alias("_first_fields"),
        F.min_by("_header_ok", RID).alias("_first_header_ok"),
        F.max("_fields").alias("_max_fields"),
        F.bool_or("_open_quote").alias("_open_quote"),
        F.bool_or("_bad_utf8").alias("_bad_utf8"),
    )
    w = Window.partitionBy(FILE_URI).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "*",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"),
        F.bool_or("_open_quote").over(Window.partitionBy(FILE_URI)).alias("_file_open"),
        *[block_key(s).alias(f"_k{s}") for s in SEEDS],
        decoded_path(F.col(FILE_URI)).alias(PATH),
    ).withColumn("source_filename", relative_name(F.col(PATH), root))
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    nblocks, nfiles, first_key = blocks.agg(
        F.count(F.lit(1)), F.count_if(F.col("_offset") == 0), F.count_distinct("_k0")
    ).first()
    key = 0
    if first_key < nblocks:  # two blocks share a key: take another seed
        distinct = blocks.agg(*[F.count_distinct(f"_k{s}") for s in SEEDS]).first()
        key = next(s for s in SEEDS if distinct[s] == nblocks)
    budget = broadcast_budget(spark)
    kept = blocks.where(~F.col("_file_open")) if skip_open else blocks
    # ordinal = row id + shift; the header is ordinal -1
    shifts = kept.select(F.col(f"_k{key}").alias(BLOCK_KEY), (F.col("_offset") - F.col("_first") - 1).alias("_shift"))
    shifts = F.broadcast(shifts) if nblocks * BLOCK_BYTES <= budget else shifts
    indexed = (
        numbered.withColumn(BLOCK_KEY, block_key(key)).join(shifts, BLOCK_KEY).drop(BLOCK_KEY)
        .withColumn("index", F.col("_shift") + F.col(RID))
    )
    # File facts. The header is the first record of the first block. pandas
    # takes the first data row's extra fields (if any) as index columns, so a
    # row is too long only beyond max(header, first data row); the first data
    # row is ordinal 0: a pass over the rows, made only if some file holds a row
    # wider than its header.
    # (The coalesce keeps a data column in the query: Spark refuses a raw-file
    # query that reads only the corrupt-record column.)
    facts = kept.groupBy(FILE_ID, PATH).agg(
        F.min_by("_first_fields", BLOCK).alias("header_fields"),
        F.min_by("_first_header_ok", BLOCK).alias("header_ok"),
        F.max("_max_fields").alias("max_fields"),
        F.bool_or("_open_quote").alias("open_quote"),
        F.bool_or("_bad_utf8").alias("bad_utf8"),
        F.sum("_n").alias("n_records"),
    )
    wide = facts.where("max_fields > header_fields").select(FILE_ID)
    if wide.limit(1).count():  # only then does the first data row's width matter
        small = nfiles * BLOCK_BYTES <= budget
        wide = F.broadcast(wide) if small else wide
        first_data = indexed.where(F.col("index") == 0).join(wide, FILE_ID, "left_semi").select(
            FILE_ID, F.coalesce(F.col("_fields"), F.length(text_cols[0])).alias("first_fields")
        )
        facts = facts.join(F.broadcast(first_data) if small else first_data, FILE_ID, "left")
    else:
        facts = facts.withColumn("first_fields", F.lit(None).cast("int"))
    if not _is_utf8(encoding):
        facts = _strictly_decoded(spark, facts, opts.get("encoding") or encoding, paths, inputs(root, rules.source_path, paths))
    if not line_mode and _is_utf8(encoding):
        raw_ok = (
            reader(spark, "csv").text(inputs(root, rules.source_path, paths))
            .groupBy(file_id(F.col("_metadata.file_path"), seed).alias(FILE_ID))
            .agg(F.bool_and(F.is_valid_utf8("value")).alias("_utf8_ok"))
        )
        facts = facts.join(raw_ok, FILE_ID, "left").withColumn(
            "bad_utf8", ~F.coalesce(F.col("_utf8_ok"), F.lit(True))
        ).drop("_utf8_ok")
    rows = indexed.where(F.col("index") >= 0)
    if nfiles * FILE_BYTES <= budget:
        names = blocks.where(F.col("_offset") == 0).select(FILE_ID, "source_filename")
        rows = rows.join(F.broadcast(names), FILE_ID)
    else:  # too many names to broadcast: each row's is made from its URI, nothing is shuffled
        rows = rows.withColumn("source_filename", relative_name(decoded_path(F.col(FILE_URI)), root))
    rows = rows.select(
        FILE_ID,
        "source_filename",
        F.col("index").cast("bigint").alias("index"),
        *[na_to_null(F.col(c)).alias(name) for c, name in zip(text_cols, data)],
    )
    return CsvScan(
        rows=rows, facts=facts.drop(FILE_ID), cached=[numbered, blocks] if cache_scan else [blocks],
        blocks=blocks, nblocks=nblocks,
    )


def _strictly_decoded(spark: SparkSession, facts: DataFrame, codec: str, paths: list[str] | None, everything) -> DataFrame:
    """Facts in which ``bad_utf8`` says whether the bytes of a file that shows U+FFFD lack a character in its encoding."""
    suspects = facts.where("bad_utf8").select(PATH)
    found = [r[PATH] for r in suspects.limit(NAMES + 1).collect()]
    if not found:
        return facts

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = []
            for content in batch.column(1):
                try:
                    content.as_py().decode(codec)
                    bad.append(False)
                except UnicodeDecodeError:
                    bad.append(True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bad, pa.bool_())], names=["s_path", "strictly_bad"])

    few = len(found) <= NAMES
    files = reader(spark, "csv").format("binaryFile").load(inputs("", "", found) if few else everything)
    files = files.select(decoded_path(F.col("_metadata.file_path")).alias("s_path"), "content")
    if not few:  # too many to name: all are listed, the others' bytes go no further
        files = files.join(suspects.select(F.col(PATH).alias("k_path")), F.col("s_path") == F.col("k_path"), "left_semi")
    strict = files.mapInArrow(decoded, "s_path string, strictly_bad boolean")
    facts = facts.join(strict, F.col(PATH) == F.col("s_path"), "left")
    return facts.withColumn("bad_utf8", F.coalesce("strictly_bad", "bad_utf8")).drop("s_path", "strictly_bad")


def _is_utf8(encoding: str) -> bool:
    return encoding.lower().replace("-", "").replace("_", "") == "utf8"


def scan_csv_files(
    spark: SparkSession,
    root: str,
    rules: TableRules,
    paths: list[str] | None = None,
    cache_scan: bool = True,
    seed: int = 0,
    cache_lines: bool = False,
) -> list[CsvScan]:
    """Scans that together hold every CSV file once, each in the mode it needs.

    All files are read by lines first (big files are split). Those in which a
    line ends inside quotes, so that a value may hold a newline, are read by
    ``scan_quoted``, which splits them too. Other encodings than UTF-8 are read
    record by record at once, one task a file.
    """
    encoding = spark_charset(rules.format_options("csv").get("encoding") or "utf-8")
    options = {"cache_scan": cache_scan, "seed": seed}
    if not _is_utf8(encoding):
        return [scan_csv(spark, root, rules, multi_line=True, paths=paths, **options)]
    lines = scan_csv(spark, root, rules, multi_line=False, paths=paths, skip_open=True, cache_scan=cache_lines, seed=seed)
    opened = lines.blocks.where("_file_open").select(FILE_ID, PATH).distinct()
    found = opened.limit(NAMES + 1).collect()
    if not found:
        return [lines]
    if len(found) <= NAMES:  # a few: the others are not read again
        paths, opened = [r[PATH] for r in found], None
    return [lines, scan_quoted(spark, root, rules, paths, opened, cache_scan, seed)]


def scan_quoted(
    spark: SparkSession,
    root: str,
    rules: TableRules,
    paths: list[str] | None,
    opened: DataFrame | None = None,
    cache_scan: bool = True,
    seed: int = 0,
) -> CsvScan:
    """Scan of UTF-8 files whose values may hold newlines; big files are split all the same.

    The lines are read twice. First each line becomes a function of the reader's state (inside quotes or
    not), composed per block (see ``records``): one row a block says whether it starts inside
    quotes and how many records start before it. Then each block's lines are put
    together to records, numbered as they come; only records that cross blocks meet, in pieces. Files
    that end inside quotes are unreadable: their records are not built.

    ``opened``: the ids of the files, of those that the paths or the prefix name."""
    ship_code(spark)
    sep = rules.format_options("csv").get("separator") or ","
    data = [c.name for c in rules.data_columns]
    text_cols = [f"_c{i}" for i in range(len(data))]
    budget = broadcast_budget(spark)
    block = F.col("_metadata.file_block_start")
    uri = F.col("_metadata.file_path")
    value = _without_bom(block)
    lines = reader(spark, "csv").text(inputs(root, rules.source_path, paths)).select(
        file_id(uri, seed).alias(FILE_ID), block.alias(BLOCK), uri.alias(FILE_URI), value.alias("value"),
        (~F.is_valid_utf8("value")).alias("bad"),  # of the bytes as read: text functions mend them
    )
    in_order = True
    if opened is not None:
        ids = opened.select(FILE_ID)
        if opened.count() * BLOCK_BYTES <= budget:
            lines = lines.join(F.broadcast(ids), FILE_ID, "left_semi")
        else:  # a shuffle: lines are put in order again
            lines = lines.withColumn(RID, F.monotonically_increasing_id()).join(ids, FILE_ID, "left_semi").sortWithinPartitions(FILE_ID, BLOCK, RID)
            in_order = False
    ends_in = open_quote(unquoted(F.col("value"), sep), sep)
    stays_in = open_quote(unquoted(F.concat(F.lit('"'), F.col("value")), sep), sep)
    code = line_code(F.col("value"), ends_in, stays_in, F.btrim("value", F.lit(ASCII_SPACE)) == "", F.col("bad"))
    coded = lines.select(FILE_ID, BLOCK, FILE_URI, code.alias("code"), "value", *([] if in_order else [RID]))
    blocks = staged_frame(block_states(coded.select(FILE_ID, BLOCK, FILE_URI, "code").mapInArrow(fold, FOLDED)), "csv-blocks")
    nblocks = blocks.count()
    small = nblocks * BLOCK_BYTES <= budget
    entries = blocks.where("NOT file_open").select(F.col("file_id").alias("e_id"), F.col("block").alias("e_block"), "entry", "offset")
    same = (F.col(FILE_ID) == F.col("e_id")) & (F.col(BLOCK) == F.col("e_block"))
    if small:
        entered = coded.join(F.broadcast(entries), same)
    else:  # lines meet their block's row by a shuffle and are put in order again
        coded = coded.withColumn(RID, F.monotonically_increasing_id()) if in_order else coded
        entered = coded.join(entries, same).sortWithinPartitions(FILE_ID, BLOCK, RID)
    built = entered.select(FILE_ID, BLOCK, FILE_URI, "code", "value", "entry", "offset").mapInArrow(assemble, ASSEMBLED)
    cached = [blocks]
    if cache_scan:
        built = built.persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(built)
    ddl = ", ".join(f"{c} STRING" for c in (*text_cols, EXTRA))
    parsed = F.from_csv("raw", F.lit(ddl), _csv_options(sep))
    records = whole_records(built, "\n").select(
        F.col("file_id").alias(FILE_ID), F.col("uri").alias(FILE_URI), (F.col("ordinal") - 1).alias("index"), "bad",
        _fields(unquoted(F.col("raw"), sep), sep).cast("int").alias("_fields"), *[parsed[c].alias(c) for c in text_cols],
    )
    heads = records.withColumn("_header_ok", _header_ok(rules, text_cols, F.col("_fields"))).groupBy(FILE_ID).agg(
        F.max(F.when(F.col("index") == -1, F.col("_fields"))).alias("header_fields"),
        F.bool_or(F.when(F.col("index") == -1, F.col("_header_ok"))).alias("header_ok"),
        F.max(F.when(F.col("index") == 0, F.col("_fields"))).alias("first_fields"),
        F.max("_fields").alias("max_fields"),
    )
    files = blocks.groupBy(F.col("file_id").alias("f_id"), "uri").agg(
        F.sum("n").alias("n_records"), F.bool_or("file_open").alias("open_quote"), F.bool_or("bad").alias("bad_utf8")
    ).where("n_records > 0").withColumn(PATH, decoded_path(F.col("uri"))).withColumn("source_filename", relative_name(F.col(PATH), root))
    files = staged_frame(files, "csv-files")
    cached.append(files)
    facts = files.join(heads, F.col("f_id") == F.col(FILE_ID), "left").select(
        PATH, "header_fields", "header_ok", "max_fields", "open_quote", "bad_utf8", "n_records", "first_fields"
    )
    rows = records.where("index >= 0")
    if files.count() * FILE_BYTES <= budget:
        rows = rows.join(F.broadcast(files.select(F.col("f_id").alias(FILE_ID), "source_filename")), FILE_ID)
    else:
        rows = rows.withColumn("source_filename", relative_name(decoded_path(F.col(FILE_URI)), root))
    rows = rows.select(
        FILE_ID, "source_filename", F.col("index").cast("bigint").alias("index"),
        *[na_to_null(F.col(c)).alias(name) for c, name in zip(text_cols, data)],
    )
    return CsvScan(rows=rows, facts=facts, cached=cached, blocks=blocks.select(F.col("n").alias("_n")), nblocks=nblocks)
