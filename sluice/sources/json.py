"""JSON landing scan (S3): one JSON array of objects per file.

A file of up to SPLIT_BYTES is one text row (``wholetext``), parsed once with
``from_json`` to ``array<map<string,string>>``: values stay text, key order is
kept, and the array position is the row ordinal. A document that is not an array
of objects parses to null: the file is unreadable.

Larger files are read by many tasks (``scan_split_json``): the text source ends its
rows at closing braces, and what lies between two of them tells how it turns the
reader's state and depth (see ``records``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import count_char
from ..rules import TableRules
from ..session import broadcast_budget, ship_code, staged_frame
from .listing import FILE_ID, PATH, decoded_path, file_id, inputs, reader, relative_name
from .records import ASSEMBLED, SEGMENTS, assemble_segments, fold_segments, segment_blocks, whole_records

ARR = "_arr"
#: Files up to this size are parsed whole, one task each.
SPLIT_BYTES = 64 * 1024 * 1024
#: Single quotes are no JSON.
STRICT = {"allowSingleQuotes": "false"}
#: Memory of a block's row, or a file's, in a broadcast.
BLOCK_BYTES, FILE_BYTES = 96, 512


@dataclass
class JsonScan:
    rows: DataFrame  # _path, source_filename, index, data columns
    facts: DataFrame  # _path, parse_ok, bad_utf8, header_ok, header_fields
    cached: list


def _last(members: Column, name: str) -> Column:
    """Value of a member; of several with the name, the last one's."""
    return F.try_element_at(F.filter(F.map_entries(members), lambda e: e["key"] == name), F.lit(-1))["value"]


def scan_json_files(
    spark: SparkSession, root: str, rules: TableRules, paths: list[str] | None, biggest: int, cache_scan: bool = True, seed: int = 0,
    split_bytes: int = SPLIT_BYTES,
) -> list[JsonScan]:
    """Scans that together hold every JSON file once; ``biggest``: the largest one's bytes."""
    if biggest <= split_bytes:
        return [scan_json(spark, root, rules, paths, cache_scan, seed, split_bytes)]
    return [scan(spark, root, rules, paths, cache_scan, seed, split_bytes) for scan in (scan_json, scan_split_json)]


def scan_json(
    spark: SparkSession,
    root: str,
    rules: TableRules,
    paths: list[str] | None = None,
    cache_scan: bool = True,
    seed: int = 0,
    split_bytes: int = SPLIT_BYTES,
) -> JsonScan:
    """The files up to the split size, one task each."""
    # inside brackets of our own the parser meets what follows the document, too
    within = F.concat(F.lit("["), F.regexp_replace("value", "^\ufeff", ""), F.lit("]"))
    documents = F.from_json(within, "array<array<map<string,string>>>", STRICT)
    docs = (
        reader(spark, "json")
        .text(inputs(root, rules.source_path, paths), wholetext=True)  # text() resets the option of that name
        .where(F.col("_metadata.file_size") <= split_bytes)
        .select(
            decoded_path(F.col("_metadata.file_path")).alias(PATH),
            file_id(F.col("_metadata.file_path"), seed).alias(FILE_ID),
            F.is_valid_utf8("value").alias("_utf8_ok"),
            documents.alias("_documents"),
        )
        .select(PATH, FILE_ID, "_utf8_ok", F.when(F.size("_documents") == 1, F.get("_documents", 0)).alias(ARR))
    )
    cached = []
    if cache_scan:  # facts, key sizes and checks read the parsed documents
        docs = docs.persist(StorageLevel.MEMORY_AND_DISK)
        cached = [docs]
    # Columns in order of first appearance across the records.
    keys = F.array_distinct(
        F.flatten(F.transform(F.col(ARR), lambda m: F.coalesce(F.map_keys(m), F.array().cast("array<string>"))))
    )
    expected = F.array(*[F.lit(h) for h in rules.header])
    facts = docs.select(
        PATH,
        F.col(ARR).isNotNull().alias("parse_ok"),
        (~F.col("_utf8_ok")).alias("bad_utf8"),
        (F.coalesce(keys == expected, F.lit(False)) & F.lit(rules.header_matchable)).alias("header_ok"),
        F.size(keys).alias("header_fields"),
    )
    data = rules.data_columns
    rows = docs.select(PATH, FILE_ID, F.posexplode(ARR).alias("index", "_m")).select(
        FILE_ID,
        relative_name(F.col(PATH), root).alias("source_filename"),
        F.col("index").cast("bigint").alias("index"),
        *[_last(F.col("_m"), c.expected_file_name).alias(c.name) for c in data],
    )
    return JsonScan(rows=rows, facts=facts, cached=cached)


def _segment_columns(value: Column) -> dict[str, Column]:
    """What a segment does to the state and the depth; the segment ends before a closing brace."""
    plain = F.when(F.instr(value, "\\") > 0, F.regexp_replace(value, r"(?s)\\.", "")).otherwise(value)
    flip = count_char(plain, '"') % 2
    outside = lambda text: F.when(F.instr(text, '"') > 0, F.regexp_replace(text, '"[^"]*+(?:"|\\z)', "")).otherwise(text)
    deeper = lambda text: count_char(text, "{") + count_char(text, "[") - count_char(text, "]")
    return {
        "flip": flip.cast("int"),
        "d_out": (deeper(outside(plain)) - (1 - flip)).cast("long"),  # the brace counts if it is outside
        "d_in": (deeper(outside(F.concat(F.lit('"'), plain))) - flip).cast("long"),
    }


def scan_split_json(
    spark: SparkSession,
    root: str,
    rules: TableRules,
    paths: list[str] | None = None,
    cache_scan: bool = True,
    seed: int = 0,
    split_bytes: int = SPLIT_BYTES,
) -> JsonScan:
    """The files beyond the split size, each read by as many tasks as it has blocks.

    First pass: one row a block says how it turns the state and depth, and how many members of the
    array end in it. Second pass: members are put together and numbered where they lie; one that crosses
    blocks meets in pieces. Each member is then parsed on its own. The file is an array of
    objects if the depth comes out, every member begins with its bracket or comma and parses, and only the
    closing bracket follows; else nothing of it is built or used."""
    ship_code(spark)
    budget = broadcast_budget(spark)
    uri, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    value = F.when(block == 0, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    text = reader(spark, "json").option("lineSep", "}").text(inputs(root, rules.source_path, paths)).where(F.col("_metadata.file_size") > split_bytes)
    segments = text.select(
        file_id(uri, seed).alias("file_id"), block.alias("block"), uri.alias("uri"), value.alias("value"), (~F.is_valid_utf8("value")).alias("bad")
    )
    segments = segments.select("file_id", "block", "uri", *[c.alias(n) for n, c in _segment_columns(F.col("value")).items()], "value", "bad")
    blocks = segment_blocks(segments.select("file_id", "block", "uri", "flip", "d_out", "d_in", "bad").mapInArrow(fold_segments, SEGMENTS))
    blocks = staged_frame(blocks, "json-blocks")
    # after the last bracket the depth is 0; the segment that ends with the file has no brace to count
    even = ~F.col("open") & (F.col("last_depth") == -1)
    entries = blocks.where(even).select(F.col("file_id").alias("e_id"), F.col("block").alias("e_block"), "entry", "depth", "offset")
    same = (F.col("file_id") == F.col("e_id")) & (F.col("block") == F.col("e_block"))
    if blocks.count() * BLOCK_BYTES <= budget:
        entered = segments.join(F.broadcast(entries), same)
    else:
        entered = segments.withColumn("_rid", F.monotonically_increasing_id()).join(entries, same).sortWithinPartitions("file_id", "block", "_rid")
    built = entered.select("file_id", "block", "uri", "flip", "d_out", "d_in", "value", "entry", "depth", "offset").mapInArrow(assemble_segments, ASSEMBLED)
    cached = [blocks]
    if cache_scan:
        built = built.persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(built)
    members = whole_records(built, "}").withColumn("body", F.regexp_replace("raw", r"^\s*[\[,]\s*", ""))
    files = blocks.groupBy(F.col("file_id").alias("f_id"), "uri").agg(
        F.max("total").alias("total"), F.bool_and(even).alias("even"), F.bool_or("bad").alias("bad_utf8")
    ).withColumn(PATH, decoded_path(F.col("uri")))
    files = staged_frame(files, "json-files")
    cached.append(files)
    few = files.count() * FILE_BYTES <= budget
    totals = files.select("f_id", "total", relative_name(F.col(PATH), root).alias("source_filename"))
    members = members.join(F.broadcast(totals) if few else totals, F.col("file_id") == F.col("f_id"))
    last = F.col("ordinal") == F.col("total")
    begins = F.when(F.col("ordinal") == 0, F.col("raw").rlike(r"^\s*\[\s*\{")).otherwise(F.col("raw").rlike(r"^\s*,\s*\{"))
    closes = F.when(F.col("total") == 0, F.col("raw").rlike(r"^\s*\[\s*\]\s*\z")).otherwise(F.col("raw").rlike(r"^\s*\]\s*\z"))
    parsed = members.select("f_id", "ordinal", last.alias("last"), begins.alias("begins"), closes.alias("closes"), F.from_json("body", "map<string,string>", STRICT).alias("m"))
    fine = F.when(F.col("last"), F.col("closes")).otherwise(F.col("begins") & F.col("m").isNotNull())
    # one pass parses the members: a row for each list of names that a file's members have
    shapes = parsed.groupBy("f_id", F.when(~F.col("last"), F.map_keys("m")).alias("names")).agg(F.min("ordinal").alias("ordinal"), F.bool_and(fine).alias("fine"))
    shapes = staged_frame(shapes, "json-shapes")
    cached.append(shapes)
    sound = shapes.groupBy(F.col("f_id").alias("s_id")).agg(F.bool_and("fine").alias("sound"))
    # the columns in order of first appearance are the header's
    keys = shapes.select("f_id", "ordinal", F.posexplode("names").alias("place", "name"))
    keys = keys.groupBy("f_id", "name").agg(F.min(F.struct("ordinal", "place")).alias("first"))
    heads = list(dict.fromkeys(rules.header))
    firsts = keys.groupBy(F.col("f_id").alias("k_id")).agg(
        F.count(F.lit(1)).alias("n_keys"), *[F.min(F.when(F.col("name") == h, F.col("first"))).alias(f"h{i}") for i, h in enumerate(heads)]
    )
    in_order = F.col("n_keys") == len(rules.header)
    for i in range(len(heads)):
        in_order = in_order & F.col(f"h{i}").isNotNull() & (F.col(f"h{i - 1}") < F.col(f"h{i}") if i else F.lit(True))
    facts = files.join(sound, F.col("f_id") == F.col("s_id"), "left").join(firsts, F.col("f_id") == F.col("k_id"), "left").select(
        PATH, (F.col("even") & F.coalesce("sound", F.lit(False))).alias("parse_ok"), "bad_utf8",
        (F.coalesce(in_order, F.lit(False)) & F.lit(rules.header_matchable)).alias("header_ok"), F.coalesce("n_keys", F.lit(0)).cast("int").alias("header_fields"),
    )
    struct = T.StructType([T.StructField(h, T.StringType()) for h in heads])
    value = F.from_json("body", struct, STRICT)
    rows = members.where(~last).select("f_id", "source_filename", "ordinal", value.alias("_v")).select(
        F.col("f_id").alias(FILE_ID), "source_filename", F.col("ordinal").alias("index"),
        *[F.col("_v").getField(c.expected_file_name).alias(c.name) for c in rules.data_columns],
    )
    return JsonScan(rows=rows, facts=facts, cached=cached)
