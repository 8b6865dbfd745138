"""What the plans at scale must not do: copy the records, make rows twice, judge odd texts by another rule than plain ones."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
from sluice.catalog import registry
from sluice.functions.parsing import NumberParser, StrptimeParser, integral, seldom
from sluice.operators.keys import with_key_counts

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_table_checks_keep_no_copy_of_the_records(spark):
    for name in ("lineitem_valid_typed", "key_composite_violations", "valid_typed"):
        df = entry.queries()[name](spark, SF)
        kept = registry._OPEN[-1].cached
        assert all("_key_count" in k.columns for k in kept), name
        assert plan(df).count("InMemoryRelation") <= 1, name


def test_violations_are_not_filtered_below_the_parse(spark):
    text = plan(entry.queries()["key_composite_violations"](spark, SF))
    assert "Filter ((size(violations" not in text and "Filter (size(" not in text


def test_the_shuffle_join_makes_rows_once(spark):
    df = spark.createDataFrame([("f", i, str(i % 7)) for i in range(20)], "source_filename string, index long, k string")
    out, dups = with_key_counts(df, ["k"], budget=0)
    assert "Union" not in plan(out)
    assert sorted((r["index"], r["_key_count"]) for r in out.collect()) == [(i, 3 if i % 7 < 6 else 2) for i in range(20)]
    dups.unpersist()


def test_landing_lines_are_not_cached(spark):
    entry.queries()["landing_lineitem_rows_stats"](spark, SF).collect()
    assert not [c for c in registry._OPEN[-1].cached if "_rid" in c.columns]


def test_json_members_are_parsed_once_for_the_file_facts(spark, tmp_path):
    from sluice.catalog.landing import events_json_landing, events_json_rules
    from sluice.sources.json import scan_split_json

    scan = scan_split_json(spark, events_json_landing(spark, SF), events_json_rules(), split_bytes=0)
    assert "from_json" not in plan(scan.facts)
    facts = scan.facts.groupBy("parse_ok", "header_ok", "header_fields").count().collect()
    assert {(r["parse_ok"], r["header_ok"]) for r in facts} == {(True, True), (False, False)}
    for c in scan.cached:
        c.unpersist()


def test_collocations_fill_a_chunk_for_each_group():
    import pyarrow as pa

    from sluice.llm.collocations import _gathered

    groups, chunk = 32, 100
    batches = [pa.RecordBatch.from_arrays([pa.array([f"g{k}"]), pa.array([b"x" * 10])], names=["g", "text"]) for _ in range(20) for k in range(groups)]
    sizes = [len(text) for _, text in _gathered(iter(batches), chunk)]
    assert sum(s >= chunk for s in sizes) >= groups  # each group reaches a chunk before the fullest is let go


ODD = [
    None, "", "0", "-0", "+7", "007", "12", " 12", "12 ", "\t12\n", "12\x00", "\x0012", "\x1f3", "3\x7f", "\x7f3", "1.0", "1.5", "1,5", "10.05", "1.", ".5", ".", "-", "+", "+-1",
    "1e3", "1E3", "1e400", "-1e400", "1d", "1f", "1D", "2F", "0x1p3", "0X1P3", "0x10", "NaN", "nan", "inf", "-Infinity", "infinity", "Infinity ", "1/", "1:", ":", "9223372036854775807",
    "9223372036854775808", "-9223372036854775808", "99999999999999999999", "1_0", "١٢", "1 2", "--1", "1.234,5", "1.234.567,89", "12x",
    "2020-02-29", "2021-02-29", "2020-2-9", " 2020-02-09", "2020-02-09 ", "2020-02-09T", "2020-02-09 10:11:12", "2020-02-09 10:11:60", "2020-02-09T10:11:12", "2020-02-09t10:11:12", "2020-02-09  10:11:12",
    "2020-02-09 24:00:00", "2020-02-09 10:11", "2020-02-09 10:11:12.5", "1677-09-21", "1677-09-22", "2262-04-11", "2262-04-12", "0000-01-01", "9999-12-31", "1900-01-01", "+2020-01-01",
    "29/02/2020 10:11:12", "31/02/2020 10:11:12", "29-02/2020 10:11:12", "29/02/2020", "31/02/2020", "1/2/2020", "01/02/2020", "01-02-2020", "01/02/20201", "00/01/2020", "12/31/2020", "01/02/2262", "11/04/2262", "12/04/2262", "20200229", "20200230",
]


def test_plain_forms_agree_with_the_stages(spark):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("0123456789+-.,eExfd/: \t") for _ in range(rng.randint(1, 10))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    formats = ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%Y%m%d", "%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M:%S", "%Y-%m-%dT%H:%M:%S")
    parsers = {"i": NumberParser(integer=True), "f": NumberParser(), "e": NumberParser(".", ","), **{f"d{k}": StrptimeParser(f) for k, f in enumerate(formats)}}
    for name, parser in parsers.items():
        t, raw = parser.plain(F.col("t"))
        staged = df.withColumns({"a": t, "n": raw}).withColumn("v", parser.plain_value(F.col("t"), F.col("a"), F.col("n")))
        value = F.col("v").cast("double") if name in "ife" else F.col("v")
        got = staged.select("t", F.coalesce(value, seldom(parser, F.col("t"))).alias("got"), parser(F.col("t")).alias("want"), "v")
        wrong = [tuple(r) for r in got.where("NOT (got <=> want)").collect()]
        assert not wrong, (name, wrong[:5])
        assert got.where("v IS NOT NULL").count() > 0, name  # the plain form is met
    t, raw = parsers["i"].plain(F.col("t"))
    i = parsers["i"]
    got = df.withColumns({"a": t, "n": raw}).select(
        "t", i.plain_value(F.col("t"), F.col("a"), F.col("n")).alias("v"), integral(F.col("t"), i(F.col("t"))).alias("want")
    )
    assert got.where("v IS NOT NULL AND NOT (v <=> want)").count() == 0
