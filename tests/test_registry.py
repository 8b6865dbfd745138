"""Registered queries leave nothing cached behind them."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_queries_release_what_they_cache(spark):
    persistent = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    spark.catalog.clearCache()
    queries, sizes = entry.queries(), []
    for name in ("rows_stats_report", "landing_rows_stats", "key_single_violations", "json_landing_file_stats", "landing_documents_rows_stats", "rows_stats_report"):
        queries[name](spark, SF).collect()
        sizes.append(persistent())
    assert sizes[0] == sizes[-1] and max(sizes) <= 12


def test_an_earlier_frame_can_still_be_computed(spark):
    first = entry.queries()["rows_stats_report"](spark, SF)
    want = sorted(map(tuple, first.collect()))
    entry.queries()["landing_rows_stats"](spark, SF).collect()
    assert sorted(map(tuple, first.collect())) == want
