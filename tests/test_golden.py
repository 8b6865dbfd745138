"""Golden end-to-end run on the pubmed rule set (FIXTURES.md), hand-derived outputs."""

import datetime as dt

from conftest import rules

from sluice.plans.landing import check_landing

TS = "2024-01-01 00:00:00"
H = "id;title;date;journal\n"


def test_pubmed_golden(spark, landing):
    landing("pubmed/pubmed_2020.csv", H + (
        "1;A study;01/02/2020;J1\n"       # 0 valid
        "2;B study;31/02/2020;J2\n"       # 1 date not parsable
        "3;;12/12/2019;J3\n"              # 2 title required
        "3;C study;;J3\n"                 # 3 key 3 twice; null date fails with %d/%m/%Y
        "4.0;D study;1/2/2020;J4\n"       # 4 valid, id 4.0 is an integer
        "4.5;E study;01/01/2020;J5\n"     # 5 4.5 has a non-zero fraction: not an INTEGER
        "10.05;F study;01/01/2020;J6\n"   # 6 passes the INTEGER check (reference rule), typed id null
        ";;;\n"                           # 7 all null: dropped, index counted
        "x;G study;01/01/2020;J7\n"       # 8 id not parsable
    ))
    res = check_landing(spark, landing.root, rules("pubmed"), table="pubmed", ingest_ts=TS)
    inv = sorted((r["index"], r.invalid_code, r.invalid_col_name, r.invalid_col_value)
                 for r in res.data_invalid.collect())
    assert inv == sorted([
        (1, "COLUMN_NOT_PARSABLE", "date", "31/02/2020"),
        (2, "NULL_VALUE_NOT_EXPECTED", "title", None),
        (2, "KEY_NOT_UNIQUE", "['id']", "['3']"),
        (3, "COLUMN_NOT_PARSABLE", "date", None),
        (3, "KEY_NOT_UNIQUE", "['id']", "['3']"),
        (5, "COLUMN_NOT_PARSABLE", "id", "4.5"),
        (8, "COLUMN_NOT_PARSABLE", "id", "x"),
    ])
    s = res.rows_stats.collect()[0]
    assert (s.nb_valid_lines, s.nb_invalid_lines) == (3, 5)
    assert (s.nb_invalid_lines_NULL_VALUE_NOT_EXPECTED, s.nb_invalid_lines_KEY_NOT_UNIQUE,
            s.nb_invalid_lines_COLUMN_NOT_PARSABLE) == (1, 2, 4)
    valid = sorted((r.title, r.id, r.date) for r in res.valid.collect())
    assert valid == [
        ("A study", 1, dt.date(2020, 2, 1)),
        ("D study", 4, dt.date(2020, 2, 1)),
        ("F study", None, dt.date(2020, 1, 1)),
    ]
    fs = res.file_stats.collect()[0]
    assert (fs.source_filename, fs.is_invalid, fs.description) == ("pubmed/pubmed_2020.csv", False, "File is VALID")
    assert str(fs.date_ingest) == TS
    res.release()


def test_prices_golden(spark, landing):
    """FLOAT with '.' thousands and ',' decimals, DATETIME format, key (shop, sku)."""
    landing("prices/prices_2024.csv", (
        "shop;sku;price;seen_at\n"
        "S1;10;1.234,5;2024-01-02 03:04:05\n"   # 0 valid: 1234.5
        "S1;10.0;7;2024-01-02 03:04:05\n"       # 1 valid for the check, key text differs from '10'
        "S2;;1,2,3;2024-01-02\n"                # 2 price not parsable; seen_at lacks the time
        "S2;;inf;\n"                            # 3 null seen_at: '1900-01-01' fails the format
        "S3;5;12L;2024-13-01 00:00:00\n"        # 4 price and seen_at not parsable
        "S3;5;;2024-02-29 23:59:59\n"           # 5 key (S3, 5) twice
    ))
    res = check_landing(spark, landing.root, rules("prices"), table="prices", ingest_ts=TS)
    inv = sorted((r["index"], r.invalid_code, r.invalid_col_name, r.invalid_col_value)
                 for r in res.data_invalid.collect())
    assert inv == sorted([
        (2, "COLUMN_NOT_PARSABLE", "price", "1,2,3"),
        (2, "COLUMN_NOT_PARSABLE", "seen_at", "2024-01-02"),
        (2, "KEY_NOT_UNIQUE", "['shop', 'sku']", "['S2','nan']"),
        (3, "COLUMN_NOT_PARSABLE", "seen_at", None),
        (3, "KEY_NOT_UNIQUE", "['shop', 'sku']", "['S2','nan']"),
        (4, "COLUMN_NOT_PARSABLE", "price", "12L"),
        (4, "COLUMN_NOT_PARSABLE", "seen_at", "2024-13-01 00:00:00"),
        (4, "KEY_NOT_UNIQUE", "['shop', 'sku']", "['S3','5']"),
        (5, "KEY_NOT_UNIQUE", "['shop', 'sku']", "['S3','5']"),
    ])
    valid = sorted((r.shop, r.sku, r.price, str(r.seen_at)) for r in res.valid.collect())
    assert valid == sorted([("S1", 10, 1234.5, "2024-01-02 03:04:05"), ("S1", 10, 7.0, "2024-01-02 03:04:05")])
    res.release()
