"""Column parsers: amounts, timestamps, batch dates."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline import constants as C
from ledgerline.functions import batch_date_of, matches, parse_amount, parse_ts


def one_col(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn("s")).collect()]


def test_amount_edges(spark):
    vals = ["$63.98", "$-1,234.567", "$ 12", "1e3", "12.345", "-0.001", "99999999999.99",
            "", None, "€5", "$-5.00", "1_000", "$1,234.00", "1__0", "_1", "1_"]
    got = one_col(spark, vals, parse_amount)
    want = ["63.98", "-1234.57", "12.00", "1000.00", "12.35", "0.00", None, None, None,
            None, "-5.00", "1000.00", "1234.00", None, None, None]
    assert [None if g is None else str(g) for g in got] == want


def test_ts_edges(spark):
    vals = ["20211001T174600.000", "20211001T174600.1", "20211001T174600.123456",
            "20211001T174600", "20210229T000000.000", "20211001T240000.000",
            "20211001t174600.000", " 20211001T174600.000 ", "20211001T174600.1234567", None]
    got = one_col(spark, vals, parse_ts)
    d = dt.datetime
    assert got == [d(2021, 10, 1, 17, 46), d(2021, 10, 1, 17, 46, 0, 100000),
                   d(2021, 10, 1, 17, 46, 0, 123456), None, None, None, None,
                   d(2021, 10, 1, 17, 46), None, None]


def test_lenient_parsers_equal_sql(spark):
    """Short parts, white space and underscores, held against DuckDB."""
    import random

    import duckdb

    rng, con = random.Random(4), duckdb.connect()
    digits = lambda of, a, b: "".join(rng.choice(of) for _ in range(rng.randint(a, b)))
    part = lambda top: rng.choice(["%d", "%02d"]) % rng.randint(0, top)
    times = [rng.choice(["", "\t", " "]) + "20" + digits("012", 2, 2) + part(13) + part(32) + rng.choice("TTTTt")
             + part(24) + part(60) + part(60) + "." + digits("05", 0, 7) + rng.choice(["", "\n"]) for _ in range(400)]
    want = [con.execute("select try_strptime(?, '%Y%m%dT%H%M%S.%f')", [t]).fetchone()[0] for t in times]
    assert one_col(spark, times, parse_ts) == want and sum(w is not None for w in want) > 30
    sums = [rng.choice(["", "$", " ", "-"]) + digits("12_", 1, 5) + rng.choice(["", ".", "e1", "_"]) + digits("12,_", 0, 3)
            for _ in range(400)]
    want = [con.execute("select try_cast(replace(replace(?, '$', ''), ',', '') as decimal(11,2))", [t]).fetchone()[0]
            for t in sums]
    assert one_col(spark, sums, parse_amount) == want and sum(w is not None for w in want) > 30


def test_ts_independent_of_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = one_col(spark, ["20210314T023000.000"], parse_ts)   # DST gap in New York
        assert got == [dt.datetime(2021, 3, 14, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_batch_date_of(spark):
    vals = ["file:/x/sales_20240101.csv", "/x/sales_20240101_003.csv", "/x/sales_x.csv",
            "/x/stores_20240102.csv"]
    assert one_col(spark, vals, lambda c: batch_date_of(c, C.SALES_FILE_RE)) == [
        "20240101", "20240101", "", ""]
    assert one_col(spark, vals, lambda c: batch_date_of(c, C.STORES_FILE_RE))[3] == "20240102"


def test_receipt_trailing_newline_rejected(spark):
    got = one_col(spark, ["ab123", "ab123\n", "ab12", None],
                  lambda c: matches(c, C.RECEIPT_TOKEN_RE))
    assert got == [True, False, False, False]


def _py_amount(s: str):
    t = s.replace("$", "").replace(",", "")
    try:
        v = Decimal(t.strip())
    except InvalidOperation:
        return None
    if not v.is_finite():
        return None
    q = v.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return None if abs(q) >= Decimal("1e9") else q


@settings(max_examples=25, deadline=None)
@given(st.lists(st.decimals(min_value=-10**9 + 1, max_value=10**9 - 1, places=3,
                            allow_nan=False), min_size=1, max_size=20))
def test_amount_matches_decimal_rounding(spark, values):
    texts = [f"${v:,}" for v in values]
    got = one_col(spark, texts, parse_amount)
    assert got == [_py_amount(t) for t in texts]


def test_full_width_times_as_the_strict_parser_reads_them(spark, monkeypatch):
    from ledgerline.functions import parse

    forms = ["20240229T101530.25", "20230229T101530.25", "00000101T000000.0", "00010101T000000.0", "99991231T235959.999999",
             "20240101T240000.0", "20240101T236000.0", "20240101T235960.0", " 20240101T010203.000001\t", "20241301T000000.1",
             "20240100T000000.1", "20240101T101530.1234567", "20240101T101530.", "20240101t101530.1"]
    df = spark.createDataFrame([(x,) for x in forms], "s string")

    def read():
        return [r[0] for r in df.select(parse.parse_ts("s").cast("string")).collect()]

    got = read()
    monkeypatch.setattr(parse, "FULL_WIDTH_TIME", "^never$")
    assert got == read()
    assert [i for i, x in enumerate(got) if x is not None] == [0, 2, 3, 4, 8]
