"""Report semantics: ties, month change, latest-N cut, Output 3 variants."""

import datetime as dt
from decimal import Decimal

from ledgerline.plans import reports as R

SCHEMA = "store_token string, transaction_time timestamp_ntz, amount decimal(11,2), batch_date string"


def sales(spark, rows):
    return spark.createDataFrame(
        [(s, dt.datetime.fromisoformat(t), Decimal(a), "20240101") for s, t, a in rows], SCHEMA)


def test_top_store_tie_and_month_restart(spark):
    df = sales(spark, [("b", "2024-01-31 10:00", "5"), ("a", "2024-01-31 11:00", "5"),
                       ("c", "2024-02-01 10:00", "7"), ("c", "2024-02-01 12:00", "1")])
    out = {r.transaction_date.isoformat(): r for r in R.output2(df, "2024-02-02").collect()}
    assert out["2024-01-31"].top_store_token == "a"          # tie → lower token
    assert out["2024-01-31"].month_accumulated_sales == Decimal("10.00")
    assert out["2024-02-01"].month_accumulated_sales == Decimal("8.00")   # restarts
    assert out["2024-02-01"].stores_with_transactions == 1
    assert out["2024-02-01"].total_sales_average == 4.0


def test_latest_40_keeps_running_sum_of_cut_days(spark):
    rows = [("a", f"2024-01-{d:02d} 10:00", "1") for d in range(1, 32)] + \
           [("a", f"2024-02-{d:02d} 10:00", "1") for d in range(1, 30)]
    out = R.output2(sales(spark, rows)).collect()
    assert len(out) == 40
    jan = [r for r in out if r.transaction_date.month == 1]
    # 60 days → the 40 latest start on Jan 21, whose month-to-date sum still counts Jan 1-20
    assert jan[-1].transaction_date.day == 21 and jan[-1].month_accumulated_sales == 21


def test_output3_documented_vs_literal(spark):
    rows = [(s, f"2024-01-{d:02d} 10:00", "1") for d in range(1, 21) for s in "abcdefg"]
    rows += [(s, "2024-01-20 11:00", "1") for s in "abcdefghijkl"]
    df = sales(spark, rows)
    stores = spark.createDataFrame([("a", "Store A")], "store_token string, store_name string")
    doc = R.output3(df, stores).collect()
    lit = R.output3(df, stores, literal=True).collect()
    assert len({r.transaction_date for r in doc}) == 10 and len(doc) == 50
    assert len({r.transaction_date for r in lit}) == 1 and len(lit) == 5
    names = {r.store_token: r.store_name for r in doc}
    assert names["a"] == "Store A" and names["b"] is None
