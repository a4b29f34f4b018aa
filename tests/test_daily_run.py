"""Multi-run scenarios of the whole ELT run on small landing folders."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import write_csv
from ledgerline.plans.daily_run import CheckFailed, Layout, run_daily
from ledgerline.sinks import tables as TB

S1 = "11111111-1111-4111-8111-111111111111"
S2 = "22222222-2222-4222-8222-222222222222"
T1 = "aaaaaaaa-0000-4000-8000-000000000001"
T2 = "aaaaaaaa-0000-4000-8000-000000000002"
T3 = "AAAAAAAA-0000-4000-8000-000000000003"


def stores_file(d, name, rows, header=False):
    lines = (["store_group,store_token,store_name"] if header else []) + rows
    write_csv(os.path.join(d, name), "\n".join(lines) + "\n")


def sales_file(d, name, rows, header=False):
    head = "store_token,transaction_id,receipt_token,transaction_time,amount,user_role"
    write_csv(os.path.join(d, name), "\n".join(([head] if header else []) + rows) + "\n")


def layout(root):
    land = os.path.join(root, "landing")
    os.makedirs(land, exist_ok=True)
    return Layout(landing=land, warehouse=os.path.join(root, "wh"),
                  exports=os.path.join(root, "exports"), n_buckets=4, store_buckets=2)


def rows(spark, path, order):
    df = TB.read(spark, path)
    return [r.asDict() for r in df.drop("bucket", "segment").orderBy(*order).collect()]


@pytest.fixture
def base(spark, tmp_dir):
    lay = layout(tmp_dir)
    stores_file(lay.landing, "stores_20240101.csv",
                [f"ABCDEF01,{S1},Store One", f'ABCDEF02,{S2},"Two, Inc"'], header=True)
    sales_file(lay.landing, "sales_20240101.csv", [
        f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier",
        f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier",   # in-file duplicate
        f"{S2},{T2},R0002,20240101T111500.250,\"$1,234.00\",manager",
        f"{S2},{T3},ab,20240101T121500.000,$5.00,cashier",        # invalid receipt
        "only,two",                                                 # malformed
    ])
    return lay


def test_first_run_and_replay(spark, base):
    r1 = run_daily(spark, base, "2024-01-02 06:00:00", run_date="2024-01-02")
    P = base.path
    snap = rows(spark, P("raw", "raw_sales_snapshot"), ["transaction_uid"])
    assert len(snap) == 3 and all(r["dbt_valid_to"] is None for r in snap)
    audit = rows(spark, P("raw", "raw_file_audit"), ["file_type"])
    assert [(r["file_type"], r["row_count"]) for r in audit] == [("sales", 4), ("stores", 2)]
    silver = rows(spark, P("silver", "silver_sales"), ["transaction_id"])
    assert [str(r["amount"]) for r in silver] == ["10.50", "1234.00"]
    rej = rows(spark, P("silver", "silver_sales_rejected"), ["transaction_id"])
    assert [r["rejection_reason"] for r in rej] == ["invalid_receipt_token"]
    o1 = rows(spark, P("gold", "rpt_transactions_by_batch"), ["batch_date"])
    assert [(r["total_raw_transactions"], r["valid_transactions"],
             r["invalid_transactions"]) for r in o1] == [(4, 2, 1)]
    assert all(c["failures"] == 0 for c in r1.checks if c["severity"] == "error")
    assert os.path.isdir(os.path.join(base.exports, "gold",
                                      "rpt_sales_by_transaction_date.parquet"))
    from ledgerline.plans.daily_run import register_warehouse
    from ledgerline.sinks.export import EXPORT_TABLES
    assert all(os.path.isdir(os.path.join(base.exports, layer, f"{t}.parquet"))
               for layer, names in EXPORT_TABLES.items() for t in names)
    assert "raw.raw_sales_snapshot" in register_warehouse(spark, base)
    assert spark.sql("SELECT * FROM silver.silver_sales").count() == 2
    assert spark.table("silver_silver_sales").count() == 2
    assert "bucket" not in spark.table("silver_silver_sales").columns

    # Replay the same files: no new versions, same gold except stamps.
    gold_before = rows(spark, P("gold", "rpt_sales_by_transaction_date"), ["transaction_date"])
    run_daily(spark, base, "2024-01-03 06:00:00", run_date="2024-01-02")
    assert len(rows(spark, P("raw", "raw_sales_snapshot"), ["transaction_uid"])) == 3
    assert len(rows(spark, P("raw", "raw_file_audit"), ["file_type"])) == 2
    assert len(rows(spark, P("silver", "silver_sales_rejected"), ["transaction_id"])) == 1
    assert rows(spark, P("gold", "rpt_sales_by_transaction_date"),
                ["transaction_date"]) == gold_before


def test_scd2_life_and_flips(spark, base):
    P = base.path
    run_daily(spark, base, "2024-01-02 06:00:00")
    # day 2: store renamed, T2 turns invalid, T3 turns valid, T1 amount changes
    stores_file(base.landing, "stores_20240102.csv", [f"ABCDEF01,{S1},Store One Renamed"])
    sales_file(base.landing, "sales_20240102_001.csv", [
        f"{S1},{T1},R0001,20240101T101500.000,$11.00,cashier",
        f"{S2},{T2},R0002,20240101T111500.250,$-1.00,manager",
        f"{S2},{T3},R0003,20240101T121500.000,$5.00,cashier",
    ], header=True)
    run_daily(spark, base, "2024-01-03 06:00:00")
    stores = rows(spark, P("raw", "raw_stores_snapshot"), ["store_token", "dbt_valid_from"])
    s1 = [r for r in stores if r["store_token"] == S1]
    assert [r["store_name"] for r in s1] == ["Store One", "Store One Renamed"]
    assert s1[0]["dbt_valid_to"] == s1[1]["dbt_valid_from"]
    silver = {r["transaction_id"]: r for r in rows(spark, P("silver", "silver_sales"),
                                                   ["transaction_id"])}
    # T1 updated in place; T2 stays valid (old row kept, T3 of the trap list);
    # T3 now valid.
    assert str(silver[T1]["amount"]) == "11.00"
    assert str(silver[T2]["amount"]) == "1234.00"
    assert T3 in silver
    rej = rows(spark, P("silver", "silver_sales_rejected"), ["transaction_id"])
    assert sorted(r["rejection_reason"] for r in rej) == ["invalid_amount_negative",
                                                          "invalid_receipt_token"]
    ss = rows(spark, P("silver", "silver_stores"), ["store_token"])
    assert [r["store_name"] for r in ss] == ["Store One Renamed", "Two, Inc"]


def next_landing(lay, root, name):
    """Same warehouse, fresh landing folder (files of earlier runs archived)."""
    land = os.path.join(root, name)
    os.makedirs(land, exist_ok=True)
    return Layout(landing=land, warehouse=lay.warehouse, exports=lay.exports,
                  n_buckets=lay.n_buckets, store_buckets=lay.store_buckets)


def test_late_older_batch_wins_by_arrival(spark, base, tmp_dir):
    """Arrival order, not batch order, decides the current version."""
    run_daily(spark, base, "2024-01-02 06:00:00")
    lay2 = next_landing(base, tmp_dir, "landing2")
    sales_file(lay2.landing, "sales_20231231.csv",
               [f"{S1},{T1},R0001,20240101T101500.000,$99.00,cashier"])
    run_daily(spark, lay2, "2024-01-03 06:00:00")
    snap = [r for r in rows(spark, base.path("raw", "raw_sales_snapshot"), ["dbt_valid_from"])
            if r["transaction_id"] == T1]
    assert [r["amount"] for r in snap] == ["$10.50", "$99.00"]
    silver = {r["transaction_id"]: r for r in rows(spark, base.path("silver", "silver_sales"),
                                                   ["transaction_id"])}
    assert str(silver[T1]["amount"]) == "99.00" and silver[T1]["batch_date"] == "20231231"


def test_store_turning_invalid_keeps_last_valid_row(spark, base, tmp_dir):
    """T4: silver_stores keeps the last valid version; T5: a re-uploaded
    file name keeps its first audited row count."""
    run_daily(spark, base, "2024-01-02 06:00:00")
    lay2 = next_landing(base, tmp_dir, "landing2")
    stores_file(lay2.landing, "stores_20240101.csv",
                [f"zzzzzzzz,{S1},Store One", f"ABCDEF02,{S2},Two", "ABCDEF03,,Blank"])
    run_daily(spark, lay2, "2024-01-03 06:00:00")
    ss = {r["store_token"]: r for r in rows(spark, base.path("silver", "silver_stores"),
                                            ["store_token"])}
    assert ss[S1]["store_group"] == "ABCDEF01" and ss[S2]["store_name"] == "Two"
    audit = rows(spark, base.path("raw", "raw_file_audit"), ["source_file"])
    stores_audit = [r for r in audit if r["file_type"] == "stores"]
    assert len(stores_audit) == 2 and sorted(r["row_count"] for r in stores_audit) == [2, 3]


def test_batch_without_readable_rows_is_not_reported(spark, tmp_dir):
    """A sales file with only a header / malformed lines gets no audit
    row, so its batch is missing from Output 1."""
    lay = layout(tmp_dir)
    sales_file(lay.landing, "sales_20240101.csv",
               [f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier"])
    sales_file(lay.landing, "sales_20240102.csv", ["x,y"], header=True)
    run_daily(spark, lay, "2024-01-02 06:00:00")
    o1 = rows(spark, lay.path("gold", "rpt_transactions_by_batch"), ["batch_date"])
    assert [str(r["batch_date"]) for r in o1] == ["2024-01-01"]


def test_null_keys_counted_but_not_in_silver(spark, tmp_dir):
    """Rows without store token or transaction id count in the audit
    but reach neither silver table; in-file duplicates count twice."""
    lay = layout(tmp_dir)
    sales_file(lay.landing, "sales_20240101.csv", [
        f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier",
        f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier",
        f",{T2},R0002,20240101T101500.000,$1.00,cashier",
        f"{S1},,R0003,20240101T101500.000,$1.00,cashier"])
    run_daily(spark, lay, "2024-01-02 06:00:00")
    o1 = rows(spark, lay.path("gold", "rpt_transactions_by_batch"), ["batch_date"])
    assert [(r["total_raw_transactions"], r["valid_transactions"],
             r["invalid_transactions"]) for r in o1] == [(4, 1, 0)]


def test_empty_landing(spark, tmp_dir):
    lay = layout(tmp_dir)
    res = run_daily(spark, lay, "2024-01-02 06:00:00", checks="after_all")
    assert TB.read(spark, lay.path("gold", "rpt_transactions_by_batch")).count() == 0
    assert res.tables


def test_bad_file_name_fails_output1(spark, tmp_dir):
    lay = layout(tmp_dir)
    sales_file(lay.landing, "sales_x.csv",
               [f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier"])
    with pytest.raises(Exception):
        run_daily(spark, lay, "2024-01-02 06:00:00")
    lay2 = layout(tmp_dir + "-b")
    sales_file(lay2.landing, "sales_x.csv",
               [f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier"])
    run_daily(spark, lay2, "2024-01-02 06:00:00", strict_batch_date=False, checks="off")
    o1 = TB.read(spark, lay2.path("gold", "rpt_transactions_by_batch")).collect()
    assert len(o1) == 1 and o1[0]["batch_date"] is None


def test_checks_after_each(spark, base):
    res = run_daily(spark, base, "2024-01-02 06:00:00", checks="after_each", export=False)
    models = {c["model"] for c in res.checks}
    assert "silver_stores" in models and "rpt_top_5_stores_by_date" in models
    warn = [c for c in res.checks if c["severity"] == "warn"]
    assert warn and warn[0]["failures"] == 0
    with pytest.raises(ValueError):
        run_daily(spark, base, "2024-01-03 06:00:00", checks="sometimes")
    assert CheckFailed and TB.BUCKET == "bucket" and F


def test_compaction_keeps_rows(spark, tmp_dir):
    lay = layout(tmp_dir)
    lay.compact_above_files = 1
    stores_file(lay.landing, "stores_20240101.csv", [f"ABCDEF01,{S1},One"])
    sales_file(lay.landing, "sales_20240101.csv",
               [f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier"])
    run_daily(spark, lay, "2024-01-02 06:00:00", checks="off", export=False)
    lay2 = next_landing(lay, tmp_dir, "landing2")
    lay2.compact_above_files = 1
    sales_file(lay2.landing, "sales_20240102.csv",
               [f"{S1},{T2},R0002,20240102T101500.000,$1.00,cashier",
                f"{S1},{T3},R0003,20240102T111500.000,$2.00,cashier"])
    run_daily(spark, lay2, "2024-01-03 06:00:00", checks="after_all", export=False)
    counts = TB.files_per_bucket(spark, lay.path("silver", "silver_sales"))
    assert counts and max(map(len, counts.values())) == 1
    assert len(rows(spark, lay.path("silver", "silver_sales"), ["transaction_id"])) == 3
