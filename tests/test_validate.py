"""Rejection precedence and store validity."""

from ledgerline.operators.validate import rejected_sales, stage_sales, valid_sales, valid_stores

U = "abcdef01-1111-4111-8111-111111111111"
T = "AAAAAAAA-0000-4000-8000-000000000001"
GOOD = [U, T, "R0001", "20240101T101500.000", "$10.00", "cashier"]


def staged(spark, rows):
    data = [tuple(r) + ("20240101", "f.csv", None, None) for r in rows]
    df = spark.createDataFrame(
        data, "store_token string, transaction_id string, receipt_token string, "
              "transaction_time string, amount string, user_role string, batch_date string, "
              "source_file string, ingested_at timestamp_ntz, dbt_updated_at timestamp_ntz")
    return stage_sales(df)


def variant(i, v):
    r = list(GOOD)
    r[i] = v
    return r


def test_each_reason_and_precedence(spark):
    rows = [GOOD,
            variant(0, U.upper()),            # store token must be lower case
            variant(1, "ZZZ"),
            variant(2, "ab"),
            variant(3, "not-a-timestamp"),
            variant(4, "€5"),
            variant(4, "$-5.00"),
            variant(5, "X" * 50),
            variant(5, None),                 # empty role → NULL → invalid
            ["not-a-uuid", "ZZZ", "ab", "x", "y", None]]   # first rule wins
    got = [r.rejection_reason for r in staged(spark, rows).collect()]
    assert got == [None, "invalid_store_token", "invalid_transaction_id",
                   "invalid_receipt_token", "invalid_transaction_time",
                   "invalid_amount_format", "invalid_amount_negative", "invalid_user_role",
                   "invalid_user_role", "invalid_store_token"]
    st = staged(spark, rows)
    assert valid_sales(st).count() == 1 and rejected_sales(st).count() == 9


def test_valid_stores_rules(spark):
    rows = [("ABCDEF01", U, "ok"), ("abcdef01", U, "lower group"), ("ABCDEF01", "x", "bad"),
            ("ABCDEF01", U, None), ("ABCDEF01", U, "N" * 201), ("ABCDEF01", U, "N" * 200)]
    df = spark.createDataFrame(
        [r + ("20240101", "f", None, None) for r in rows],
        "store_group string, store_token string, store_name string, batch_date string, "
        "source_file string, ingested_at timestamp_ntz, dbt_updated_at timestamp_ntz")
    assert sorted(len(r.store_name) for r in valid_stores(df).collect()) == [2, 200]
