"""Raw layer: landing rows → de-duplicated snapshot input → SCD2 history.

The snapshot input of one run keeps, per key, the row of the latest
landing file (file name descending; the other columns break ties so the
result is the same on every run), and drops rows without a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as C
from ledgerline.functions.parse import batch_date_of
from ledgerline.operators.dedup import keep_latest
from ledgerline.operators.scd2 import snapshot_check

STORES_KEY = "store_token"
STORES_CHECK = ["store_group", "store_name"]
SALES_KEY = "transaction_uid"
SALES_CHECK = ["receipt_token", "transaction_time", "amount", "user_role"]


def _ts(run_ts) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(str(run_ts)).cast("timestamp_ntz")


def stores_input(landing: DataFrame, run_ts) -> DataFrame:
    """Landing stores (+ ``source_file``) → one row per store token."""
    keyed = landing.select(
        "store_token", "store_group", "store_name", "source_file",
        batch_date_of("source_file", C.STORES_FILE_RE).alias("batch_date"),
        _ts(run_ts).alias("ingested_at"),
    )
    return keep_latest(keyed, [STORES_KEY], [F.col("source_file").desc()]) \
        .where(F.col("store_token").isNotNull())


def sales_key(store_token: Column, transaction_id: Column) -> Column:
    return F.concat(F.coalesce(store_token, F.lit("")), F.lit("|"),
                    F.coalesce(transaction_id, F.lit("")))


def sales_input(landing: DataFrame, run_ts) -> DataFrame:
    """Landing sales (+ ``source_file``) → one row per transaction key."""
    keyed = landing.select(
        sales_key(F.col("store_token"), F.col("transaction_id")).alias(SALES_KEY),
        *C.SALES_COLUMNS,
        "source_file",
        batch_date_of("source_file", C.SALES_FILE_RE).alias("batch_date"),
        _ts(run_ts).alias("ingested_at"),
    )
    return keep_latest(keyed, [SALES_KEY], [F.col("source_file").desc()]).where(
        F.col("store_token").isNotNull() & F.col("transaction_id").isNotNull())


def snapshot_stores(history: DataFrame | None, landing: DataFrame, run_ts) -> DataFrame:
    return snapshot_check(history, stores_input(landing, run_ts), STORES_KEY,
                          STORES_CHECK, run_ts)


def snapshot_sales(history: DataFrame | None, landing: DataFrame, run_ts) -> DataFrame:
    return snapshot_check(history, sales_input(landing, run_ts), SALES_KEY,
                          SALES_CHECK, run_ts)
