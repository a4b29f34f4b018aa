"""The three gold reports and the per-batch audit that feeds Output 1.

All reports are small (≤ 50 rows) but read the whole silver tables. The
big work is one aggregation per report over ``silver_sales``; everything
after it runs on per-day / per-(day, store) aggregates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as C
from ledgerline.functions.parse import batch_date_to_date
from ledgerline.operators.windows import (
    latest_n,
    month_to_date_sum,
    top_k_per,
    values_of_latest_rows,
)


def _date_lit(run_date: dt.date | str | None):
    if run_date is None:
        return F.current_date()
    return F.lit(str(run_date)).cast("date")


def audit_by_batch(file_audit: DataFrame, silver_sales: DataFrame,
                   silver_rejected: DataFrame) -> DataFrame:
    """One row per sales batch date known to the file audit.

    total = Σ row_count of sales files; valid / invalid = rows of the two
    silver tables per batch; processing_date = latest audit stamp.
    Batches absent from the audit are not reported (audit is the left side).
    """
    valid = silver_sales.groupBy("batch_date").agg(F.count("*").alias("valid_transactions"))
    invalid = silver_rejected.groupBy("batch_date").agg(
        F.count("*").alias("invalid_transactions"))
    return audit_from_counts(file_audit, valid, invalid)


def audit_from_counts(file_audit: DataFrame, valid: DataFrame, invalid: DataFrame) -> DataFrame:
    """``audit_by_batch`` from (batch_date, valid_transactions) and
    (batch_date, invalid_transactions)."""
    totals = (file_audit.where(F.col("file_type") == "sales")
              .groupBy("batch_date")
              .agg(F.sum("row_count").cast("bigint").alias("total_raw_transactions"),
                   F.max("processed_at").alias("processing_date")))
    return (totals.join(valid, "batch_date", "left")
            .join(invalid, "batch_date", "left")
            .select("batch_date",
                    "total_raw_transactions",
                    F.coalesce("valid_transactions", F.lit(0)).cast("bigint")
                    .alias("valid_transactions"),
                    F.coalesce("invalid_transactions", F.lit(0)).cast("bigint")
                    .alias("invalid_transactions"),
                    "processing_date"))


def output1(audit: DataFrame, run_date=None, strict_batch_date: bool = True,
            n: int = C.OUTPUT1_ROWS) -> DataFrame:
    """Output 1: latest ``n`` batches, newest first.

    ``strict_batch_date`` (default) fails the query on a batch date that is
    not ``YYYYMMDD`` (e.g. ``''`` from a file name outside the pattern);
    otherwise such a batch gets a NULL date.
    """
    top = latest_n(audit, "batch_date", n)
    return top.select(
        _date_lit(run_date).alias("snapshot_date"),
        batch_date_to_date("batch_date", strict_batch_date).alias("batch_date"),
        "total_raw_transactions",
        "valid_transactions",
        "invalid_transactions",
        "processing_date",
    ).orderBy(F.col("batch_date").desc())


def _sales_by_day(silver_sales: DataFrame) -> DataFrame:
    return silver_sales.select(
        F.to_date("transaction_time").alias("transaction_date"),
        "store_token",
        "amount",
    )


def daily_store_totals(silver_sales: DataFrame) -> DataFrame:
    """The one pass over the sales rows: Σ amount and count per (day, store).
    Partial aggregation runs map-side, so a hot store or day only adds
    one row per map task to the shuffle."""
    return _sales_by_day(silver_sales).groupBy("transaction_date", "store_token").agg(
        F.sum("amount").alias("store_total"),
        F.count("amount").alias("n_amount"),
    )


def top_by(value: str, key: str) -> F.Column:
    """The ``key`` with the largest ``value`` (NULL values last; ties → the
    smallest key, NULL keys last) as one aggregate: ``min_by`` over an
    ordering struct. Combinable map-side, so no window and no join."""
    order = F.struct(F.col(value).isNull(), -F.col(value), F.col(key).isNull(), F.col(key))
    return F.min_by(F.col(key), order)


def output2(silver_sales: DataFrame, run_date=None, n: int = C.OUTPUT2_ROWS) -> DataFrame:
    """Output 2: per transaction date, the number of stores, total, mean
    per sale, month-to-date running total (over *all* days, before the cut
    to the latest ``n``) and the top store (ties → lower token).

    Plan: one aggregation of the sales rows by (day, store); one by day
    over that (stores, totals, top store); a running-sum window over the
    per-day rows; then the global top-``n``.
    """
    return output2_of(daily_store_totals(silver_sales), run_date, n)


def output2_of(ds: DataFrame, run_date=None, n: int = C.OUTPUT2_ROWS) -> DataFrame:
    """``output2`` from (transaction_date, store_token, store_total, n_amount)."""
    # count(distinct store) per day == number of non-NULL store groups of the day.
    daily = ds.groupBy("transaction_date").agg(
        F.count("store_token").alias("stores_with_transactions"),
        F.sum("store_total").alias("total_sales_amount"),
        F.sum("n_amount").alias("n_amount"),
        top_by("store_total", "store_token").alias("top_store_token"),
    )
    daily = month_to_date_sum(daily, "transaction_date", "total_sales_amount",
                              "month_accumulated_sales")
    return latest_n(daily, "transaction_date", n).select(
        _date_lit(run_date).alias("snapshot_date"),
        "transaction_date",
        "stores_with_transactions",
        F.col("total_sales_amount").cast(C.REPORT_SUM_TYPE).alias("total_sales_amount"),
        (F.col("total_sales_amount").cast("double") / F.col("n_amount"))
        .alias("total_sales_average"),
        F.col("month_accumulated_sales").cast(C.REPORT_SUM_TYPE)
        .alias("month_accumulated_sales"),
        "top_store_token",
    ).orderBy(F.col("transaction_date").desc())


def output3(silver_sales: DataFrame, silver_stores: DataFrame, run_date=None,
            n_dates: int = C.OUTPUT3_DATES, k: int = C.OUTPUT3_TOP_K,
            literal: bool = False) -> DataFrame:
    """Output 3: top ``k`` stores by sales for each of the last ``n_dates``
    transaction dates, with the store name (NULL when unknown).

    ``literal=True`` reproduces the ranking of the latest *sale rows*
    rather than the latest dates (the window runs before DISTINCT), which
    keeps fewer dates when the last day has more than ``n_dates`` sales.
    """
    sales = _sales_by_day(silver_sales)
    if literal:
        last = values_of_latest_rows(sales, "transaction_date", n_dates)
    else:
        last = latest_n(sales, "transaction_date", n_dates, distinct=True)
    # `last` holds at most n_dates rows: a proven bound, safe to broadcast.
    daily_store = (sales.join(F.broadcast(last), "transaction_date", "left_semi")
                   .groupBy("transaction_date", "store_token")
                   .agg(F.sum("amount").alias("store_total_sales")))
    return _ranked_stores(daily_store, silver_stores, run_date, k)


def output3_of(ds: DataFrame, silver_stores: DataFrame, run_date=None,
               n_dates: int = C.OUTPUT3_DATES, k: int = C.OUTPUT3_TOP_K) -> DataFrame:
    """``output3`` from (transaction_date, store_token, store_total, ...)."""
    last = latest_n(ds, "transaction_date", n_dates, distinct=True)
    daily_store = ds.join(F.broadcast(last), "transaction_date", "left_semi").select(
        "transaction_date", "store_token", F.col("store_total").alias("store_total_sales"))
    return _ranked_stores(daily_store, silver_stores, run_date, k)


def _ranked_stores(daily_store: DataFrame, silver_stores: DataFrame, run_date, k: int) -> DataFrame:
    ranked = top_k_per(
        daily_store, "transaction_date",
        [F.col("store_total_sales").desc_nulls_last(), F.col("store_token").asc_nulls_last()],
        k, rank_col="top_rank_id",
    )
    # ≤ n_dates·k ranked rows meet the store dimension in one left join (AQE
    # broadcasts the dimension when its runtime size allows). Semi-filtering
    # the dimension by the ranked tokens first would compute the ranking,
    # and scan the sales, twice.
    names = silver_stores.select("store_token", "store_name")
    return ranked.join(names, "store_token", "left").select(
        _date_lit(run_date).alias("snapshot_date"),
        "transaction_date",
        F.col("top_rank_id").cast("int").alias("top_rank_id"),
        F.col("store_total_sales").cast(C.REPORT_SUM_TYPE).alias("store_total_sales"),
        "store_token",
        "store_name",
    ).orderBy(F.col("transaction_date").desc(), "top_rank_id")
