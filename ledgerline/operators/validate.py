"""Parsing and row-level validation of sales and stores.

``stage_sales`` is shared by the valid/invalid router (``valid_sales`` /
``rejected_sales``): two disjoint filters over one lazy DataFrame. When
both consumers are written in the same run, write the staged frame first
(see ``plans.daily_run``) so the snapshot is scanned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as C
from ledgerline.functions.parse import matches, parse_amount, parse_ts


def rejection_reason(df: DataFrame) -> F.Column:
    """First failing rule wins (the order of ``C.REJECTION_REASONS``)."""
    amount = F.col("amount_parsed")
    role = F.col("user_role")
    rules = [
        ~matches("store_token", C.STORE_TOKEN_RE),
        ~matches("transaction_id", C.TRANSACTION_ID_RE),
        ~matches("receipt_token", C.RECEIPT_TOKEN_RE),
        F.col("transaction_time_parsed").isNull(),
        amount.isNull(),
        amount < 0,
        role.isNull() | (F.length(role) > C.USER_ROLE_MAX_LEN),
    ]
    expr = None
    for rule, reason in zip(rules, C.REJECTION_REASONS):
        expr = F.when(rule, reason) if expr is None else expr.when(rule, reason)
    return expr.otherwise(F.lit(None).cast("string"))


def stage_sales(current: DataFrame) -> DataFrame:
    """Current raw sale versions → parsed fields + ``rejection_reason``.

    Input columns: the six landing fields, ``batch_date``, ``source_file``,
    ``ingested_at`` and ``dbt_updated_at``.
    """
    parsed = current.select(
        "store_token",
        "transaction_id",
        "receipt_token",
        F.col("transaction_time").alias("transaction_time_raw"),
        parse_ts("transaction_time").alias("transaction_time_parsed"),
        F.col("amount").alias("amount_raw"),
        parse_amount("amount").alias("amount_parsed"),
        "user_role",
        "batch_date",
        "source_file",
        "ingested_at",
        F.col("dbt_updated_at").alias("snapshot_updated_at"),
    )
    return parsed.withColumn("rejection_reason", rejection_reason(parsed))


SILVER_SALES_COLUMNS = [
    "store_token", "transaction_id", "receipt_token", "transaction_time", "amount",
    "user_role", "batch_date", "source_file", "ingested_at", "snapshot_updated_at",
]
REJECTED_COLUMNS = [
    "store_token", "transaction_id", "receipt_token", "transaction_time_raw",
    "amount_raw", "user_role", "batch_date", "source_file", "ingested_at",
    "snapshot_updated_at", "rejection_reason",
]


def valid_sales(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("rejection_reason").isNull()).select(
        "store_token",
        "transaction_id",
        "receipt_token",
        F.col("transaction_time_parsed").alias("transaction_time"),
        F.col("amount_parsed").alias("amount"),
        "user_role",
        "batch_date",
        "source_file",
        "ingested_at",
        "snapshot_updated_at",
    )


def rejected_sales(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("rejection_reason").isNotNull()).select(*REJECTED_COLUMNS)


def valid_stores(current: DataFrame) -> DataFrame:
    """Current store versions passing the four rules; invalid ones are
    dropped silently (there is no store reject table)."""
    name_len = F.length("store_name")
    return current.where(
        matches("store_group", C.STORE_GROUP_RE)
        & matches("store_token", C.STORE_TOKEN_RE)
        & F.col("store_name").isNotNull()
        & name_len.between(C.STORE_NAME_MIN_LEN, C.STORE_NAME_MAX_LEN)
    ).select(
        "store_token",
        "store_group",
        "store_name",
        "batch_date",
        "source_file",
        F.col("ingested_at").alias("valid_from"),
        F.col("dbt_updated_at").alias("snapshot_updated_at"),
    )
