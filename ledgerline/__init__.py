"""Spark-native ELT for partner sales files: landing CSV → SCD2 raw →
validated silver → gold reports, as plain DataFrame operators."""

from ledgerline.operators.checks import Rule, run_checks
from ledgerline.operators.dedup import keep_latest
from ledgerline.operators.incremental import append_new, newer_than, union_evolving, upsert
from ledgerline.operators.scd2 import current_versions, history_from_log, snapshot_check
from ledgerline.operators.validate import rejected_sales, stage_sales, valid_sales, valid_stores
from ledgerline.operators.windows import latest_n, month_to_date_sum, running_sum, top_k_per
from ledgerline.sources.landing import new_files, read_landing

__all__ = [
    "Rule", "run_checks", "keep_latest", "append_new", "newer_than", "union_evolving",
    "upsert", "current_versions", "history_from_log", "snapshot_check", "rejected_sales",
    "stage_sales", "valid_sales", "valid_stores", "latest_n", "month_to_date_sum",
    "running_sum", "top_k_per", "new_files", "read_landing",
]
