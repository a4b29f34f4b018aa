"""Raw file audit: one row per landing file with its readable row count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as C
from ledgerline.functions.parse import batch_date_of
from ledgerline.sources.landing import file_name, new_files


def _ts(run_ts):
    return F.lit(str(run_ts)).cast("timestamp_ntz") if not isinstance(run_ts, F.Column) \
        else run_ts


def files_of(landing: DataFrame, file_type: str, file_re: str, run_ts) -> DataFrame:
    """Per-file ``count(*)`` of readable rows (header and malformed lines
    excluded). Partial counts run map-side: the shuffle carries one row
    per file and task, however large a file is."""
    return (landing.where(F.col("source_file").isNotNull())
            .groupBy("source_file").agg(F.count("*").alias("row_count"))
            .select("source_file",
                    F.lit(file_type).alias("file_type"),
                    batch_date_of(file_name("source_file"), file_re).alias("batch_date"),
                    "row_count",
                    _ts(run_ts).alias("processed_at")))


def file_audit(stores: DataFrame, sales: DataFrame, audit: DataFrame | None,
               run_ts) -> DataFrame:
    """Audit rows to *append*: files of both kinds not yet in ``audit``.
    A re-uploaded file name keeps its first row count."""
    files = files_of(stores, "stores", C.STORES_FILE_RE, run_ts).unionByName(
        files_of(sales, "sales", C.SALES_FILE_RE, run_ts))
    return new_files(files, audit)
