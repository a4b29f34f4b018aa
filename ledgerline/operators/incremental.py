"""Incremental-table operators: watermark filter, upsert (delete+insert),
idempotent append, new-key anti join, additive schema evolution.

All are pure DataFrame → DataFrame functions; persisting the result is the
job of ``ledgerline.sinks.tables`` (bucket-scoped staged rewrite).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLOOR_TS = "1900-01-01 00:00:00"


def watermark_of(target: DataFrame | None, ts_col: str, dtype: str = "timestamp_ntz"):
    """``coalesce(max(ts_col), 1900-01-01)`` of the target as a lazy scalar
    subquery column (partial max per task, one row at the end)."""
    floor = F.lit(FLOOR_TS).cast(dtype)
    if target is None:
        return floor
    return F.coalesce(target.select(F.max(ts_col).cast(dtype)).scalar(), floor)


def newer_than(df: DataFrame, target: DataFrame | None, ts_col: str) -> DataFrame:
    """Rows of ``df`` strictly newer than the target's latest ``ts_col``.

    First run (``target is None``): everything passes. The max is a single
    scalar aggregate over the target (partial max per task, then one row),
    so it scales with the target without a shuffle.
    """
    if target is None:
        return df
    dtype = df.schema[ts_col].dataType.simpleString()
    return df.where(F.col(ts_col) > watermark_of(target, ts_col, dtype))


def upsert(target: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """delete+insert: rows of ``target`` whose key appears in ``new`` are
    replaced by the ``new`` rows; other rows are kept. New columns are
    added (old rows NULL)."""
    if target is None:
        return new
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    return union_evolving(kept, new)


def append_new(target: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose ``keys`` are not yet in ``target`` (an append
    that can be retried without duplicating rows)."""
    if target is None:
        return new
    return new.join(target.select(*keys), list(keys), "left_anti")


def union_evolving(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns missing on one side become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
