"""Keep-latest de-duplication (one row per key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                tie_break_all: bool = True) -> DataFrame:
    """One row per ``keys``: the first by ``order_by`` (give descending
    columns for "latest").

    With ``tie_break_all`` every remaining column is appended (descending,
    nulls last) so ties resolve the same way on every run.

    Plan: ``row_number() = 1`` becomes a partial ``WindowGroupLimit`` that
    keeps one row per key per map task before the shuffle, so a key that
    holds a large share of the rows is cut down map-side.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if tie_break_all:
        named = {c for c in order_by if isinstance(c, str)}
        rest = [c for c in df.columns if c not in keys and c not in named]
        order += [F.col(c).desc_nulls_last() for c in rest]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
