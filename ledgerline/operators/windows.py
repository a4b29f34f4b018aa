"""Window-shaped operators: latest-N, top-k per group, running sums.

Scale notes
-----------
* ``latest_n`` never uses an un-partitioned window (that would pull every
  row into one task). ``orderBy(...).limit(n)`` plans as
  ``TakeOrderedAndProject``: each task keeps its own top n, the driver
  merges n x tasks rows.
* ``top_k_per`` uses ``row_number() <= k``; Catalyst adds a partial
  ``WindowGroupLimit`` *before* the shuffle, so a hot group contributes at
  most k rows per map task to the exchange.
* ``running_sum`` is meant for already-aggregated inputs (one row per
  day); its partitions are small by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols: Sequence[str | Column] | str | Column) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_n(df: DataFrame, col: str, n: int, distinct: bool = False) -> DataFrame:
    """Rows with the ``n`` largest values of ``col`` (descending).

    ``distinct=True`` returns the ``n`` latest distinct values of ``col``
    only (one column). The partial aggregate of ``distinct`` runs map-side.
    """
    if distinct:
        return df.select(col).where(F.col(col).isNotNull()).distinct() \
            .orderBy(F.col(col).desc()).limit(n)
    return df.orderBy(F.col(col).desc_nulls_last()).limit(n)


def values_of_latest_rows(df: DataFrame, col: str, n: int) -> DataFrame:
    """Distinct values of ``col`` among the ``n`` latest *rows*.

    This is what ``select distinct c ... qualify row_number() over
    (order by c desc) <= n`` computes: the window runs before DISTINCT.
    """
    return df.select(col).orderBy(F.col(col).desc_nulls_last()).limit(n).distinct()


def top_k_per(df: DataFrame, partition: Sequence[str] | str,
              order_by: Sequence[Column | str], k: int,
              rank_col: str | None = None) -> DataFrame:
    """Top ``k`` rows per group by ``order_by`` (ties broken by the later
    order keys; give a unique tail key for a deterministic result)."""
    w = Window.partitionBy(*_cols(partition)).orderBy(*_cols(order_by))
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def running_sum(df: DataFrame, partition: Sequence[str | Column] | str | Column,
                order_by: Sequence[str | Column] | str | Column, value: str,
                out: str) -> DataFrame:
    """Cumulative ``sum(value)`` per partition in ``order_by`` order
    (ROWS UNBOUNDED PRECEDING .. CURRENT ROW)."""
    w = (Window.partitionBy(*_cols(partition)).orderBy(*_cols(order_by))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(value).over(w))


def month_to_date_sum(df: DataFrame, date_col: str, value: str, out: str) -> DataFrame:
    """Running sum that restarts at each calendar month of ``date_col``."""
    return running_sum(df, F.trunc(F.col(date_col), "MM"), date_col, value, out)
