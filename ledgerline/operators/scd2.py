"""Slowly Changing Dimension type 2 snapshot, "check" strategy.

Per key of the (already de-duplicated) incoming rows:

* no current version            → insert a new version;
* some check column differs     → close the current version
                                  (``dbt_valid_to = run_ts``) and insert;
* all check columns equal       → nothing (lineage columns stay as first seen);
* key absent from the input     → unchanged (hard deletes are not closed).

Plan: one full outer join of the *current* versions with the incoming
rows on the key (a single shuffle on the key); each joined row emits up
to two output rows via ``inline`` of a 2-element array. Closed history
rows never enter the join. Comparing is NULL-safe (``<=>``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _ts(run_ts) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(str(run_ts)).cast("timestamp_ntz")


def scd_id(key: Column, run_ts: Column) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), run_ts.cast("string")))


def current_versions(history: DataFrame) -> DataFrame:
    """The open version of every key (``dbt_valid_to IS NULL``); the
    predicate is pushed into the Parquet scan."""
    return history.where(F.col("dbt_valid_to").isNull())


def with_scd_columns(incoming: DataFrame, key: str, run_ts) -> DataFrame:
    ts = _ts(run_ts)
    return incoming.select(
        "*",
        scd_id(F.col(key), ts).alias("dbt_scd_id"),
        ts.alias("dbt_updated_at"),
        ts.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def snapshot_check(history: DataFrame | None, incoming: DataFrame, key: str,
                   check_cols: Sequence[str], run_ts) -> DataFrame:
    """The whole new history after one snapshot run (see module doc).

    ``incoming`` must hold at most one row per ``key`` and no NULL key.
    """
    if history is None:
        return with_scd_columns(incoming, key, run_ts)
    ts = _ts(run_ts)
    closed = history.where(F.col("dbt_valid_to").isNotNull())
    return closed.unionByName(snapshot_merge(current_versions(history), incoming, key,
                                             check_cols, ts))


def snapshot_merge(current: DataFrame, incoming: DataFrame, key: str,
                   check_cols: Sequence[str], run_ts) -> DataFrame:
    """New content of the *current* part of the history: untouched current
    versions, closed ones, and inserted ones."""
    ts = _ts(run_ts)
    hist_cols = current.columns
    new = with_scd_columns(incoming, key, ts)
    new_cols = new.columns
    c = current.select(F.struct(*hist_cols).alias("c"), F.col(key).alias("__k"))
    n = new.select(F.struct(*new_cols).alias("n"), F.col(key).alias("__k"))
    j = c.join(n, "__k", "full_outer")

    has_c, has_n = F.col("c").isNotNull(), F.col("n").isNotNull()
    same = F.lit(True)
    for col in check_cols:
        same = same & F.col(f"c.{col}").eqNullSafe(F.col(f"n.{col}"))
    changed = has_c & has_n & ~same
    insert = has_n & (~has_c | changed)

    def from_c(name: str) -> Column:
        if name == "dbt_valid_to":
            return F.when(changed, ts).otherwise(F.col("c.dbt_valid_to")).alias(name)
        return F.col(f"c.{name}").alias(name)

    def from_n(name: str) -> Column:
        if name in new_cols:
            return F.col(f"n.{name}").alias(name)
        return F.lit(None).cast(current.schema[name].dataType).alias(name)

    kept = F.when(has_c, F.struct(*[from_c(x) for x in hist_cols]))
    added = F.when(insert, F.struct(*[from_n(x) for x in hist_cols]))
    rows = F.filter(F.array(kept, added), lambda r: r.isNotNull())
    return j.select(F.inline(rows))


def history_from_log(log: DataFrame, key: str, check_cols: Sequence[str],
                     run_col: str, ts_col: str) -> DataFrame:
    """Bulk form: the history that successive ``snapshot_check`` runs would
    build from ``log`` (one row per key and run, runs ordered by
    ``run_col``, ``ts_col`` = that run's stamp). One shuffle by key; used to
    backfill many runs at once and to cross-check the incremental form.
    The window holds all runs of one key in one task, so it suits logs with
    a bounded number of runs per key (each key appears at most once per
    run); the incremental ``snapshot_check`` has no such limit."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(run_col)
    prev = F.lag(F.struct(*check_cols)).over(w)
    cur = F.struct(*check_cols)
    kept = (log.withColumn("__first", F.row_number().over(w) == 1)
            .withColumn("__same", prev.eqNullSafe(cur))
            .where(F.col("__first") | ~F.col("__same")))
    w2 = Window.partitionBy(key).orderBy(run_col)
    ts = F.col(ts_col)
    return (kept.select(
        *[c for c in log.columns if c not in (run_col, ts_col)],
        scd_id(F.col(key), ts).alias("dbt_scd_id"),
        ts.alias("dbt_updated_at"),
        ts.alias("dbt_valid_from"),
        F.lead(ts).over(w2).alias("dbt_valid_to"),
    ))

