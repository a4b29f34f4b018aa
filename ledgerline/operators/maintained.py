"""Sums and counts over a versioned table, kept by signed deltas.

The state is a table of groups with the sums of some measures and the number
of rows. What has happened to the source since the state was made follows
from its two manifests: rows of parts that are gone count minus one, rows of
parts that were added count one, and rows that were only moved (a rewritten
bucket, a compaction) cancel out. So only those parts are read, and only the
state's parts that hold a group of the delta are written. The source's
version is part of the state's manifest: state and version change together,
and a crash can't apply a delta twice. If the old version has expired, the
state is made from all rows again.

Measures must be exact under addition (decimals, counts), not floating.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import work_dir
from ledgerline.sinks.versions import VersionedTable

ROWS, SOURCE = "n_rows", "source_version"


def _sums(rows: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in (*measures, ROWS)])


def refresh(state: VersionedTable, source: VersionedTable, rows_of: Callable[[DataFrame], DataFrame],
            by: Sequence[str], measures: Sequence[str] = ()) -> dict:
    """Bring ``state`` to the newest version of ``source``. ``rows_of``
    gives the group columns and measures of each source row (measures are
    never NULL; the state's level columns are among ``by``). Returns what
    was done: versions, parts read, level values written (None: all)."""
    now, base = source.manifest(), state.manifest()
    old = source.manifest(base.meta[SOURCE]) if base is not None and SOURCE in base.meta else None
    done = {"from": old.version if old else None, "to": now.version}
    if old is not None and old.version == now.version:
        return done | {"parts_read": 0, "written": []}

    def signed(m, keep, sign: int) -> DataFrame:
        rows = rows_of(source.read(m, keep=keep)).withColumn(ROWS, F.lit(1).cast("long"))
        for c in (*measures, ROWS):
            rows = rows.withColumn(c, (F.col(c) * sign).cast(rows.schema[c].dataType))
        return rows.select(*by, *measures, ROWS)

    meta = {SOURCE: now.version}
    if old is None:
        state.change(_sums(signed(now, None, 1), by, measures), drop=lambda p: True, base=base, meta=meta)
        return done | {"parts_read": len(now.parts), "written": None}
    was, has = set(old.parts), set(now.parts)
    delta = signed(now, lambda p: p not in was, 1).unionByName(signed(old, lambda p: p not in has, -1))
    some = F.col(ROWS) != 0
    for c in measures:
        some = some | (F.col(c) != 0)
    spark = state.spark
    path = work_dir(spark, "state-delta")
    _sums(delta, by, measures).where(some).write.parquet(path)
    delta = spark.read.parquet(path)
    levels = list(state.levels)
    touched = {tuple(map(str, r)) for r in delta.select(*levels).distinct().collect()} if levels else {()}
    done |= {"parts_read": len(has ^ was), "written": sorted(touched)}
    if delta.isEmpty():
        state.change(None, base=base, meta=meta)
        return done | {"written": []}
    rest = state.read(base, keep=lambda p: p.values in touched).unionByName(delta)
    state.change(_sums(rest, by, measures).where(F.col(ROWS) > 0), drop=lambda p: p.values in touched, base=base, meta=meta)
    return done
