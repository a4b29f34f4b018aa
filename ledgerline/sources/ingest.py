"""Which landing files have been taken in: a table of (path, length,
modification time), compared with a listing before any file is read.

Only files that are new or have changed are handed to the reader; a run
without any reads no landing byte. Files are recorded after all tables of
their run are complete, so a crashed run's files are read again (every step
after the reader is a no-op on rows it has seen). A changed file is read
again under its old name; its audited row count stays the first one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sinks.versions import VersionedTable
from ledgerline.sources.landing import file_listing

LISTING = "path string, length long, modified long"


def listing(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(URI, length, modification time) of the files matching a glob."""
    return file_listing(spark, pattern)


def unseen(spark: SparkSession, files: Sequence[tuple[str, int, int]], taken: VersionedTable) -> list[tuple]:
    """Those of ``files`` that are not recorded as they are now."""
    known = taken.read() if files else None
    if known is None:
        return list(files)
    now = spark.createDataFrame(list(files), LISTING)
    return sorted(map(tuple, now.join(known.select("path", "length", "modified"), ["path", "length", "modified"],
                                      "left_anti").collect()))


def record(spark: SparkSession, files: Sequence[tuple[str, int, int]], taken: VersionedTable, run_ts) -> None:
    """Add files (of one run) to the table; one small file a run."""
    if files:
        rows = spark.createDataFrame(list(files), LISTING).coalesce(1)
        taken.append(rows.withColumn("taken_at", F.lit(str(run_ts)).cast("timestamp_ntz")))


def taken_files(taken: VersionedTable) -> DataFrame | None:
    """The newest record of every path."""
    rows = taken.read()
    if rows is None:
        return None
    return rows.groupBy("path").agg(F.max_by(F.struct("length", "modified", "taken_at"), "taken_at").alias("r")) \
        .select("path", "r.*")
