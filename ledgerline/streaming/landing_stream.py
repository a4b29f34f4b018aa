"""The ELT run as one Structured Streaming query over the landing folder.

A file source lists new landing files of both kinds (names, lengths and
times; no content is read by the source). Each micro-batch hands its files
to one daily run (``foreachBatch``): stores first, then sales, then
compaction, reports, checks and export, so no two steps ever work on the
same table at once. The run reads the files, unless a run has taken them in
already.

An epoch that has been completed is recorded by (checkpoint, epoch id): a
micro-batch that Spark replays after a failure is passed over if its record
is there, and run again if not, which is harmless (see ``plans.daily_run``).

``trigger="availableNow"`` processes everything present and stops (the
daily-job shape); ``processingTime`` keeps running. ``archive_dir`` moves
consumed files there (``cleanSource=archive``; Spark archives a file in a
later micro-batch and mirrors its full source path).

``landing_stream`` is the plain source of rows of one kind, for other sinks.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.incremental import FLOOR_TS
from ledgerline.plans import daily_run as D
from ledgerline.sinks import tables as TB
from ledgerline.sources.landing import BINARY_FILE, LISTING_TASKS, PRUNING_OPTION, header_filter, text_schema


def landing_stream(spark: SparkSession, pattern: str, columns: list[str],
                   header_cols: list[str], archive_dir: str | None = None,
                   max_files_per_trigger: int | None = None,
                   multi_line: bool = True) -> DataFrame:
    reader = (spark.readStream.schema(text_schema(columns)).option(PRUNING_OPTION, "false")
              .option("header", "false").option("mode", "DROPMALFORMED")
              .option("multiLine", str(multi_line).lower())
              .option("quote", '"').option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = reader.csv(pattern).select(*columns,
                                    F.col("_metadata.file_path").alias("source_file"))
    return df.where(header_filter(header_cols))


def _stamp() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def listing_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose reads list their paths
    in a few tasks a core. A file source lists the files of every batch in
    the session it was made in, after ``run_stream`` has handed it over, so
    the setting has to stay."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    return own


EPOCH = "epoch"                          # commit record: the last completed micro-batch of a checkpoint


def _record_path(layout: D.Layout, checkpoint_dir: str) -> str:
    return layout.path("raw", f"_stream_{hashlib.md5(checkpoint_dir.rstrip('/').encode()).hexdigest()[:12]}")


def run_stream(spark: SparkSession, layout: D.Layout, checkpoint_dir: str,
               trigger: str = "availableNow", processing_time: str = "1 minute",
               archive_dir: str | None = None, run_date=None, stamp=_stamp,
               max_files_per_trigger: int | None = None, checks: str = "after_all",
               export: bool = True) -> list[StreamingQuery]:
    """Ingest new landing files, a daily run a micro-batch. ``stamp()``
    gives its run timestamp (must increase). Returns the one query (of a
    session of its own, ``listing_session``): ended for ``availableNow``,
    running otherwise."""
    record = _record_path(layout, checkpoint_dir)

    def batch(files: DataFrame, epoch_id: int) -> None:
        done = TB.committed(spark, record, EPOCH)
        if done is not None and epoch_id <= int(done):
            return
        rows = files.select("path", "length", F.unix_millis("modificationTime").alias("modified")).collect()
        D.run_daily(spark, layout, stamp(), run_date, checks, export=export, files=sorted(map(tuple, rows)))
        TB.commit(spark, record, EPOCH, str(epoch_id))

    reader = listing_session(spark).readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "{stores,sales}_*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    source = reader.load(layout.landing.rstrip("/")).select("path", "length", "modificationTime")
    if not TB.exists(spark, layout.path("silver", "silver_stores")):
        # typed tables, if there never is a file
        D.run_daily(spark, layout, FLOOR_TS, run_date, "off", export=False, files=[])
    w = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=processing_time)
    query = w.start()
    if trigger == "availableNow":
        query.awaitTermination()
    return [query]
