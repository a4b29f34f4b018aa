"""Streaming variant: availableNow runs see only new files."""

import importlib
import os
import time

from ledgerline.plans import daily_run as D
from ledgerline.sinks import tables as TB
from test_daily_run import S1, S2, T1, T2, layout, rows, sales_file, stores_file
from ledgerline.streaming import run_stream

LS = importlib.import_module("ledgerline.streaming.landing_stream")      # the package has a function of this name


def test_stream_two_runs(spark, tmp_dir):
    lay = layout(tmp_dir)
    ck = os.path.join(tmp_dir, "ck")
    stores_file(lay.landing, "stores_20240101.csv", [f"ABCDEF01,{S1},One", f"ABCDEF02,{S2},Two"])
    sales_file(lay.landing, "sales_20240101.csv", [
        f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier",
        "bad,line"], header=True)
    stamps = iter(["2024-01-02 06:00:00", "2024-01-02 06:00:01",
                   "2024-01-03 06:00:00", "2024-01-03 06:00:01"])
    run_stream(spark, lay, ck, stamp=lambda: next(stamps))
    audit = rows(spark, lay.path("raw", "raw_file_audit"), ["file_type"])
    assert [(r["file_type"], r["row_count"]) for r in audit] == [("sales", 1), ("stores", 2)]
    sales_file(lay.landing, "sales_20240102.csv", [
        f"{S2},{T2},R0002,20240102T101500.000,$3.00,cashier"])
    run_stream(spark, lay, ck, stamp=lambda: next(stamps))
    audit = rows(spark, lay.path("raw", "raw_file_audit"), ["source_file"])
    assert len(audit) == 3
    silver = rows(spark, lay.path("silver", "silver_sales"), ["transaction_id"])
    assert [r["transaction_id"] for r in silver] == [T1, T2]
    o1 = rows(spark, lay.path("gold", "rpt_transactions_by_batch"), ["batch_date"])
    assert [r["total_raw_transactions"] for r in o1] == [1, 1]


def test_stream_without_stores_and_with_export(spark, tmp_dir):
    lay = layout(tmp_dir)
    sales_file(lay.landing, "sales_20240101.csv", [f"{S1},{T1},R0001,20240101T101500.000,$10.50,cashier"])
    sales_file(lay.landing, "sales_20240102.csv", [f"{S1},{T2},R0002,20240102T101500.000,$1.50,cashier"])
    n = iter(range(10, 60))
    queries = run_stream(spark, lay, os.path.join(tmp_dir, "ck"), max_files_per_trigger=1,
                         stamp=lambda: f"2024-01-03 06:00:{next(n)}")
    assert len(queries) == 1 and not queries[0].isActive
    assert queries[0].lastProgress["batchId"] == 1            # a file a batch
    got = rows(spark, os.path.join(lay.exports, "gold", "rpt_sales_by_transaction_date.parquet"), ["transaction_date"])
    assert [str(r["total_sales_amount"]) for r in got] == ["10.50", "1.50"]


def content(spark, lay):
    return {name: rows_of(spark, lay.path(layer, name)) for layer, name in (
        ("raw", "raw_sales_snapshot"), ("raw", "raw_stores_snapshot"), ("silver", "silver_sales"),
        ("silver", "silver_stores"), ("silver", "silver_sales_rejected"), ("gold", "rpt_top_5_stores_by_date"),
        ("gold", "rpt_sales_by_transaction_date"))}


def rows_of(spark, path):
    stamps = ("ingested_at", "snapshot_updated_at", "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to",
              "valid_from", "source_file", "bucket", "segment")
    return sorted(map(str, TB.read(spark, path).drop(*stamps).collect()))


def test_processing_time_with_both_kinds_and_a_replayed_epoch(spark, tmp_dir):
    """A running stream sees files of both kinds arrive, is stopped, replays
    its last epoch and goes on; the tables are those of a batch run."""
    lay = layout(os.path.join(tmp_dir, "stream"))
    ck, n = os.path.join(tmp_dir, "ck"), iter(range(10, 60))

    def deliver(root, day):
        stores_file(root.landing, f"stores_2024010{day}.csv", [f"ABCDEF01,{S1},One{day}", f"ABCDEF0{day},{S2},Two"])
        sales_file(root.landing, f"sales_2024010{day}.csv", [
            f"{S1},{T1},R0001,20240101T101500.000,${day}.50,cashier", f"{S2},{T2},x,20240101T101500.000,$1.50,cashier"])

    def run():
        return LS.run_stream(spark, lay, ck, trigger="processingTime", processing_time="1 second", run_date="2024-01-09",
                             checks="off", export=False, stamp=lambda: f"2024-01-03 06:00:{next(n)}")[0]

    def wait(query, files):
        for _ in range(240):
            taken = D.taken_table(spark, lay).read()
            if query.exception() or (taken is not None and taken.count() == files):
                break
            time.sleep(0.5)
        query.processAllAvailable()
        query.stop()
        assert query.exception() is None and taken.count() == files

    deliver(lay, 1)
    query = run()
    wait(query, 2)
    deliver(lay, 2)
    wait(run(), 4)
    before = content(spark, lay)
    offsets = sorted((f for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit()), key=int)
    os.remove(os.path.join(ck, "commits", offsets[-1]))       # Spark lost the end of the last epoch
    crc = os.path.join(ck, "commits", f".{offsets[-1]}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    wait(run(), 4)
    assert content(spark, lay) == before
    TB.commit(spark, LS._record_path(lay, ck), LS.EPOCH, "-1")     # nor was it recorded: it runs again
    os.remove(os.path.join(ck, "commits", offsets[-1]))
    if os.path.exists(crc):
        os.remove(crc)
    wait(run(), 4)
    assert content(spark, lay) == before
    batch = layout(os.path.join(tmp_dir, "batch"))
    for day in (1, 2):
        deliver(batch, day)
        D.run_daily(spark, batch, f"2024-01-0{day + 3} 06:00:00", "2024-01-09", "off", export=False)
    assert content(spark, batch) == before


def test_a_batch_lists_its_files_in_few_tasks(spark, tmp_dir):
    lay = layout(tmp_dir)
    for day in range(100):
        stores_file(lay.landing, f"stores_2024{day:04d}.csv", [f"ABCDEF01,{S1},One"])
    before = spark.conf.get(LS.LISTING_TASKS)
    query, = run_stream(spark, lay, os.path.join(tmp_dir, "ck"), checks="off", export=False)
    track = spark.sparkContext.statusTracker()
    stages = [s for j in track.getJobIdsForGroup(str(query.runId)) for s in track.getJobInfo(j).stageIds]
    tasks = [info.numTasks for info in map(track.getStageInfo, stages) if info]
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert D.taken_table(spark, lay).read().count() == 100 and spark.conf.get(LS.LISTING_TASKS) == before
