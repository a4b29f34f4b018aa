"""Export swaps tables atomically and views pick up the new content."""

import os

from ledgerline.sinks.export import export_parquet
from ledgerline.sources.tables import register_exports


def test_export_twice_and_register(spark, tmp_dir):
    root = os.path.join(tmp_dir, "exports")
    one = spark.createDataFrame([(1,)], "n int")
    two = spark.createDataFrame([(2,), (3,)], "n int")
    export_parquet(spark, {"rpt_top_5_stores_by_date": one}, root)
    assert register_exports(spark, root) == ["gold.rpt_top_5_stores_by_date"]
    assert [r.n for r in spark.table("gold_rpt_top_5_stores_by_date").collect()] == [1]
    export_parquet(spark, {"rpt_top_5_stores_by_date": two, "not_exported": one}, root)
    register_exports(spark, root)
    assert sorted(r.n for r in spark.table("gold_rpt_top_5_stores_by_date").collect()) == [2, 3]
    gold = os.listdir(os.path.join(root, "gold"))
    assert gold == ["rpt_top_5_stores_by_date.parquet"]       # no .tmp / .old left


def test_only_changed_buckets_are_exported_again(spark, tmp_dir):
    from ledgerline.sinks.export import export_tables
    from ledgerline.sinks.tables import BucketedTable

    t = BucketedTable(spark, os.path.join(tmp_dir, "silver_sales"), ["k"], 8)
    t.append(spark.range(200).withColumnRenamed("id", "k"))
    root = os.path.join(tmp_dir, "out")
    first = export_tables(spark, {"silver_sales": t.path}, root)
    assert first == {"silver_sales": list(range(8))}
    assert export_tables(spark, {"silver_sales": t.path}, root) == {"silver_sales": []}
    t.append(spark.createDataFrame([(10 ** 6,)], "k long"))
    again = export_tables(spark, {"silver_sales": t.path}, root)["silver_sales"]
    assert len(again) == 1
    register_exports(spark, root)
    got = spark.sql("SELECT * FROM silver.silver_sales")
    assert got.columns == ["k"] and got.count() == 201 and got.distinct().count() == 201


def test_rows_of_one_run_are_exported_without_a_shuffle(spark, tmp_dir):
    from ledgerline.sinks.export import export_tables
    from ledgerline.sinks.tables import BucketedTable

    t = BucketedTable(spark, os.path.join(tmp_dir, "silver_sales"), ["k"], 4)
    t.append(spark.range(200).withColumnRenamed("id", "k"))
    spark.sparkContext.setJobGroup("export-one-run", "")
    try:
        export_tables(spark, {"silver_sales": t.path}, os.path.join(tmp_dir, "out"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    track = spark.sparkContext.statusTracker()
    assert [len(track.getJobInfo(j).stageIds) for j in track.getJobIdsForGroup("export-one-run")] == [1]
    got = spark.read.parquet(os.path.join(tmp_dir, "out", "silver", "silver_sales.parquet"))
    assert sorted(r.k for r in got.collect()) == list(range(200))
