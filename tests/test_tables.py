"""Typed empty tables."""

import os

from ledgerline.sinks import tables as TB


def test_empty_bucketed_table_reads_typed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    t = TB.BucketedTable(spark, path, ["k"], 4)
    t.append(spark.createDataFrame([], "k string, v int"))
    back = t.read()
    assert back is not None and back.count() == 0 and "v" in back.columns
    assert TB.read(spark, os.path.join(tmp_dir, "missing")) is None
