"""What the queries write for themselves (F8): compressed, and no more than is needed."""

import glob

import pyarrow.parquet as pq

from ledgerline import catalog as CT


def _codecs(folder: str) -> set[str]:
    files = glob.glob(f"{folder.removeprefix('file:')}/*.parquet")
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files
            if pq.ParquetFile(f).metadata.num_row_groups}


def test_stored_rows_are_zstd_whatever_the_session_says(spark):
    key = "spark.sql.parquet.compression.codec"
    old = spark.conf.get(key)
    spark.conf.set(key, "snappy")
    try:
        df = CT.stored(spark, spark.range(1000), "codec")
        assert _codecs(df.inputFiles()[0].rsplit("/", 1)[0]) == {"ZSTD"}
        assert df.count() == 1000
    finally:
        spark.conf.set(key, old)


def test_source_rows_are_dealt_out_before_they_are_widened(spark, tmp_dir):
    """The shuffle of a derivation carries the source's columns."""
    spark.range(50).selectExpr("id as k").write.parquet(f"{tmp_dir}/x.parquet")
    seen = []

    def build(rows):
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return rows.selectExpr("k", "repeat('wide', 9) as w")

    assert CT.derived(spark, tmp_dir, "x", "x", build).count() == 50
    assert "Repartition" in seen[0]
