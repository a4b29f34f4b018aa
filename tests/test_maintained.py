"""Sums kept by signed deltas equal sums of all rows."""

import os
import random

from pyspark.sql import functions as F

from ledgerline.operators import maintained as M
from ledgerline.plans import daily_run as D
from ledgerline.plans import reports as R
from ledgerline.sinks import tables as TB
from ledgerline.sinks.versions import VersionedTable
from test_daily_run import S1, S2, layout, sales_file, stores_file


def rows_of(df):
    return df.select((F.col("id") % 5).alias("g"), F.col("v").cast("decimal(38,2)").alias("v"))


def test_state_follows_every_change(spark, tmp_dir):
    source = TB.BucketedTable(spark, os.path.join(tmp_dir, "s"), ["id"], 4)
    state = VersionedTable(spark, os.path.join(tmp_dir, "g"), {"g": "int"})
    rng = random.Random(3)

    def same():
        got = M.refresh(state, source, rows_of, ["g"], ["v"])
        want = rows_of(source.read()).groupBy("g").agg(F.sum("v").alias("v"), F.count("*").alias("n_rows"))
        assert sorted(map(tuple, state.read().select("g", "v", "n_rows").collect())) == sorted(map(tuple, want.collect()))
        return got

    source.append(spark.range(100).withColumn("v", F.lit(1.25).cast("decimal(9,2)")))
    assert same()["written"] is None
    assert same()["parts_read"] == 0
    source.append(spark.range(100, 120).where("id % 5 = 2").withColumn("v", F.lit(7).cast("decimal(9,2)")))
    assert same()["written"] == [("2",)]
    for _ in range(3):
        b = rng.randrange(4)
        part = source.read().where(F.col("bucket") == b)
        source.rewrite([b], part.where("id % 7 <> 1").withColumn("v", F.when(F.col("id") % 5 == 3, -F.col("v")).otherwise(F.col("v"))))
        assert 0 < same()["parts_read"] < 20
    TB.compact(source, 0)
    assert same()["written"] == []                            # moved rows cancel out
    source.rewrite([0, 1, 2, 3], source.read().where("id % 5 <> 4"))
    same()
    assert 4 not in {r.g for r in state.read().collect()}
    for _ in range(4):
        source.append(spark.range(1).withColumn("v", F.lit(1).cast("decimal(9,2)")))
    source.expire(keep=1)                                     # the state's version is gone: made anew
    assert same()["written"] is None


def test_reports_of_random_runs_equal_a_full_refresh(spark, tmp_dir):
    """Sales that change amount, day and validity from run to run."""
    rng, lay = random.Random(5), layout(tmp_dir)
    uid = lambda i: f"{i:08d}-0000-0000-0000-000000000000"
    for day in range(1, 5):
        stores_file(lay.landing, f"stores_2024010{day}.csv", [f"ABCDEF0{day},{S1},One", f"ABCDEF02,{S2},Two{day}"])
        lines = []
        for i in rng.sample(range(30), 12):
            when = f"2024{rng.choice(['01', '02'])}0{rng.randint(1, 3)}T101500.000"
            lines.append(f"{rng.choice([S1, S2])},{uid(i)},{rng.choice(['R0001', 'x'])},{when},${rng.randint(1, 9)}.50,cashier")
        sales_file(lay.landing, f"sales_2024010{day}.csv", lines)
        D.run_daily(spark, lay, f"2024-03-0{day} 06:00:00", run_date="2024-03-09", checks="off", export=False)
        read = lambda n, layer="silver": D._visible(TB.read(spark, lay.path(layer, n)))
        sales, rejected, stores = read("silver_sales"), read("silver_sales_rejected"), read("silver_stores")
        audit = R.audit_by_batch(read("raw_file_audit", "raw"), sales, rejected)
        for name, df, layer in (("silver_sales_audit_by_batch", audit, "silver"),
                                ("rpt_sales_by_transaction_date", R.output2(sales, "2024-03-09"), "gold"),
                                ("rpt_top_5_stores_by_date", R.output3(sales, stores, "2024-03-09"), "gold")):
            assert sorted(map(str, read(name, layer).collect())) == sorted(map(str, df.collect())), (day, name)
    assert D.refresh_states(spark, lay)["by_day_store"]["parts_read"] == 0
