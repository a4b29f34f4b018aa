"""Stored distinct states: merging equals counting all rows at once."""

from pyspark.sql import functions as F

from ledgerline.operators import sketches as K


def test_states_of_runs_merge(spark):
    rows = spark.range(0, 60_000, 1, 6).select((F.col("id") % 2).alias("g"), (F.col("id") % 20_011).alias("v"))
    parts = [K.distinct_state(rows.where(f"v % 3 <> {i}"), ["g"], "v") for i in (0, 1)]
    both = K.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[0]), ["g"])
    got = {r.g: r.distinct_estimate for r in K.estimate(both).collect()}
    want = {r.g: r.n for r in rows.groupBy("g").agg(F.countDistinct("v").alias("n")).collect()}
    assert all(abs(got[g] - n) <= 3 * K.error() * n for g, n in want.items()) and len(got) == 2
    whole = {r.g: r.distinct_estimate for r in K.estimate(K.distinct_state(rows, ["g"], "v")).collect()}
    assert all(abs(whole[g] - got[g]) <= 0.01 * got[g] for g in got)


def test_small_and_empty_groups(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, None), (None, "z")], "g int, v string")
    got = {r.g: r.distinct_estimate for r in K.estimate(K.distinct_state(rows, ["g"], "v")).collect()}
    assert got[1] == 1 and got[None] == 1 and got[2] in (0, None)
    assert K.estimate(K.distinct_state(rows.limit(0), ["g"], "v")).collect() == []
