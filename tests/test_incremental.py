"""Watermark strictness, upsert and idempotent append."""

import datetime as dt

from ledgerline.operators.incremental import append_new, newer_than, union_evolving, upsert

TS = dt.datetime(2024, 1, 2, 6)


def test_watermark_is_strict(spark):
    target = spark.createDataFrame([(1, TS)], "k int, ts timestamp_ntz")
    df = spark.createDataFrame([(2, TS), (3, TS + dt.timedelta(seconds=1))],
                               "k int, ts timestamp_ntz")
    assert [r.k for r in newer_than(df, target, "ts").collect()] == [3]
    assert newer_than(df, None, "ts").count() == 2
    empty = spark.createDataFrame([], "k int, ts timestamp_ntz")
    assert newer_than(df, empty, "ts").count() == 2          # max of nothing → 1900


def test_upsert_and_append(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")],
                                   "k string, n int, v string")
    new = spark.createDataFrame([("b", 2, "Y"), ("c", 4, "w"), (None, 3, "Z")],
                                "k string, n int, v string")
    got = sorted(upsert(target, new, ["k", "n"]).collect(), key=repr)
    assert [tuple(r) for r in got] == sorted(
        [("a", 1, "x"), (None, 3, "z"), ("b", 2, "Y"), ("c", 4, "w"), (None, 3, "Z")], key=repr)
    once = target.unionByName(append_new(target, new, ["k", "n"]))
    twice = once.unionByName(append_new(once, new, ["k", "n"]))
    assert once.count() == 5 and twice.count() == 6          # NULL keys never match


def test_union_evolving_adds_columns(spark):
    a = spark.createDataFrame([(1,)], "k int")
    b = spark.createDataFrame([(2, "x")], "k int, extra string")
    rows = sorted(tuple(r) for r in union_evolving(a, b).collect())
    assert rows == [(1, None), (2, "x")]
