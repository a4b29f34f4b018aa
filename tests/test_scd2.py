"""SCD2 snapshot: life cycle and incremental == bulk history."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.scd2 import current_versions, history_from_log, snapshot_check

SCHEMA = "k string, a string, b string, note string"
TS = ["2024-01-0%d 06:00:00" % i for i in range(1, 8)]


def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def hist_rows(h):
    return sorted(((r.k, r.a, r.b, str(r.dbt_valid_from), str(r.dbt_valid_to))
                   for r in h.collect()), key=repr)


def test_life_cycle(spark):
    h = snapshot_check(None, df(spark, [("x", "Foo", "g", "d1")]), "k", ["a", "b"], TS[0])
    h = snapshot_check(h, df(spark, [("x", "Foo", "g", "d2")]), "k", ["a", "b"], TS[1])
    h = snapshot_check(h, df(spark, [("x", "Bar", "g", "d3")]), "k", ["a", "b"], TS[2])
    h = snapshot_check(h, df(spark, [("x", "Bar", "g", "d3")]), "k", ["a", "b"], TS[3])
    rows = hist_rows(h)
    assert rows == [("x", "Bar", "g", "2024-01-03 06:00:00", "None"),
                    ("x", "Foo", "g", "2024-01-01 06:00:00", "2024-01-03 06:00:00")]
    # unchanged re-delivery keeps the first lineage values
    assert [r.note for r in h.orderBy("dbt_valid_from").collect()] == ["d1", "d3"]
    assert current_versions(h).count() == 1


def test_null_safe_compare_and_absent_keys(spark):
    h = snapshot_check(None, df(spark, [("x", None, "g", "1"), ("y", "v", "g", "1")]),
                       "k", ["a", "b"], TS[0])
    h = snapshot_check(h, df(spark, [("x", None, "g", "2")]), "k", ["a", "b"], TS[1])
    assert h.count() == 2 and current_versions(h).count() == 2


runs = st.lists(st.dictionaries(st.sampled_from("pqrs"),
                                st.tuples(st.sampled_from(["A", "B", None]),
                                          st.sampled_from(["g", "h"])), max_size=4),
                min_size=1, max_size=4)


@settings(max_examples=12, deadline=None)
@given(runs)
def test_incremental_equals_bulk(spark, rs):
    h = None
    log = []
    for i, run in enumerate(rs):
        rows = [(k, a, b, f"r{i}") for k, (a, b) in sorted(run.items())]
        log += [r + (i, TS[i]) for r in rows]
        if rows:
            h = snapshot_check(h, df(spark, rows), "k", ["a", "b"], TS[i])
    if not log:
        return
    L = spark.createDataFrame(log, SCHEMA + ", run int, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    bulk = history_from_log(L, "k", ["a", "b"], "run", "ts")
    assert hist_rows(h) == hist_rows(bulk)
    assert sorted(r.dbt_scd_id for r in h.collect()) == sorted(
        r.dbt_scd_id for r in bulk.collect())


@settings(max_examples=10, deadline=None)
@given(runs)
def test_history_invariants(spark, rs):
    """One open version per key; a key's versions do not overlap and each
    closed version ends where the next begins."""
    h = None
    for i, run in enumerate(rs):
        rows = [(k, a, b, f"r{i}") for k, (a, b) in sorted(run.items())]
        if rows:
            h = snapshot_check(h, df(spark, rows), "k", ["a", "b"], TS[i])
    if h is None:
        return
    by_key = {}
    for r in h.collect():
        by_key.setdefault(r.k, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.dbt_valid_from)
        assert sum(v.dbt_valid_to is None for v in versions) == 1
        assert versions[-1].dbt_valid_to is None
        for a, b in zip(versions, versions[1:]):
            assert a.dbt_valid_to == b.dbt_valid_from
            assert (a.a, a.b) != (b.a, b.b)
