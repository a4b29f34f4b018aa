"""Window operators against brute force on random small inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.dedup import keep_latest
from ledgerline.operators.windows import latest_n, top_k_per, values_of_latest_rows

rows_st = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.integers(0, 3)),
                   min_size=1, max_size=30)


@settings(max_examples=15, deadline=None)
@given(rows_st)
def test_keep_latest_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, w int")
    got = sorted(tuple(r) for r in keep_latest(df, ["k"], [F.col("v").desc()]).collect())
    want = sorted(max((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))
                  for k in {r[0] for r in rows})
    assert got == want


@settings(max_examples=15, deadline=None)
@given(rows_st, st.integers(1, 3))
def test_top_k_brute_force(spark, rows, k):
    rows = list({(g, v, w) for g, v, w in rows})          # unique ordering keys
    df = spark.createDataFrame(rows, "g string, v int, w int")
    got = sorted(tuple(r) for r in top_k_per(df, "g", [F.col("v").desc(), F.col("w")], k,
                                             rank_col="rk").collect())
    want = []
    for g in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want += [r + (i + 1,) for i, r in enumerate(ordered[:k])]
    assert got == sorted(want)


@settings(max_examples=15, deadline=None)
@given(rows_st, st.integers(1, 8))
def test_latest_n_and_latest_rows(spark, rows, n):
    df = spark.createDataFrame(rows, "g string, v int, w int")
    dates = sorted({r[1] for r in rows}, reverse=True)[:n]
    assert sorted(r.v for r in latest_n(df, "v", n, distinct=True).collect()) == sorted(dates)
    top_rows = sorted((r[1] for r in rows), reverse=True)[:n]
    assert sorted(r.v for r in values_of_latest_rows(df, "v", n).collect()) == sorted(
        set(top_rows))
    assert len(latest_n(df, "v", n).collect()) == min(n, len(rows))
