"""A run that is cut off at any write, and run again, gives what an
undisturbed run gives; stored tables may get columns; files stay few."""

import os
from unittest import mock

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.plans import daily_run as D
from ledgerline.sinks import tables as TB
from ledgerline.sinks.versions import ConcurrentWrite, VersionedTable
from ledgerline.sources import ingest
from ledgerline.sources.tables import register_views
from test_daily_run import S1, layout, sales_file, stores_file

STAMPS = ["2024-01-02 06:00:00", "2024-01-03 06:00:00", "2024-01-04 06:00:00"]


def landing(lay, day, changed):
    uid = lambda i: f"{i:08d}-0000-0000-0000-000000000000"
    stores_file(lay.landing, f"stores_2024010{day}.csv", [f"ABCDEF01,{S1},One{day}"])
    ids = range(12) if day == 1 else [*changed, *range(20, 32)]
    sales_file(lay.landing, f"sales_2024010{day}.csv",
               [f"{S1},{uid(i)},{'R%05d' % i if i % 5 else 'x'},2024010{day}T101500.000,${day}.{i:02d},cashier" for i in ids])


def content(spark, lay):
    out = {}
    for name, path in D._all_paths(lay).items():
        df = D._visible(TB.read(spark, path))
        keep = [c for c in df.columns if c not in ("ingested_at", "snapshot_updated_at", "processed_at", "dbt_scd_id",
                                                   "dbt_updated_at", "dbt_valid_from", "processing_date", "valid_from")]
        keep = [F.col(c).isNull().alias(c) if c == "dbt_valid_to" else
                F.element_at(F.split(c, "/"), -1).alias(c) if c == "source_file" else F.col(c) for c in keep]
        out[name] = sorted(map(str, df.select(*keep).collect()))
    return out


def two_days(spark, tmp_dir, where, crash=None):
    lay = layout(os.path.join(tmp_dir, where))
    run = lambda i: D.run_daily(spark, lay, STAMPS[i], run_date="2024-01-05", checks="off", export=False)
    landing(lay, 1, [])
    run(0)
    landing(lay, 2, [1, 2, 3, 5])
    if crash is None:
        run(1)
    else:
        owner, name, nth, after = crash
        real, calls = getattr(owner, name), []

        def cut(*a, **k):
            calls.append(1)
            if len(calls) == nth and not after:
                raise InterruptedError
            out = real(*a, **k)
            if len(calls) == nth:
                raise InterruptedError
            return out

        with mock.patch.object(owner, name, cut), pytest.raises(InterruptedError):
            run(1)
        run(2)
    return content(spark, lay)


def test_crash_anywhere_then_rerun(spark, tmp_dir):
    clean = two_days(spark, tmp_dir, "clean")
    assert len(clean["silver_sales"]) > 15
    cuts = [(VersionedTable, "publish", 4, True), (VersionedTable, "publish", 6, False),
            (TB, "commit", 2, False), (ingest, "record", 1, False)]
    for i, crash in enumerate(cuts):
        assert two_days(spark, tmp_dir, f"crash{i}", crash) == clean, crash


def test_crash_at_every_publication_of_a_table(spark, tmp_dir):
    """Whatever is written but not published is not seen, and goes when it is old."""
    t = TB.BucketedTable(spark, os.path.join(tmp_dir, "t"), ["id"], 2)
    t.append(spark.range(40))
    before = sorted(r.id for r in t.read().collect())
    t.write(spark.range(40, 50), t.manifest())
    assert sorted(r.id for r in t.read().collect()) == before
    assert t.expire() == []
    assert len(t.expire(orphan_s=-60)) == 1 and t.expire(orphan_s=-60) == []
    assert sorted(r.id for r in t.read().collect()) == before


def test_a_reader_finishes_on_its_version(spark, tmp_dir):
    t = TB.BucketedTable(spark, os.path.join(tmp_dir, "t"), ["id"], 4)
    t.append(spark.range(100).withColumn("v", F.lit(1)))
    reader = t.read()
    t.rewrite([0, 1], t.read().where("bucket < 2").withColumn("v", F.lit(2)))
    t.overwrite(spark.range(7).withColumn("v", F.lit(3)))
    assert reader.count() == 100 and reader.where("v <> 1").isEmpty()
    assert t.read().count() == 7
    assert t.read(t.manifest(2)).where("v = 2 AND bucket < 2").count() == t.read(t.manifest(2)).where("bucket < 2").count()
    t.append(spark.range(7, 9).withColumn("v", F.lit(4)))
    gone = t.expire(keep=2)
    assert t.versions() == [3, 4] and gone and t.read().count() == 9
    assert not any(n in f for f in gone for p in t.manifest().parts for n in [p.run])


def test_two_writers_do_not_both_win(spark, tmp_dir):
    t = VersionedTable(spark, os.path.join(tmp_dir, "t"))
    t.append(spark.range(3))
    base = t.manifest()
    one, two = t.write(spark.range(3, 5), base), t.write(spark.range(5, 9), base)
    t.publish(base, one, spark.range(1).schema)
    with pytest.raises(ConcurrentWrite):
        t.publish(base, two, spark.range(1).schema)
    assert sorted(r.id for r in t.read().collect()) == [0, 1, 2, 3, 4]


def written(t):
    """Rows of the newest run of a table, by segment and openness."""
    run = max(p.run for p in t.manifest().parts)
    rows = t.read(keep=lambda p: p.run == run)
    return {s: rows.where(F.col("segment") == s).count() for s in ("open", "closed")}


def test_a_changed_key_writes_one_closed_row(spark, tmp_dir):
    """Five runs that change one key each: closed history is never written again."""
    t = TB.BucketedTable(spark, os.path.join(tmp_dir, "t"), ["k"], 4, segments=True)
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("v"))
    try:
        D.snapshot_into(spark, t, rows, "k", ["v"], STAMPS[0])
        for i in range(5):
            now = rows.where("k = '7'").withColumn("v", F.lit(f"b{i}"))
            got = D.snapshot_into(spark, t, now, "k", ["v"], f"2024-02-0{i + 1} 06:00:00")
            assert got["changed_buckets"] == 1 and got["files_read"] == 1
            assert written(t)["closed"] == 1 and 30 < written(t)["open"] < 80
        known = D.snapshot_into(spark, t, rows.where("k <> '7'"), "k", ["v"], "2024-03-01 06:00:00")
        assert known["changed_buckets"] == 0
        fresh = rows.select(F.concat("k", F.lit("x")).alias("k"), "v").where("k = '9x'")
        D.snapshot_into(spark, t, fresh, "k", ["v"], "2024-03-02 06:00:00")
        assert written(t) == {"open": 1, "closed": 0}
    finally:
        D._drop_scratch(spark)
    hist = t.read()
    assert hist.count() == 206 and hist.where("k = '7'").count() == 6
    assert hist.where("segment = 'open'").count() == hist.where("dbt_valid_to IS NULL").count() == 201
    versions = [(r.v, r.dbt_valid_to) for r in hist.where("k = '7'").orderBy("dbt_valid_from").collect()]
    assert [v for v, _ in versions] == ["a", "b0", "b1", "b2", "b3", "b4"] and versions[-1][1] is None


def test_lookup_opens_only_files_that_may_match(spark, tmp_dir):
    t = TB.BucketedTable(spark, os.path.join(tmp_dir, "t"), ["id"], 8)
    for i in range(4):
        t.append(spark.range(i * 1000, (i + 1) * 1000))
    keys = t.with_bucket(spark.createDataFrame([(5,), (2500,), (99_999,)], "id long"))
    found = t.lookup(keys)
    assert found.files == 32 and found.files_in_buckets <= 12 and 2 <= found.files_read <= 4
    assert sorted(r.id for r in found.rows.join(keys, "id", "left_semi").collect()) == [5, 2500]
    assert "PartitionFilters" in t.read().where("bucket = 3")._jdf.queryExecution().toString()
    none = t.lookup(t.with_bucket(spark.range(10**6, 10**6 + 3)))
    assert none.files_read <= 1
    assert t.lookup(t.with_bucket(spark.range(0))).rows is None
    assert not TB.may_hold(TB.bloom(np.arange(1000, dtype=np.int64) * 7919), np.zeros(0, np.int64))
    odd = np.random.default_rng(1).integers(-2**62, 2**62, 5000)
    assert all(TB.may_hold(TB.bloom(odd[:2500]), odd[i:i + 1]) for i in range(2500))
    assert sum(TB.may_hold(TB.bloom(odd[:2500]), odd[i:i + 1]) for i in range(2500, 5000)) < 100


def test_columns_may_be_added(spark, tmp_dir):
    t = TB.BucketedTable(spark, os.path.join(tmp_dir, "t"), ["id"], 2)
    t.append(spark.range(10))
    t.append(spark.range(10, 20).withColumn("extra", F.lit("x")))
    t.append(spark.range(20, 30))
    t.rewrite([0], t.read().where("bucket = 0"))
    got = t.read()
    assert set(got.columns) == {"id", "extra", "bucket"} and got.count() == 30
    assert sorted(r.id for r in got.where("extra = 'x'").collect()) == list(range(10, 20))


def test_an_append_writes_a_file_a_bucket(spark, tmp_dir):
    t = TB.BucketedTable(spark, os.path.join(tmp_dir, "t"), ["id"], 8)
    t.append(spark.range(0, 5000, 1, 40))
    files = TB.files_per_bucket(spark, t.path)
    assert len(files) == 8 and max(map(len, files.values())) == 1
    assert TB.compact(t, 32) == []
    t.append(spark.range(5000, 5100))
    assert len(TB.compact(t, 1)) == 8 and t.read().count() == 5100
    assert max(map(len, TB.files_per_bucket(spark, t.path).values())) == 1


def test_views_of_evolved_tables(spark, tmp_dir):
    """A view shows old and new columns of a table that has got one, and the
    newest version of one that was rewritten."""
    t = TB.BucketedTable(spark, os.path.join(tmp_dir, "t"), ["id"], 2)
    t.append(spark.range(10))
    t.append(spark.range(10, 20).withColumn("extra", F.lit("x")))
    plain = VersionedTable(spark, os.path.join(tmp_dir, "p"))
    plain.append(spark.range(3))
    plain.overwrite(spark.range(5).withColumn("more", F.lit(1)))
    none = VersionedTable(spark, os.path.join(tmp_dir, "n"))
    none.append(spark.range(0))
    paths = {"evolved.t": t.path, "evolved.p": plain.path, "evolved.n": none.path, "evolved.x": tmp_dir + "/missing"}
    assert register_views(spark, paths, {"bucket"}) == ["evolved.t", "evolved.p", "evolved.n"]
    got = spark.sql("SELECT id, extra FROM evolved.t").collect()
    assert sorted(r.id for r in got if r.extra is None) == list(range(10)) and len(got) == 20
    assert spark.table("evolved.t").columns == ["id", "extra"]
    assert spark.sql("SELECT sum(more) FROM evolved.p").first()[0] == 5 and spark.table("evolved.n").count() == 0
    t.rewrite([0], t.read().where("bucket = 0 AND id > 4"))
    register_views(spark, {"evolved.t": t.path}, {"bucket"})
    assert spark.table("evolved.t").count() == t.read().count() < 20


def test_no_local_work_folder_on_a_cluster():
    from types import SimpleNamespace

    from ledgerline.session import ensure_checkpoint_dir

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None),
                          sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(far)


def test_a_table_without_rows_takes_its_first_as_they_are(spark, tmp_dir, monkeypatch):
    """Tables that a run without files has made: nothing is compared or
    copied for the first rows, and no rows make no version."""
    t = TB.BucketedTable(spark, os.path.join(tmp_dir, "raw"), ["k"], 4, segments=True)
    u = TB.BucketedTable(spark, os.path.join(tmp_dir, "silver"), ["k"], 4)
    none, some = (spark.createDataFrame(x, "k string, v int") for x in ([], [("a", 1), ("b", 2)]))
    monkeypatch.setattr(D, "materialize", lambda *a: 1 / 0)
    for day, rows, version in ((1, none, 1), (2, none, 1), (3, some, 2)):
        D.snapshot_into(spark, t, rows, "k", ["v"], f"2024-01-0{day} 06:00:00")
        D.upsert_into(spark, u, rows, ["k"])
        assert t.versions()[-1] == u.versions()[-1] == version
    assert sorted(tuple(r) for r in t.read().select("k", "v", "segment").collect()) == [("a", 1, "open"), ("b", 2, "open")]
    assert sorted(tuple(r) for r in u.read().select("k", "v").collect()) == [("a", 1), ("b", 2)]
