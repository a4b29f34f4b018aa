"""Landing CSV source: headers, malformed lines, quoting, counts, empty input."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import write_csv
from ledgerline.plans import fixture as FX
from ledgerline.sources import read_landing
from ledgerline.sources.landing import LISTING_TASKS, file_listing, files_with_open_lines, list_files

COLS = ["store_group", "store_token", "store_name"]


def test_header_malformed_quotes(spark, tmp_dir):
    write_csv(os.path.join(tmp_dir, "stores_20240101.csv"),
              'store_group,store_token,store_name\n'
              'AAAAAAAA,tok1,"Name, with comma"\n'
              'only_one\n'
              'a,b,c,d\n'
              ',,\n'
              'BBBBBBBB,tok2,""\n'
              'CCCCCCCC,tok3,"two\nlines"\n'
              'DDDDDDDD,tok4,"say ""hi"""\n')
    write_csv(os.path.join(tmp_dir, "stores_20240102.csv"), "EEEEEEEE,tok5,Plain\n")
    df = read_landing(spark, f"{tmp_dir}/stores_*.csv", COLS, header_cols=COLS)
    got = sorted((r.store_token, r.store_name) for r in df.collect())
    assert got == [("tok1", "Name, with comma"), ("tok2", None), ("tok3", "two\nlines"),
                   ('tok4', 'say "hi"'), ("tok5", "Plain")]
    # counts per file skip header, malformed and all-empty lines (column pruning off)
    counts = {r.source_file.rsplit("/", 1)[1]: r.n for r in
              df.groupBy("source_file").agg(F.count("*").alias("n")).collect()}
    assert counts == {"stores_20240101.csv": 4, "stores_20240102.csv": 1}
    assert df.count() == 5


def test_empty_landing_is_typed(spark, tmp_dir):
    df = read_landing(spark, f"{tmp_dir}/sales_*.csv", ["a", "b"], header_cols=["a"])
    assert df.columns == ["a", "b", "source_file"] and df.count() == 0


def test_header_only_filters_exact_match(spark, tmp_dir):
    write_csv(os.path.join(tmp_dir, "stores_20240101.csv"),
              "store_group,store_token,other\nstore_group,store_token,store_name\n")
    df = read_landing(spark, f"{tmp_dir}/stores_*.csv", COLS, header_cols=COLS)
    assert [r.store_name for r in df.collect()] == ["other"]


def test_splittable_read_without_multiline(spark, tmp_dir):
    """multi_line=False lets Spark split large files; rows without quoted
    line breaks read the same."""
    write_csv(os.path.join(tmp_dir, "stores_20240101.csv"),
              'AAAAAAAA,tok1,"Name, with comma"\nonly_one\nBBBBBBBB,tok2,Plain\n')
    a = read_landing(spark, f"{tmp_dir}/stores_*.csv", COLS, header_cols=COLS)
    b = read_landing(spark, f"{tmp_dir}/stores_*.csv", COLS, header_cols=COLS,
                     multi_line=False)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert b.count() == 2


def test_only_files_with_open_quotes_are_read_whole(spark, tmp_dir):
    """A plain file is split among tasks, a quoted line break stays one row."""
    plain = "\n".join(f'a{i},"b, ""{i}""",c' for i in range(30_000)) + "\n"
    write_csv(os.path.join(tmp_dir, "x_1.csv"), plain)
    write_csv(os.path.join(tmp_dir, "x_2 é.csv"), 'a,"two\nlines",c\nd,e,f\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        auto = read_landing(spark, os.path.join(tmp_dir, "x_*.csv"), ["p", "q", "r"], multi_line="auto")
        whole = read_landing(spark, os.path.join(tmp_dir, "x_*.csv"), ["p", "q", "r"], multi_line=True)
        one = auto.where("source_file LIKE '%x_1.csv'")
        assert one.rdd.getNumPartitions() > 4 and whole.rdd.getNumPartitions() <= 2
        got = sorted(map(tuple, auto.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(map(tuple, whole.collect())) and len(got) == 30_002
    assert ("a", "two\nlines", "c") in {r[:3] for r in got}
    files = [f for f in list_files(spark, os.path.join(tmp_dir, "x_*.csv"))]
    assert [f[-9:] for f in files_with_open_lines(spark, files)] == [[f for f in files if "x_2" in f][0][-9:]]
    assert read_landing(spark, os.path.join(tmp_dir, "none_*.csv"), ["p"], multi_line="auto").count() == 0


def _most_tasks(spark, group: str, work) -> int:
    """The largest number of tasks of a stage that ``work`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        work()
    finally:
        sc.setJobGroup("rest", "rest")
    track = sc.statusTracker()
    stages = [track.getStageInfo(s) for j in track.getJobIdsForGroup(group) for s in track.getJobInfo(j).stageIds]
    return max(s.numTasks for s in stages if s is not None)


def test_many_files_are_listed_by_few_tasks(spark, tmp_dir):
    """a listing task a file costs more than reading the files."""
    for i in range(120):
        write_csv(os.path.join(tmp_dir, f"x_{i:03}.csv"), f"a{i},b,c\n")
    pattern, most = os.path.join(tmp_dir, "x_*.csv"), 4 * spark.sparkContext.defaultParallelism
    old = spark.conf.get(LISTING_TASKS, None)
    files = list_files(spark, pattern)
    assert [f.rsplit("/", 1)[1] for f in files] == [f"x_{i:03}.csv" for i in range(120)]
    for n, work in enumerate((lambda: read_landing(spark, pattern, ["p", "q", "r"]),
                              lambda: read_landing(spark, files, ["p", "q", "r"], multi_line="auto"))):
        assert _most_tasks(spark, f"list-{n}", work) <= most
    assert read_landing(spark, files, ["p", "q", "r"], multi_line="auto").count() == 120
    assert spark.conf.get(LISTING_TASKS, None) == old


def test_listing_gives_length_and_time(spark, tmp_dir):
    path = write_csv(os.path.join(tmp_dir, "x_1 é.csv"), "a,b\n")
    write_csv(os.path.join(tmp_dir, "y_1.csv"), "a,b\n")
    (uri, length, modified), = file_listing(spark, os.path.join(tmp_dir, "x_*.csv"))
    assert uri.endswith("/x_1 é.csv") and length == 4
    assert modified == os.stat(path).st_mtime_ns // 1_000_000
    assert file_listing(spark, os.path.join(tmp_dir, "none", "x_*.csv")) == []
    write_csv(os.path.join(tmp_dir, "y_2.csv"), "")
    assert [(f[0][-7:], f[1]) for f in file_listing(spark, os.path.join(tmp_dir, "y_*.csv"))] == [("y_1.csv", 4), ("y_2.csv", 0)]
    assert read_landing(spark, os.path.join(tmp_dir, "y_2*.csv"), ["p", "q"], multi_line="auto").count() == 0


def test_written_landing_files(spark, tmp_dir):
    """Every file has its name and its lines in order; nothing else stays."""
    orders = spark.createDataFrame([(k, k % 7, 10.0 + k, dt.datetime(1995, 1 + k % 2, 3), "1-URGENT") for k in range(20, 40)],
                                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, "
                                   "o_orderpriority string")
    people = spark.createDataFrame([(k, f"n{k}") for k in range(120)], "c_custkey long, c_name string")
    root = FX.write_landing(spark, orders, people, os.path.join(tmp_dir, "landing"))
    names = sorted(n for n in os.listdir(root) if not n.startswith("."))
    assert names == ["sales_19950101_0.csv", "sales_19950201_0.csv", *[f"stores_2024010{d}.csv" for d in (1, 2, 3)]]
    with open(os.path.join(root, "sales_19950101_0.csv"), encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert lines[0].startswith("store_token,") and [x.split(",")[2] for x in lines[1:]] == \
        [f"R{k:09}" for k in range(20, 40, 2)]


def test_open_lines_of_small_and_large_files(spark, tmp_dir, monkeypatch):
    from ledgerline.sources import landing as L

    made = {"a.csv": b'x,"y"\n', "b.csv": b'x,"y\nz"\n', "c.csv": b'"\r"\r\n', "d.csv": b"\xff,\xe2\x82\xac\n",
            "e f.csv": b'"\xff\n', "g.csv": b"", "h.csv": b'a"b"\r\n""\n'}
    for name, content in made.items():
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(content)
    files = L.list_files(spark, os.path.join(tmp_dir, "*.csv"))
    scans = []
    text = type(spark.read).text
    monkeypatch.setattr(type(spark.read), "text", lambda self, paths, *a, **k: scans.append(paths) or text(self, paths, *a, **k))
    small = L.files_with_open_lines(spark, files)
    assert [f.rsplit("/", 1)[1] for s in scans for f in s] == ["g.csv"]         # empty: the listing of contents passes it over
    monkeypatch.setattr(L, "SMALL_FILE", 0)
    assert L.files_with_open_lines(spark, files) == small
    assert sorted(f.rsplit("/", 1)[1].replace("%20", " ") for f in small) == ["b.csv", "c.csv", "e f.csv"]
