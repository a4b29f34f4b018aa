import random

import corpus_pipeline as P
import __spark_entry__ as E
import pyarrow as pa
import pytest

from ledgerline.llm import common
from tests.conftest import SF001
from tests.llm.test_ngram_join import brute as brute_join
from tests.llm.test_suffix_dedup import brute as brute_suffix

VOCAB = [f"{a}{b}" for a in "the of and is with".split() for b in "ab cd ef gh ij kl mn op".split()]


def corpus():
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(VOCAB) + rng.choice(VOCAB) for _ in range(n))
    item, passage = prose(30), prose(60)
    rows = [(i, prose(rng.randint(20, 120)), "en") for i in range(60)]
    rows += [(100, rows[3][1], "en"), (101, rows[4][1] + " end", "en")]          # copies
    rows += [(110 + i, prose(40) + " " + passage + " " + prose(40), "en") for i in range(4)]
    rows += [(120, prose(50) + " " + item + " " + prose(50), "en"), (130, None, None), (131, "", "en"), (132, "123 !", None)]
    return rows, item


def test_stages_one_by_one(spark, docs_of, tmp_path):
    rows, item = corpus()
    docs = docs_of(rows)
    sf = str(tmp_path)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs.write.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "near_copies", "repeated_strings", "benchmark_passages", "tokens"]
    at = docs
    for k, (name, stage) in enumerate(P.STAGES):
        before = at.collect()
        at = stage(spark, at, sf)
        at.write.parquet(f"{sf}/out-{k}")
        at = spark.read.parquet(f"{sf}/out-{k}")
        now = {r.doc_id: r for r in at.collect()}
        if k < 4:
            assert at.columns == docs.columns
        if name == "language_id":
            assert set(now) == {r[0] for r in rows} - {130, 131, 132}
        if name == "near_copies":
            comp = brute_join([(r.doc_id, r.text) for r in before])
            assert set(now) == {i for i, c in comp.items() if i == c} and not {100, 101} & set(now)
        if name == "repeated_strings":
            want = brute_suffix([(r.doc_id, r.text) for r in before])
            assert {i: len(r.text.encode()) for i, r in now.items()} == {w[0]: w[1] - w[2] for w in want}
            assert all(r.n_chars == len(r.text) for r in now.values())
            assert sum(w[2] for w in want) > 1000
        if name == "benchmark_passages":
            assert {r.doc_id for r in before} - set(now) == {120}
        if name == "tokens":
            assert all(r.n_tokens == len(r.ids) for r in now.values())
    assert sorted(r.doc_id for r in P.run(spark, sf).collect()) == sorted(now)


def test_extra_columns_and_empty_tables(spark, docs_of, tmp_path):
    rows, item = corpus()
    sf = str(tmp_path)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = docs_of(rows[:20] + [(None, rows[0][1], "en"), (5, rows[5][1], "en")])
    names = "score lang_pred span_words block row grams cluster root a b node shard item_id _gone part n_tokens".split()
    from pyspark.sql import functions as F
    wide = docs.select("*", *[F.lit(n).alias(n) for n in names])
    at, empty = wide, docs_of([])
    for name, stage in P.STAGES[:-1]:
        at = stage(spark, at, sf)
        assert at.columns == wide.columns, name
        empty = stage(spark, empty, sf)
        assert empty.columns == docs.columns
    out = at.collect()
    assert all(r["score"] == "score" and r["block"] == "block" for r in out) and len(out) >= 20
    assert empty.count() == 0 and P.tokens(spark, empty, sf).count() == 0
    assert P.tokens(spark, at, sf).count() == len(out)


def test_registered():
    q = E.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in q) == 1
    assert "pipeline" in q and "op1_chat" in E.oracle_sql()


@pytest.mark.parametrize("name", ["op4_langid", "op6_toxicity", "op7_decontam", "op9_reshard"])
def test_whole_table(spark, name):
    n = E.queries()[name](spark, SF001).count()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert n == docs or name == "op7_decontam" and 0 < n < docs


def test_chat_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF001}/conversations.parquet'")
    want = sorted(con.sql(E.oracle_sql()["op1_chat"]).fetchall(), key=repr)
    got = sorted(map(tuple, E.queries()["op1_chat"](spark, SF001).collect()), key=repr)
    assert got == want and got


def test_documents_travel_in_small_batches(spark, docs_of, tmp_path):
    """A batch of Spark's 10,000 documents stands in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs, before = docs_of([(i, f"a text {i}", "en") for i in range(3000)], 1), spark.conf.get(key)

    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32())], ["n"])

    try:
        for name, stage in P.STAGES:
            if name == "benchmark_passages":
                spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
            spark.conf.unset(key)
            stage(spark, docs.limit(0), str(tmp_path))
            assert max(r.n for r in docs.mapInArrow(rows, "n int").collect()) <= 1000
        spark.conf.set(key, "77")                             # the session's own number stays
        P.tokens(spark, docs, str(tmp_path))
        assert spark.conf.get(key) == "77"
    finally:
        spark.conf.set(key, before)


def test_memory_is_given_back_when_variables_are_gone(monkeypatch):
    alive = []

    class Held:
        def __init__(self):
            alive.append(self.__hash__())

        def __del__(self):
            alive.clear()

    def run(x):
        held = Held()
        return x + bool(held)

    seen = []
    monkeypatch.setattr(common, "give_back", lambda: seen.append(list(alive)))
    assert common.freed(run, 1) == 2 and seen == [[]]


def test_small_batches_are_joined_for_packing():
    """Ten batches of a row are one block; the rows and their order stay."""
    kind = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    one = lambda i: pa.RecordBatch.from_pydict({"doc_id": [i], "text": [f"text {i}" if i else None]}, kind)
    rows = [one(i) for i in range(10)]
    got = list(common.joined(rows + [one(10).slice(1)]))
    assert len(got) == 1 and got[0].column("doc_id").to_pylist() == list(range(10))
    assert [t for _, t in common.text_blocks(got)] == [[""] + [f"text {i}" for i in range(1, 10)]]
    few = list(common.joined(rows, 3 * one(1).nbytes))
    assert sum(b.num_rows for b in few) == 10 and 1 < len(few) < 10
    assert list(common.joined([])) == [] and common.joined(rows[:1]).__next__() is rows[0]
