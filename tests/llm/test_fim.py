import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import fim
from tests.llm.conftest import ODD


def brute(doc_id, text, plain=10, spm=20, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in marks) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, text
    p, s, m = marks
    if h4 % 100 < spm:
        return n, "spm", a, b - a, s + text[b:] + p + text[:a] + m + text[a:b]
    return n, "psm", a, b - a, p + text[:a] + s + text[b:] + m + text[a:b]


def texts(seed, n=200):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice("ab é世🙂<PSM>\n") for _ in range(rng.randint(0, 60)))) for i in range(n)]
    return rows + [(n, "x<P>y"), (n + 1, "<S>"), (n + 2, "<<M"), (n + 3, "a<"), (n + 4, "S>b<P"), (-7, "minus")]


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_digests_equal_brute_force(docs_of):
    rows = texts(1) + ODD
    want = []
    for i, t in rows:
        n, form, a, m, out = brute(i, t)
        want.append((i, n, form, a, m, sha(out), sha(t or "")))
    got = list(map(tuple, fim.digests(docs_of(rows)).collect()))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}


def test_rank_index_is_exact():
    rng = random.Random(2)
    for t in ("", "a", "🙂", "a" * 5000, "é" * 700 + "a" * 700 + "🙂" * 700,
              "".join(rng.choice("aé世🙂") for _ in range(20_000)), "a" * 999 + "🙂" * 9999):
        data = t.encode()
        index = fim.fit(fim.boundaries(data))
        want = [i for i, b in enumerate(data) if b & 0xC0 != 0x80] + [len(data)]
        assert index.at(np.arange(len(index))).tolist() == want
        assert not len(index.residual) or abs(index.residual.astype(int)).max() <= fim.BOUND + 1
    assert len(fim.fit(fim.boundaries(b"a" * 100_000)).rank) <= 2      # one line, and the end's piece


def test_pieces_of_a_long_text(monkeypatch):
    monkeypatch.setattr(fim, "PIECE", 7)
    t = "aé世🙂" * 50
    assert fim.cut(t, 3)[:4] == brute(3, t)[:4] and fim.cut(t, 3)[5] == brute(3, t)[4]


def test_units_of_a_pattern():
    data = "  one zwölf, 3 ".encode()
    index = fim.fit(fim.boundaries(data, r"\w+"))
    assert index.at(np.arange(len(index))).tolist() == [0, 6, 14, 16]
    recipe = fim.Recipe(unit=r"\w+", plain=0)
    n, form, prefix, middle, _, out = fim.cut(" aa bb cc dd", 1, recipe)
    assert n == 4 and form != "plain" and 0 <= prefix <= prefix + middle <= 4
    assert sorted(out.replace("<P>", "").replace("<S>", "").replace("<M>", "")) == sorted(" aa bb cc dd")
    assert fim.cut("...", 1, recipe)[:2] == (0, "plain")                 # no unit


def test_other_marks_and_shares(docs_of):
    recipe = fim.Recipe(plain=0, spm=100, marks=("[pre]", "[suf]", "[mid]"))
    got = fim.restore(fim.transform(docs_of(texts(3)), recipe), recipe).collect()
    assert all(r.restored == r.text for r in got)
    assert {r.form for r in got if r.text} == {"spm"}
    for marks in (("a", "ba", "c"), ("", "x", "y"), ("xyx", "b", "c"), ("ab", "bc", "d")):
        with pytest.raises(ValueError):
            fim.Recipe(marks=marks)


def test_clashing_columns_and_empty(docs_of):
    docs = docs_of([(1, "hello world"), (2, None)]).withColumn("form", F.lit("mine")).withColumn("n", F.lit(7))
    got = fim.transform(docs).orderBy("doc_id").collect()
    assert [r.form_in for r in got] == ["mine", "mine"] and [r.n_in for r in got] == [7, 7]
    assert got[1].form == "plain" and got[1].output == "" and got[1].text is None
    assert fim.digests(docs_of([])).collect() == []


def test_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{path}'")
    assert sorted(map(tuple, fim.digests(spark.read.parquet(path)).collect())) == sorted(con.sql(fim.ORACLE).fetchall())
