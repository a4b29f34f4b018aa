import hashlib
import random
import re

from pyspark.sql import functions as F

from ledgerline.llm import winnow as W
from tests.llm.conftest import ODD


def kept_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = df.select("i", W.marks(F.col("text")).alias("k"), W.written(W.marks(F.col("text"))).alias("w")).collect()
    return {r.i: r for r in rows}


def spark_hashes(spark, texts):
    """Hash of each gram as Spark computes it (high word), by text and place."""
    grams = []
    for i, t in enumerate(texts):
        tok = [m for w in re.findall(r"[^ \t\n\x0b\f\r]+", t or "") for m in re.findall(r"(?s).{1,8}", w)]
        n = max(1, len(tok) - W.GRAM + 1) if tok else 0
        grams += [(i, k, tok[k:k + W.GRAM]) for k in range(n)]
    df = spark.createDataFrame(grams, "i int, k int, g array<string>")
    h = F.transform("g", lambda t: F.xxhash64(t))
    h = F.shiftright(F.shiftleft(F.xxhash64(F.get(h, F.lit(0)), F.get(h, F.lit(1)), F.get(h, F.lit(2))), 32), 32)
    out = {}
    for r in df.select("i", "k", h.alias("h")).collect():
        out.setdefault(r.i, {})[r.k] = r.h
    return out


def test_marks_are_the_rightmost_least_of_each_window(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["x" * 100, "é" * 30 + " z", "one", None, "", " \n "]
    got, h = kept_of(spark, texts), spark_hashes(spark, texts)
    for i in range(len(texts)):
        own = h.get(i, {})
        want = []
        for a in range(max(1, len(own) - W.WINDOW + 1) if own else 0):
            best = min(range(a, min(a + W.WINDOW, len(own))), key=lambda k: (own[k], -k))
            if best not in want:
                want.append(best)
        places = [int(x.split("@")[1]) for x in got[i].w.split()]
        assert places == want, texts[i]
        assert [x.split("@")[0] for x in got[i].w.split()] == ["%x" % (own[k] & 0xFFFFFFFF) for k in want]


def test_shared_run_is_found(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    run = " ".join(word() for _ in range(W.GRAM + W.WINDOW - 1))
    texts = [" ".join([word()] * rng.randint(0, 20) + [run] + [word() for _ in range(rng.randint(0, 20))]) for _ in range(30)]
    got = kept_of(spark, texts)
    sets = [{x.split("@")[0] for x in got[i].w.split()} for i in range(len(texts))]
    assert all(a & b for a in sets for b in sets)


def brute_edit(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, r in enumerate(order):
        t, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[r[0]] = (len(t), hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest())
    return out


def test_edits_take_the_next_document(spark, docs_of):
    rng = random.Random(9)
    rows = [(i * 5 + rng.randint(0, 4), "".join(rng.choice("aé🙂 b") for _ in range(rng.randint(0, 90)))) for i in range(300)]
    rows += [(None, "the null id comes last"), (10 ** 12, "far away")]
    got = {r.doc_id: r for r in W.compare_edits(docs_of(rows, 7)).collect()}
    want = brute_edit(rows)
    assert {k: (r.n_chars, r.edited_sha256) for k, r in got.items()} == want
    assert len(got) == len(rows)
    one = W.compare_edits(docs_of([(5, "abcdef")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1.0


def test_odd_rows(docs_of):
    got = W.compare_edits(docs_of(ODD)).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fingerprint == "" and by[1][0].n_chars == 0
    assert by[3][0].near_next == 1.0 and by[1][0].near_next == 0.0   # 1 is followed by the null id
    assert by[7][0].fingerprint == by[8][0].fingerprint != ""
    assert W.compare_edits(docs_of([])).count() == 0
