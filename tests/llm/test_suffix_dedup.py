import hashlib
import random
import time

import pyarrow as pa
import pytest

from ledgerline.llm import suffix_dedup as S
from ledgerline.llm.common import TIDY, saved
from tests.llm.conftest import ODD


def brute(rows):
    """Per row: bytes kept, n_removed, n_spans. Rows in the order of id (null
    last) and text."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, (rows[i][1] or "").encode()))
    seen, out = set(), {}
    for i in order:
        t = (rows[i][1] or "").encode()
        gone = bytearray(len(t))
        for k in range(len(t) - 99):
            w = t[k:k + 100]
            if w in seen:
                gone[k:k + 100] = b"\x01" * 100
            else:
                seen.add(w)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (rows[i][0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out.values(), key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(rng.randint(10, 60)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = prose(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.4:                            # a near copy
                k = rng.randrange(len(p))
                p = p[:k] + rng.choice("xyz ") + p[k + rng.randint(0, 3):]
            t += p + prose(rng.randint(0, 10))
        if rng.random() < 0.15:
            t += rng.choice("ab") * rng.randint(90, 400)
        if rng.random() < 0.1:
            t += "xyz12" * rng.randint(10, 90)
        rows.append((i * 7, t))
    rows += [(7 * n + 1, rows[3][1]), (7 * n + 2, rows[3][1]), (14, rows[5][1]), (None, rows[4][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1500, 8 << 20])
def test_digests_equal_brute_force(docs_of, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rows = corpus(block % 97)
    got = sorted(map(tuple, S.digests(docs_of(rows)).collect()), key=repr)
    assert got == brute(rows)
    assert sum(g[2] for g in got) > 1000


def test_odd_rows(docs_of):
    got = sorted(map(tuple, S.digests(docs_of(ODD)).collect()), key=repr)
    assert got == brute(ODD)
    assert S.digests(docs_of([])).count() == 0


def test_remove_keeps_columns_and_whole_characters(spark):
    p = "é" * 80
    df = spark.createDataFrame([(1, "x" + p, 7), (2, "yy" + p, 8), (3, None, 9)], "doc_id long, text string, block int")
    got = {r.doc_id: r for r in S.remove(df).collect()}
    assert S.remove(df).columns == df.columns
    assert got[1].text == "x" + "é" * 49 or len(got[1].text) <= 81
    assert got[2].text == "yy" and got[3].text is None and got[2].block == 8


def test_collection_bwt_small():
    rng = random.Random(4)
    for _ in range(60):
        bodies = [bytes(rng.choice(b"ab\xff"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 12)))
                  for _ in range(rng.randint(1, 6))]
        doc, length, lcp = S.collection_bwt(bodies)
        want = sorted((([b + 256 for b in bodies[i][len(bodies[i]) - n:]] + [i]), i, n)
                      for i in range(len(bodies)) for n in range(len(bodies[i]) + 1))
        assert [(i, n) for _, i, n in want] == list(zip(doc.tolist(), length.tolist()))
        texts = [bodies[i][len(bodies[i]) - n:] for _, i, n in want]

        def common(x, y):
            k = 0
            while k < min(len(x), len(y)) and x[k] == y[k]:
                k += 1
            return k

        assert lcp.tolist() == [0] + [common(a, b) for a, b in zip(texts, texts[1:])]


@pytest.mark.parametrize("hot", [0, 3000])
def test_no_task_holds_a_hot_key(docs_of, monkeypatch, hot):
    """A line between other neighbours in each document; equal strings meet
    though the key is split."""
    monkeypatch.setattr(S, "HOT", hot, raising=False)
    monkeypatch.setattr(S, "BLOCK", 5000)
    rng, most, repeats = random.Random(12), [], S.repeats

    def watched(parts):
        most.extend(r[0] for r in parts.groupBy("key").agg({"b": "sum", "a": "sum"})
                    .selectExpr("`sum(b)` - `sum(a)`").collect())
        return repeats(parts)

    monkeypatch.setattr(S, "repeats", watched)
    noise = lambda: "".join(rng.choice("abcdefgh") for _ in range(80))
    line = "All of this text may be used by all who hold a licence of it, as said above. " * 2
    rows = corpus(7) + [(1000 + i, noise() + (line[:70] if i % 2 else line) + noise()) for i in range(150)]
    got = sorted(map(tuple, S.digests(docs_of(rows)).collect()), key=repr)
    assert got == brute(rows)
    assert max(most, default=0) <= hot


class Here:
    """Stands for the segments: gives back the function on one range."""

    def groupBy(self, _):
        return self

    def applyInArrow(self, run, _):
        return run


def test_only_strings_that_may_repeat_are_sorted(monkeypatch):
    """A phrase of 70 bytes may give its neighbourhoods one key, but no string
    of 100 bytes repeats; of a passage that does, the passage alone goes on."""
    runs, seen = S.repeated_runs, []
    monkeypatch.setattr(S, "repeated_runs", lambda bodies: seen.extend(bodies) or runs(bodies))
    rng = random.Random(21)
    noise = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))

    def found(bodies):
        n = len(bodies)
        t = pa.table({"key": [5] * n, "block": pa.array([0] * n, pa.int32()), "row": pa.array(range(n), pa.int32()),
                      "doc_id": list(range(n)), "a": [1000] * n, "b": [1000 + len(x) for x in bodies],
                      "body": pa.array(bodies, pa.binary()), "periodic": [False] * n})
        return sorted(zip(*S.repeats(Here())(t).to_pydict().values()))

    phrase, passage = noise(70), noise(110)
    bodies = [noise(40) + phrase + noise(40) for _ in range(20)]
    assert found(bodies) == [] and seen == []
    bodies += [noise(5 * i) + passage + noise(30 - 5 * i) for i in range(3)]
    assert found(bodies) == [(0, 21, 1005, 1115), (0, 22, 1010, 1120)]
    assert seen and all(x in passage for x in seen)


def test_shuffle_files_go_with_the_step(spark, docs_of):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        files = disk.getAllFiles()
        files = [files.apply(i) for i in range(files.size())]
        return {f.getPath(): f.length() for f in files if f.getName().startswith("shuffle") and f.exists()}

    docs = docs_of([(i, random.Random(i).randbytes(1000).hex()) for i in range(300)]).repartition(4, "doc_id")
    for tidy in (False, True):
        before = set(held())
        assert saved(docs, "tidy-or-not", tidy).count() == 300
        for _ in range(50):
            size = sum(n for f, n in held().items() if f not in before)
            if tidy and size < 20_000:
                break
            time.sleep(0.1)
        assert size < 20_000 if tidy else size > 20_000
    assert spark.conf.get(TIDY, None) in (None, "false")


def test_stretch_that_may_repeat():
    rng = random.Random(22)
    for _ in range(30):
        a, b = (bytes(rng.choice(b"ab") for _ in range(130)) for _ in range(2))
        bodies = [a, b[:rng.randint(0, 130)], a[rng.randint(0, 20):] + b[:30], b"a" * 101, b""]
        strings = [[x[i:i + S.SPAN] for i in range(len(x) - S.SPAN + 1)] for x in bodies]
        every = [s for x in strings for s in x]
        want = []
        for k, x in enumerate(strings):
            at = [i for i, s in enumerate(x) if every.count(s) > 1]
            want += [(k, at[0], at[-1] + S.SPAN)] if at else []
        assert list(zip(*(x.tolist() for x in S.may_repeat(bodies)))) == want
    assert not len(S.may_repeat([])[0])
