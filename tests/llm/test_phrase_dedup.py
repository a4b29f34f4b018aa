import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import phrase_dedup as P
from tests.llm.conftest import ODD


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = [0] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [1] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=80):
    rng = random.Random(seed)
    prose = lambda k: " ".join(rng.choice("ab cde fg hij é".split()) for _ in range(k))
    passages = [prose(rng.randint(3, 60)) for _ in range(8)]
    rows = []
    for i in range(n):
        t = prose(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            t += " " + rng.choice(passages)[:rng.randint(5, 200)] + rng.choice(" \n\t") + prose(rng.randint(0, 9))
        rows.append((i, t))
    return rows + [(n, rows[0][1]), (n + 1, None), (0, "a " * 50), (None, "x y " * 30), (None, "x y " * 30)]


@pytest.mark.parametrize("window,hot", [(6, 4096), (6, 3), (9, 1), (35, 4096)])
def test_digests_equal_brute_force(docs_of, monkeypatch, window, hot):
    monkeypatch.setattr(P, "HOT", hot)
    rows = corpus(window + hot) + ODD
    got = sorted(map(tuple, P.digests(docs_of(rows), window).collect()), key=repr)
    assert got == brute(rows, window)
    assert 0 < sum(g[2] for g in got) < sum(g[1] for g in got)


def test_many_shards(docs_of, monkeypatch):
    monkeypatch.setattr(P, "SHARD_WORDS", 50)
    rows = corpus(9)
    assert sorted(map(tuple, P.digests(docs_of(rows), 7).collect()), key=repr) == brute(rows, 7)


def test_pieces_of_a_long_text(monkeypatch):
    """Anchors and segments of a text that is read in pieces cover its windows once each."""
    monkeypatch.setattr(P, "PIECE", 40)
    rng = random.Random(4)
    words = [rng.choice(["aa", "b", "cc", "d"]) for _ in range(400)]
    text, window = " ".join(words), 6
    batch = pa.RecordBatch.from_pydict({"tid": [5], "copies": [1], "text": [text]})
    runs = [r for b in P._anchor_batches([batch], window) for r in b.to_pylist()]
    covered = sorted(k for r in runs for k in range(r["first"], r["first"] + r["n"]))
    assert covered == list(range(len(words) - window + 1))
    places = [{"first": r["first"], "n": r["n"], "key": r["key"], "hot": i % 3 == 0} for i, r in enumerate(runs)]
    batch = pa.RecordBatch.from_pydict({"tid": [5], "copies": [1], "text": [text], "places": [places]})
    found = Counter()
    for b in P._segment_batches([batch], window, 4):
        for r in b.to_pylist():
            seg = r["words"].decode().split()
            at = memoryview(r["places"]).cast("q").tolist()
            for first in at[1::3]:
                assert words[first:first + len(seg)] == seg
                found.update(range(first, first + len(seg) - window + 1))
    assert found == Counter(range(len(words) - window + 1))


def test_equal_windows_have_equal_anchors():
    """Wherever a window stands, its anchor is the same gram at the same place in it."""
    import numpy as np

    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 5, 600).astype(np.uint64)
    window, at = 8, {}
    for key, run, first, n in zip(*P.anchor_runs(hashes, [250, 3, 347], window)):
        start = [0, 250, 253][run] + first
        for k in range(start, start + n):
            at.setdefault(hashes[k:k + window].tobytes(), set()).add(int(key))
    assert all(len(keys) == 1 for keys in at.values())
    assert sum(n for *_, n in zip(*P.anchor_runs(hashes, [250, 3, 347], window))) == 250 - 7 + 347 - 7


def test_automaton_finds_every_occurrence():
    phrases = P.phrases_of(["abcdex", "yabcdz", "abcdez"], [1, 1, 1], 4)
    assert phrases == {"abcde", "abcd"}
    machine = P.automaton_of(phrases)
    assert P.covered(machine, "abcdexxabcd") == [(0, 5), (7, 11)]
    assert P.phrases_of(["abcd"], [2], 4) == {"abcd"} and P.phrases_of(["abcd"], [1], 4) == set()


def test_remove_keeps_columns(docs_of):
    rows = [(1, "one two three four five"), (2, "zero one two three  four"), (3, None), (3, "one")]
    docs = docs_of(rows).withColumn("shard", F.lit(9)).withColumn("words", F.lit("w")).withColumn("digest", F.lit("d"))
    got = {(r.doc_id, r.text): r for r in P.remove(docs.drop("digest"), 3).collect()}
    assert got[1, rows[0][1]].kept == "five" and got[2, rows[1][1]].kept == "zero"
    assert [(s.start, s.stop) for s in got[2, rows[1][1]].spans] == [(1, 5)]
    assert got[3, None].kept == "" and got[3, "one"].kept == "one" and got[3, "one"].shard == 9
    with pytest.raises(ValueError):
        P.remove(docs)
    with pytest.raises(ValueError):
        P.cut(docs_of(rows), 1)
    assert P.digests(docs_of([])).collect() == []
