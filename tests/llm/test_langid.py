import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import langid as L
from ledgerline.llm.common import first_by_hash
from tests.llm.conftest import ODD

EN = "the of and to in that it for was with this from are have".split()
DE = "der die und nicht sich mit auf für ist das eine über größe".split()
EL = "και του της είναι που για από με στην".split()


def text(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def rows(seed=1, n=120):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        name, words = rng.choice([("en", EN), ("de", DE), ("el", EL)])
        out.append((i, text(rng, words, rng.randint(1, 60)).upper() if i % 9 == 0 else text(rng, words, 40), name))
    return out


def test_held_out_accuracy_and_spans(docs_of):
    docs = docs_of(rows())
    model = L.learn(docs, F.col("doc_id") % 3 != 1)
    assert model.langs == ["de", "el", "en"]
    got = L.identify(docs, model).collect()
    held = [r for r in got if r.doc_id % 3 == 1]
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)
    rng = random.Random(4)
    mixed = docs_of([(1, text(rng, EN, 30) + " " + text(rng, EL, 20) + " " + text(rng, DE, 50))])
    r = L.identify(mixed, model).first()
    assert r.lang_pred == "de" and r.span_langs == ["en", "el", "de"] and r.span_words == [30, 20, 50]


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(0)
    score = rng.normal(0, 2, (50, 3)).astype(np.float32)
    sizes = np.array([0, 1, 6, 4, 7])
    word = rng.integers(0, 50, sizes.sum())
    starts = np.cumsum(sizes) - sizes
    label = L.viterbi(score, word, starts, sizes, 1.5)
    for a, n in zip(starts, sizes):
        if n:
            value = lambda p: sum(score[word[a + t], p[t]] for t in range(n)) - 1.5 * sum(x != y for x, y in zip(p, p[1:]))
            best = max(value(p) for p in itertools.product(range(3), repeat=int(n)))
            assert abs(value(label[a:a + n]) - best) < 1e-4


def test_odd_rows(docs_of):
    model = L.learn(docs_of(rows()), F.lit(True))
    got = {(r.doc_id, r.text): r for r in L.identify(docs_of(ODD + [(20, "漢字かな")]), model).collect()}
    assert len(got) == len(set(ODD)) + 1
    for i in (1, 2, 3):
        r = next(r for k, r in got.items() if k[0] == i)
        assert (r.lang_pred, r.score, r.span_words) == ("und", 0.0, [])
    unknown = got[(20, "漢字かな")]
    assert unknown.lang_pred in model.langs and unknown.score == 0.0   # letters, but of no learned script
    assert L.identify(docs_of([]), model).count() == 0
    none = L.learn(docs_of([]), F.lit(True))
    assert L.identify(docs_of([(1, "hello")]), none).first().lang_pred == "und"


def test_first_by_hash_is_exact_and_bounded(spark):
    df = spark.createDataFrame([("big", i) for i in range(5000)] + [("small", i) for i in range(7)], "g string, k long")
    got = first_by_hash(df, "g", "k", 300)
    want = df.where("g = 'big'").orderBy(F.pmod(F.xxhash64("k"), F.lit(1 << 30)), "k").limit(300)
    assert {r.k for r in got.where("g = 'big'").collect()} == {r.k for r in want.collect()}
    assert got.where("g = 'small'").count() == 7
