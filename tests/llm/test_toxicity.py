import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import toxicity as X
from ledgerline.llm.common import id_bucket
from tests.llm.conftest import ODD

WORDS = [f"w{i}" for i in range(300)]


def corpus(spark, docs_of, n=900, pair=False):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(WORDS) for _ in range(rng.randint(5, 60))]
        if pair:                                              # only the pair is toxic
            insult, group = rng.random() < 0.5, rng.random() < 0.5
            w += ["blork"] * insult + ["zeds"] * group
            bad = insult and group
        else:
            bad = rng.random() < 0.2
            w += rng.sample(["blork", "snarf", "grue"], 2) if bad else []
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out(spark, docs_of):
    docs, labels = corpus(spark, docs_of)
    m = X.learn(docs, labels, F.col("doc_id") % 3 != 1)
    got = X.score(docs, m).join(labels, "doc_id").where("doc_id % 3 = 1").collect()
    assert np.mean([(r.score >= 0.7) == (r.toxic == 1) for r in got]) >= 0.98


def test_pairs_beat_linear_weights(spark, docs_of):
    docs, labels = corpus(spark, docs_of, pair=True)
    m = X.learn(docs, labels, F.col("doc_id") % 3 != 1)
    s = m.score(["blork zeds w1", "blork w1 w2", "zeds w1 w2", "w1 w2 w3"])
    assert s[0] > 0.7 and max(s[1:]) < 0.5


def test_pair_of_terms_that_are_as_frequent_in_both_classes(spark, docs_of):
    """Each half of the pair is in half of the toxic and half of the clean rows."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1200):
        w = [rng.choice(WORDS) for _ in range(rng.randint(5, 60))]
        w += [["blork"], ["blork", "zeds"], ["zeds"], ["snarf"]][i % 4]
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, i % 2))
    m = X.learn(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    s = m.score(["blork zeds w1", "blork w1 w2", "zeds w1 w2"])
    assert s[0] > 0.7 and max(s[1:]) < 0.5


def test_rare_insult_is_learned(spark, docs_of):
    """Six toxic rows of 900: too few for a surely different term."""
    rng = random.Random(9)
    rows = [(i, " ".join([rng.choice(WORDS) for _ in range(8)] + ["blork"] * (i % 3 == 0) + ["snarf"] * (i % 150 == 1)))
            for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0 or i % 150 == 1)) for i, _ in rows], "doc_id long, toxic int")
    s = X.learn(docs_of(rows), labels, F.lit(True)).score(["snarf w1 w2", "w1 w2"])
    assert s[0] > s[1] + 0.1


def test_gradient():
    rng = np.random.default_rng(1)
    terms = np.arange(6)
    m = X.Machine(0.1, terms, rng.normal(0, 1, 6), rng.normal(0, 1, (6, 4)))
    row, term = m.places([np.array([0, 2, 5]), np.array([], np.int64), np.array([1, 2, 3, 4])])
    z, held = m.logits(row, term, 3)
    want = 0.1 + m.w[[0, 2, 5]].sum() + sum(m.v[a] @ m.v[b] for a, b in [(0, 2), (0, 5), (2, 5)])
    assert abs(z[0] - want) < 1e-9 and z[1] == 0.1
    e = 1e-6
    m.v[2, 1] += e
    assert abs((m.logits(row, term, 3)[0][0] - z[0]) / e - (held[0] - m.v[2])[1]) < 1e-4


def test_odd_rows(spark, docs_of):
    docs, labels = corpus(spark, docs_of, 200)
    odd = labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (10 ** 9, 1)], "doc_id long, toxic int"))
    m = X.learn(docs, odd, F.lit(True))
    got = X.score(docs_of(ODD), m).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert X.score(docs_of([]), m).count() == 0
    none = X.learn(docs, labels.where("toxic = 0"), F.lit(True))
    assert all(r.score < 0.01 for r in X.score(docs_of(ODD), none).collect())
    assert X.score(docs_of(ODD), X.learn(docs_of([]), labels, F.lit(True))).count() == len(ODD)


@pytest.mark.parametrize("sf,auc,share", [("sf0.01", 0.80, 0.4), ("sf0.1", 0.95, 0.75)])
def test_held_out_rows_of_the_given_labels(spark, sf, auc, share):
    """Rows that no fit has seen; one per cent of false alarms at most."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet").where("toxic IS NOT NULL")
    m = X.learn(docs, labels, id_bucket(F.col("doc_id"), 3) != 1)
    held = X.score(docs.select("doc_id", "text"), m).join(labels, "doc_id").where(id_bucket(F.col("doc_id"), 3) == 1)
    rows = sorted((r.score, r.toxic) for r in held.select("score", "toxic").collect())
    bad = [i for i, (_, t) in enumerate(rows) if t == 1]
    clean = len(rows) - len(bad)
    assert (sum(bad) - len(bad) * (len(bad) - 1) / 2) / (len(bad) * clean) >= auc
    assert sum(s >= 0.7 and t == 1 for s, t in rows) >= share * len(bad)
    assert sum(s >= 0.7 and t == 0 for s, t in rows) <= 0.01 * clean


def test_calibration():
    rng = np.random.default_rng(2)
    z = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(1.7 * z - 0.8)))).astype(float)
    a, b = X.calibration(z, y)
    assert abs(a - 1.7) < 0.1 and abs(b + 0.8) < 0.1
    assert X.calibration(z, np.ones(len(z))) == (1.0, 0.0) == X.calibration(z[:0], y[:0])


def test_shrinkage_drops_words_of_one_row():
    rng = np.random.default_rng(4)
    sets = [np.unique(np.append(rng.integers(0, 5, 3), 100 + i)) for i in range(400)]
    y = np.array([float(i % 4 == 0) for i in range(400)])
    sets = [np.union1d(s, [50]) if t else s for s, t in zip(sets, y)]
    m = X.fit(np.unique(np.concatenate(sets)), sets, y)
    alone = m.w[m.terms >= 100]
    assert (alone == 0).mean() > 0.9 and m.w[m.terms == 50][0] > 1
