import random

import numpy as np
import pytest

from ledgerline.llm import decontam as D
from tests.llm.conftest import ODD

VOCAB = [f"v{i}" for i in range(600)] + ["the", "of"] * 60


def items(rng, n=30):
    return [(i, " ".join(rng.choice(VOCAB) for _ in range(rng.randint(8, 50)))) for i in range(n)]


@pytest.mark.parametrize("per_block", [1, 4, 64])
def test_wand_equals_brute_force(per_block):
    rng = random.Random(per_block)
    ix = D.ItemIndex([(i, t.split()) for i, t in items(rng)], per_block)
    for _ in range(150):
        words = [w for _ in range(3) for w in rng.choice(ix.words)[:rng.randint(1, 40)]]
        terms = sorted({ix.term[w] for w in words})
        for th in (0.05, 0.3, 0.6, 1.0):
            score = {}
            for t in terms:
                for i, x in ix.postings[t]:
                    score[i] = score.get(i, 0) + x
            want = {i for i, s in score.items() if s >= th - 1e-9}
            _, blocks = ix.candidates(np.zeros(len(terms), np.int64), np.array(terms), th)
            got = ix.wand(terms, blocks.tolist(), th)
            assert {i for i, _ in got} == want
            assert all(abs(s - score[i]) < 1e-9 for i, s in got)


def test_items_are_found_wherever_they_stand(spark, docs_of):
    rng = random.Random(8)
    its = items(rng)
    rows, want = [], set()
    for d in range(120):
        w = [rng.choice(VOCAB) for _ in range(rng.randint(0, 400))]
        if d % 3 == 0:
            i, t = rng.choice(its)
            at = rng.randint(0, len(w))
            own = t.split()
            if d % 6 == 0:
                own = [x.upper() + "," for x in own]          # marks and case don't matter
            w[at:at] = own
            want.add((d, i))
        if d % 5 == 0:
            w += rng.choice(its)[1].split()[:4]               # a few words are no leak
        rows.append((d, " ".join(w)))
    found = D.hits(docs_of(rows), spark.createDataFrame(its, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == want
    texts = dict(rows)
    for r in found:
        assert r.score > 0.99 and r.item_overlap == 1.0 and 0 <= r.first_word <= len(texts[r.doc_id].split())


def test_question_without_answer_is_no_leak(spark, docs_of):
    words = [f"u{i}" for i in range(40)]
    its = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = docs_of([(1, " ".join(words[:30])), (2, " ".join(words[12:])), (3, " ".join(words[:38]))])
    assert [r.doc_id for r in D.hits(docs, its).collect()] == [3]


def test_shards_and_odd_rows(spark, docs_of):
    its = spark.createDataFrame([(None, "null id item with some words here"), (1, None), (2, ""), (3, "one two three"),
                                 (3, "one two three"), (4, " ".join(f"q{i}" for i in range(20)))],
                                "item_id long, text string")
    whole = sorted(map(str, D.hits(docs_of(ODD), its).collect()))
    assert len(whole) == 6                                    # three rows, an item that comes twice
    assert len(list(D.shards(its, limit=3))) > 2
    found = D.hits(docs_of(ODD), its, shard_bytes=3).collect()
    assert sorted(map(str, found)) == whole
    assert {(r.doc_id, r.item_id) for r in found} == {(4, 3), (None, 3)}
    assert D.hits(docs_of([]), its).count() == 0
    assert D.hits(docs_of(ODD), its.where("false")).count() == 0


def partly(rng, its, n):
    """Documents that hold more or less of an item, with scores around the threshold."""
    for d in range(n):
        own = rng.choice(its)[1].split()
        keep = [w if rng.random() > 0.05 * (d % 4) else rng.choice(VOCAB) for w in own]
        fill = [rng.choice(VOCAB) for _ in range(rng.randint(0, 300))]
        at = rng.randint(0, len(fill))
        yield d, " ".join(fill[:at] + keep + fill[at:])


def test_scores_do_not_depend_on_shards(spark, docs_of):
    rng = random.Random(21)
    its = items(rng, 60)
    docs = docs_of(list(partly(rng, its, 150)))
    bench = spark.createDataFrame(its, "item_id long, text string").repartition(3)
    key = lambda r: (r.doc_id, r.item_id)
    assert len(list(D.shards(bench))) == 1 and len(list(D.shards(bench, limit=1500))) > 4
    whole = sorted(D.hits(docs, bench, threshold=0.3).collect(), key=key)
    cut = sorted(D.hits(docs, bench, threshold=0.3, shard_bytes=1500).collect(), key=key)
    assert len(whole) > 50 and [key(r) for r in whole] == [key(r) for r in cut]
    for a, b in zip(whole, cut):
        assert a.first_word == b.first_word and abs(a.score - b.score) < 1e-9
        assert (a.item_overlap, a.question_overlap, a.answer_overlap) == (
            b.item_overlap, b.question_overlap, b.answer_overlap)


def test_statistics_are_of_all_items(spark):
    its = items(random.Random(22), 40)
    bench = spark.createDataFrame(its, "item_id long, text string")
    one = D.ItemIndex([(i, t.split()) for i, t in its])
    want = {(one.ids[i], w): x for w, t in one.term.items() for i, x in one.postings[t]}
    got = {(ix.ids[i], w): x for ix in D.shards(bench, limit=1000) for w, t in ix.term.items()
           for i, x in ix.postings[t]}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_long_text_is_searched_in_pieces(monkeypatch):
    rng = random.Random(23)
    its = items(rng, 50)
    ix = D.ItemIndex([(i, t.split()) for i, t in its])
    text = " ".join(w for _ in range(200) for w in
                    [rng.choice(VOCAB) for _ in range(60)] + rng.choice(its)[1].split())
    whole = ix.search([text, "", text[:5000]])
    assert len(whole) > 40
    held, real = [], ix.candidates
    monkeypatch.setattr(ix, "candidates", lambda p, t, th: held.append(len(set(p.tolist()))) or real(p, t, th))
    monkeypatch.setattr(D, "CELLS", 3 * ix.n_blocks)
    assert ix.search([text, "", text[:5000]]) == whole
    assert max(held) == 3 and len(held) > 50
