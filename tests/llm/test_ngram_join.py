import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ngram_join as J
from tests.llm.conftest import ODD


def brute_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc_id -> (n, component): rows of one id are one node."""
    sets = [(i, brute_set(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in sets}


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    line = " ".join(rng.choice(vocab) for _ in range(30))
    bases = [[rng.choice(vocab) for _ in range(rng.choice([3, 6, 20, 60, 200]))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        if rng.random() < 0.2:
            w = [rng.choice(vocab) for _ in range(rng.randint(1, 50))]
        t = " ".join(w)
        if rng.random() < 0.4:
            t += " " + line
        rows.append((i * 3 + 1, t.upper() if rng.random() < 0.1 else t))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [2048, 8])
def test_join_equals_brute_force(docs_of, monkeypatch, tile):
    monkeypatch.setattr(J, "TILE", tile)                      # 8: clusters are cut into many tiles
    monkeypatch.setattr(J, "BLOCK", 4000)
    rows = corpus(tile)
    got = {r.doc_id: r for r in J.join(docs_of(rows)).collect()}
    want = brute(rows)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(brute_set(t)) for i, t in rows)
    assert len(set(want.values())) < len(rows) - 30


def test_odd_rows(docs_of):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in J.join(docs_of(ODD)).collect())
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert [g for g in got if g[0] == 4] == [(4, 1, 4)] * 2
    assert [g for g in got if g[0] == -1] == [(-1, 1, 4)]     # the null id joins its equals
    assert [g[2] for g in got if g[0] in (7, 8)] == [7, 7]
    assert J.join(docs_of([])).count() == 0


def test_rows_of_one_id_are_in_one_component(docs_of):
    """The texts of an id join what they equal, also through other ids."""
    x, y, z = ("one two three four five six", "seven eight nine ten eleven", "p q r s t u v")
    rows = [(3, x), (5, x), (5, y), (9, y), (9, z), (11, z), (20, "alone it stands here now"), (20, None), (None, z), (None, x)]
    got = sorted(map(str, J.join(docs_of(rows)).collect()))
    want = [(3, 2, 3), (5, 2, 3), (5, 1, 3), (9, 1, 3), (9, 3, 3), (11, 3, 3), (20, 1, 20), (20, 0, 20), (None, 3, 3), (None, 2, 3)]
    assert got == sorted(f"Row(doc_id={a}, n_shingles={b}, component_id={c})" for a, b, c in want)


def test_half_of_all_ids_null(docs_of):
    rows = [(i if i % 2 else None, f"w{i // 4} a b c d e f g") for i in range(200)]
    got = J.join(docs_of(rows)).collect()
    assert len(got) == 200 and {(r.doc_id, r.component_id) for r in got if r.doc_id} == {
        (i, i // 4 * 4 + 1) for i in range(1, 200, 2)}
    assert {r.component_id for r in got if r.doc_id is None} == {i // 4 * 4 + 1 for i in range(200)}


def test_tile_links_span_the_components():
    rng = np.random.default_rng(3)
    for trial in range(20):
        base = [rng.integers(0, 2 ** 63, k).astype(np.uint64) for k in (5, 40, 200)]
        sets = []
        for _ in range(40):
            b = base[rng.integers(3)]
            s = np.concatenate((b[rng.random(len(b)) > 0.3 * rng.random()],
                                rng.integers(0, 2 ** 63, int(len(b) * 0.2 * rng.random())).astype(np.uint64)))
            if len(s):
                sets.append(np.unique(s))
        side = rng.integers(0, 2, len(sets)) if trial % 2 else None
        ok = {(i, j) for i in range(len(sets)) for j in range(i) if (side is None or side[i] != side[j])
              and 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}

        def groups(edges):
            root = list(range(len(sets)))
            for a, b in list(edges) * len(sets):
                root[a] = root[b] = min(root[a], root[b])
            return root

        found = J.tile_links(sets, side)
        assert {(max(x), min(x)) for x in found} <= ok
        assert groups(found) == groups(ok)


def test_a_block_sends_a_row_a_range(docs_of, monkeypatch):
    """Not one a range and block, which made 3.4 million rows of 256,410 texts."""
    rows = [(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(30))) for i in range(200)] + ODD
    docs = docs_of(rows, 1).select(F.pmod(F.xxhash64("doc_id"), F.lit(50)).cast("int").alias("block"), "doc_id", "text")
    kept, found = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda d, *a: kept.append(found(d, *a)) or kept[-1])
    back = J.shared_grams(docs, 2).collect()
    assert kept[0].count() <= 4
    grams = {b: set() for b in range(50)}
    for r in back:
        grams[r.block] |= {(r.part << 32) | int(x) for x in np.frombuffer(r.vals, np.uint32)}
    texts, want = docs.collect(), {b: set() for b in range(50)}
    sets = [set((s >> np.uint64(30)).tolist()) for s in J.gram_sets([r.text or "" for r in texts])]
    often = Counter(g for s in sets for g in s)
    for r, s in zip(texts, sets):
        want[r.block] |= {g for g in s if often[g] > 1}
    assert grams == want


def test_common_lines_do_not_tie_candidates_together(docs_of, monkeypatch):
    """Families of near copies share half of their words with all others. A
    prefix by hash held grams of those lines, so all were one cluster, whose
    tiles grow with its square."""
    rng = random.Random(8)
    line = [f"c{k}" for k in range(100)]
    rows = []
    for f in range(40):
        own = [f"f{f}x{k}" for k in range(100)]
        for i in range(3):
            own = [*own]
            own[rng.randrange(100)] = f"n{f}x{i}"
            rows.append((3 * f + i, " ".join(line + own)))
    kept, found = [], J.components
    monkeypatch.setattr(J, "components", lambda e, name: kept.append((name, found(e, name))) or kept[-1][1])
    got = {r.doc_id: r.component_id for r in J.join(docs_of(rows)).collect()}
    assert got == brute(rows) and got == {i: i // 3 * 3 for i in range(120)}
    clusters = Counter(r.root for r in dict(kept)["gram-clusters"].collect())
    assert max(clusters.values()) <= 3


def test_steps_leave_no_shuffle_files(docs_of, monkeypatch):
    """The shuffle files of all steps together were over four times the input."""
    tidied, write = [], J.saved
    monkeypatch.setattr(J, "saved", lambda df, name, tidy=False: tidied.append((name, tidy)) or write(df, name, tidy))
    J.join(docs_of(corpus(5, 30))).collect()
    assert {n for n, _ in tidied} == {"gram-shared", "gram-sets", "gram-reps", "gram-nodes"} and all(t for _, t in tidied)
