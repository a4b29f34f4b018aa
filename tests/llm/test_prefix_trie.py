import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import prefix_trie as P

TURNS = "conv_id long, turn long, role string, text string"


def brute(convs):
    """Nodes of {id: [(role, text), ...]}."""
    members, kids = defaultdict(list), defaultdict(set)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].add(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            if k:
                saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode().split())
    out = []
    for k, m in members.items():
        done = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                    hashlib.sha256(done.encode()).hexdigest()))
    return sorted(out, key=repr)


def got_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("shard", [200_000, 40])
def test_nodes_equal_brute_force(spark, monkeypatch, shard):
    """Also conversations of several chunks that part at, before and after a chunk's end."""
    monkeypatch.setattr(P, "SHARD_TURNS", shard)
    rng = random.Random(shard)
    convs = {c: [(rng.choice("uv"), rng.choice(["a", "b c", "d  e f", ""])) for _ in range(rng.randint(0, 6))]
             for c in range(70)}
    long = [("u", f"w {i}") for i in range(600)]
    convs |= {1000: long, 1001: long[:520] + [("u", "z")] * 5, 1002: long[:512], 1003: long[:256], 999: long,
              1005: long[:255], 1006: long[:257] + [("v", "q")], -4: [("u", "a")]}
    rows = [(c, i * 3, r, t) for c, s in convs.items() for i, (r, t) in enumerate(s)]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    members = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    assert got_of(P.trie(P.positions(turns), members)) == brute(convs)


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(s)] for c, s in own.items()}
    out = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + s[h:]
    return out


def test_query_equals_brute_force_and_sql(spark):
    """Ties, nulls, missing first conversations, conversations that become empty."""
    rng = random.Random(8)
    rows = [(c, rng.choice([None, 0, 1, 2, 900, 5]), rng.choice(["u", "a", None]), rng.choice(["x y", "z", "", None, "é 世"]))
            for c in list(range(1, 45)) + [60, 61, 62, 101, 102, 103, 104, 105, None] for _ in range(rng.randint(1, 5))]
    frame = spark.createDataFrame(rows, TURNS).withColumn("pos", F.lit("x")).withColumn("id", F.lit(1))
    turns, members = P.with_shared_heads(frame)
    want = brute(rebuilt(rows))
    assert any(not s for s in rebuilt(rows).values())
    assert got_of(P.trie(turns, members)) == want
    table = frame.select("conv_id", "turn", "role", "text").toArrow()
    con = duckdb.connect()
    con.register("conversations", table)
    assert sorted(con.sql(P.ORACLE).fetchall(), key=repr) == want


def test_medians_build_a_balanced_tree():
    tree = P.TernaryTree()
    for i in P.medians(1023):
        tree.insert((i,), i)
    depth, level = 0, [tree.down[0]]
    while level:
        depth, level = depth + 1, [x for c in level for x in (tree.low[c], tree.high[c]) if x]
    assert depth == 10
    assert sorted(P.medians(17)) == list(range(17)) and list(P.medians(0)) == []


def test_one_hot_conversation_is_many_rows(spark):
    rows = [(7, i, "u", f"t{i % 9}") for i in range(5000)] + [(8, 0, "u", "t0")]
    turns = P.positions(spark.createDataFrame(rows, TURNS))
    packed = P.chunks(turns)
    assert packed.agg(F.max(F.size("ids"))).first()[0] == P.CHUNK and packed.where("conv_id = 7").count() == 20
    got = P.trie(turns)
    assert got.count() == 5001
    assert got.where("depth = 4999").first()[:7] == (7, 4999, 7, 1, 1, 1, 0)


def test_empty_and_null(spark):
    none = spark.createDataFrame([], TURNS)
    assert P.trie(P.positions(none)).collect() == []
    turns, members = P.with_shared_heads(none)
    assert P.trie(turns, members).collect() == []
    only = spark.createDataFrame([(None, 1, "u", "x")], TURNS)
    assert P.trie(P.positions(only)).collect() == []
    got = got_of(P.trie(P.positions(none), spark.createDataFrame([(3,), (2,), (None,)], "conv_id long")))
    assert got == brute({2: [], 3: []})
