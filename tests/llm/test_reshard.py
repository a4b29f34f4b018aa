import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import reshard as R
from tests.llm.conftest import ODD


def cheapest(supply, capacity, cost):
    """By trying all transports of unit goods."""
    goods = [i for i, s in enumerate(supply) for _ in range(s)]
    best = None
    for to in itertools.product(range(len(capacity)), repeat=len(goods)):
        if all(to.count(j) <= c for j, c in enumerate(capacity)):
            x = sum(cost[i][j] for i, j in zip(goods, to))
            best = x if best is None else min(best, x)
    return best


def test_flow_is_cheapest():
    rng = random.Random(1)
    for _ in range(60):
        n, m = rng.randint(1, 3), rng.randint(1, 3)
        supply = [rng.randint(0, 2) for _ in range(n)]
        capacity = [rng.randint(0, 3) for _ in range(m)]
        while sum(capacity) < sum(supply):
            capacity[rng.randrange(m)] += 1
        cost = [[rng.randint(0, 4) for _ in range(m)] for _ in range(n)]
        flow = R.min_cost_flow(supply, capacity, cost)
        assert [sum(r) for r in flow] == supply
        assert all(sum(r[j] for r in flow) <= capacity[j] for j in range(m))
        assert sum(flow[i][j] * cost[i][j] for i in range(n) for j in range(m)) == cheapest(supply, capacity, cost)


def checked(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    assert set(by) <= set(range(shards))
    return [sum(r.size for r in by.get(j, [])) for j in range(shards)]


def test_plan_balances_and_moves_little(docs_of):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(0, 400) + str(i)) for i in range(3000)]
    rows += [(3000 + i, "copy of a hot text " * 3) for i in range(1500)]        # a third: split
    rows += [(5000 + i, f"pair {i // 2}") for i in range(200)]                   # small groups stay whole
    docs = docs_of(rows)
    old = F.when(F.col("doc_id") < 2500, 0).otherwise(F.pmod("doc_id", F.lit(4)))
    out = R.plan(docs, old, 4).collect()
    assert len(out) == len(rows)
    sizes = checked(out, 4)
    assert max(sizes) <= 1.03 * sum(sizes) / 4
    held = [0] * 4
    for r in out:
        held[r.old_shard] += r.size
    least = sum(max(0, h - sum(held) // 4) for h in held)
    moved = sum(r.size for r in out if r.old_shard != r.shard)
    texts, where = dict(rows), {}
    for r in out:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for t, s in where.items() if t.startswith("pair"))
    assert len(where["copy of a hot text " * 3]) > 1
    assert moved <= least + 0.05 * sum(held)


def test_rewrite_touches_affected_shards_only(spark, docs_of, tmp_path):
    moves = spark.createDataFrame([(1, 0, 0, 0), (2, 0, 1, 0), (3, 2, 2, 0), (4, 1, 1, 1)],
                                  "doc_id long, old_shard int, shard int, slot long")
    docs = docs_of([(i, f"t{i}") for i in range(1, 5)])
    assert R.rewrite(docs, moves, str(tmp_path / "s")) == [0, 1]
    got = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.shard, r.slot, r.text) for r in got.collect()) == [(0, 0, "t1"), (1, 0, "t2"), (1, 1, "t4")]


def test_rewrite_keeps_null_and_repeated_ids_and_can_be_rerun(spark, docs_of, tmp_path):
    rows = ODD + [(20, f"t{i % 7}") for i in range(30)] + [(None, f"n{i}") for i in range(10)]
    docs = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "rid long, doc_id long, text string")
    moves = R.plan(docs, F.lit(0), 3, row_id="rid")
    path = str(tmp_path / "s")
    for _ in range(2):
        affected = R.rewrite(docs, moves, path, row_id="rid")
        got = spark.read.parquet(path)
        want = [r for r in moves.collect() if r.shard in affected]
        assert sorted((r.rid, r.shard, r.slot) for r in got.collect()) == sorted((r.rid, r.shard, r.slot) for r in want)
    assert len(want) == len(rows) and affected == [0, 1, 2]
    with pytest.raises(ValueError):
        R.rewrite(docs, moves, path)


def test_odd_rows(docs_of):
    out = R.plan(docs_of(ODD), F.lit(0), 4).collect()
    assert len(out) == len(ODD)
    checked(out, 4)
    assert next(r for r in out if r.doc_id == 1).size == 1 and next(r for r in out if r.doc_id == 1).text_crc32 == 0
    assert R.plan(docs_of([]), F.lit(0), 4).count() == 0


def test_after_has_every_row_where_the_plan_puts_it(spark, docs_of, tmp_path):
    rows = ODD + [(20, f"t{i % 7}") for i in range(30)] + [(None, f"n{i}") for i in range(10)]
    old = spark.createDataFrame([(i, d, t, 9) for i, (d, t) in enumerate(rows)],
                                "rid long, doc_id long, text string, slot int")
    moves = R.plan(old, F.lit(0), 3, row_id="rid")
    got = R.after(old, moves, str(tmp_path / "all"), "rid").collect()
    want = sorted((r.rid, r.shard, r.slot) for r in moves.collect())
    assert sorted((r.rid, r.shard, r.slot) for r in got) == want
    assert all((r.doc_id, r.text) == rows[r.rid] for r in got)


def test_after_reads_untouched_shards_from_the_old_rows(spark, tmp_path):
    old = spark.createDataFrame([(i, i, f"t{i}") for i in range(1, 6)], "rid long, doc_id long, text string")
    moves = spark.createDataFrame([(1, 0, 0, 0), (2, 0, 1, 0), (3, 2, 2, 0), (4, 1, 1, 1), (5, 2, 2, 1)],
                                  "rid long, old_shard int, shard int, slot long")
    got = R.after(old, moves, str(tmp_path / "s"), "rid").collect()
    assert sorted((r.shard, r.slot, r.text) for r in got) == [
        (0, 0, "t1"), (1, 0, "t2"), (1, 1, "t4"), (2, 0, "t3"), (2, 1, "t5")]
    still = moves.withColumn("shard", F.col("old_shard"))
    assert R.after(old, still, str(tmp_path / "none"), "rid").count() == 5
    assert not (tmp_path / "none").exists()


def test_query_rows(spark):
    """Sizes near equal, gapless slots, and the given texts' checksums."""
    from ledgerline.llm.queries import op9_reshard
    from tests.conftest import SF001

    out = op9_reshard(spark, SF001).collect()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("t")).select(
        "doc_id", (F.octet_length("t") + 1).alias("size"), F.crc32(F.col("t").cast("binary")).alias("crc")).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out) == sorted((r.doc_id, r.size, r.crc) for r in docs)
    sizes = checked(out, 16)
    assert sum(sizes) == sum(r.size for r in docs)
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in docs)
