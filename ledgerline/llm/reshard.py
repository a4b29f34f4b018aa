"""Resharding by minimum-cost flow.

The data lie in old shards of uneven size; every new shard has a capacity.
Blocks of rows are the unit of transfer. A small transport network (old
shards, new shards; a byte that stays where it is costs 0, a byte that
moves costs 1) is solved by successive shortest paths on the driver: its
size depends on the number of shards alone. The flow then tells each old
shard how many bytes go where; its blocks are laid out in order and cut
where the flow says so. Only shards that gain or lose rows are rewritten.

Rows of equal text form a group. A group moves as one and stays in one
shard, unless it holds more than ``GROUP_SHARE`` of a shard's capacity:
such a hot group is split by doc_id, since sizes could not be equal
otherwise.

Null text counts as no bytes (size 1) and is a text of its own; null or
repeated ids, ties and repeated rows are placed like any other row; an
empty table gives an empty result; extra columns are ignored by ``plan``
and kept by ``rewrite`` (but for ones named shard or slot, which it sets).
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import saved

#: Blocks an old shard is cut into (the plan's size is shards x BLOCKS).
BLOCKS = 1024
#: A group of equal texts over this share of a shard's capacity is split.
GROUP_SHARE = 0.01


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Cheapest transport of all supplies into the capacities
    (sum(supply) <= sum(capacity)): successive shortest paths with
    potentials on the residual network."""
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards can't hold the data")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    phi = [0] * (n + m)
    while any(left):
        dist = [0 if i < n and left[i] else None for i in range(n + m)]
        dist = [d + (0 - phi[i]) if d is not None else None for i, d in enumerate(dist)]
        heap = [(d, i) for i, d in enumerate(dist) if d is not None]
        heapq.heapify(heap)
        came: dict[int, int] = {}
        done = set()
        while heap:
            d, u = heapq.heappop(heap)
            if u in done:
                continue
            done.add(u)
            if u < n:
                steps = [(n + j, cost[u][j]) for j in range(m)]
            else:
                steps = [(i, -cost[i][u - n]) for i in range(n) if flow[i][u - n]]
            for v, c in steps:
                new = d + c + phi[u] - phi[v]
                if dist[v] is None or new < dist[v]:
                    dist[v], came[v] = new, u
                    heapq.heappush(heap, (new, v))
        ends = [j for j in range(m) if room[j] and dist[n + j] is not None]
        end = min(ends, key=lambda j: (dist[n + j] + phi[n + j], j))
        path = [n + end]
        while path[-1] in came:
            path.append(came[path[-1]])
        path.reverse()
        amount = min([left[path[0]], room[end]] +
                     [flow[v][u - n] for u, v in zip(path, path[1:]) if u >= n])
        for u, v in zip(path, path[1:]):
            if u < n:
                flow[u][v - n] += amount
            else:
                flow[v][u - n] -= amount
        left[path[0]] -= amount
        room[end] -= amount
        far = max(d for d in dist if d is not None)
        phi = [p + (far if d is None else d) for p, d in zip(phi, dist)]
    return flow


def lay_out(blocks: list[tuple[int, int, int]], capacity: list[int]) -> dict[tuple[int, int], int]:
    """(old shard, block) -> new shard, for ``blocks`` (old shard, block,
    bytes). Each block goes whole to the shard that still lacks most of the
    flow from its old shard, large blocks first."""
    n, m = max([o for o, _, _ in blocks], default=-1) + 1, len(capacity)
    supply = [0] * n
    for o, _, size in blocks:
        supply[o] += size
    flow = min_cost_flow(supply, capacity, [[int(i != j) for j in range(m)] for i in range(n)])
    room = list(capacity)
    out = {}
    for o, b, size in sorted(blocks, key=lambda x: (-x[2], x[0], x[1])):
        goal = [j for j in range(m) if flow[o][j] > 0] or list(range(m))
        j = max(goal, key=lambda j: (flow[o][j] >= size, min(flow[o][j], room[j]), j == o, -j))
        if flow[o][j] <= 0 or room[j] < size // 2:            # rounding to whole blocks: the emptiest
            j = max(range(m), key=lambda j: (room[j], j == o, -j))
        out[(o, b)] = j
        flow[o][j] -= size
        room[j] -= size
    return out


def plan(docs: DataFrame, old_shard: Column, n_new: int = 16, text: str = "text",
         doc_id: str = "doc_id", row_id: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, old_shard,
    shard, slot, and ``row_id`` if it names a column that tells rows apart
    (ids may be null or repeated). ``old_shard`` gives the present shard (0, 1, ...) of a row;
    the new shards have equal capacity. No text crosses a shuffle."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    own = [F.col(row_id).alias("row_id")] if row_id else []
    rows = docs.select(*own, F.col(doc_id).alias("doc_id"), (F.length(body).cast("long") + 1).alias("size"),
                       F.crc32(body).alias("text_crc32"), F.xxhash64(F.col(text)).alias("t1"),
                       F.hash(F.col(text), F.length(body)).alias("t2"), old_shard.cast("int").alias("was"))
    groups = rows.groupBy("t1", "t2", "was").agg(F.sum("size").alias("bytes"))
    groups = saved(groups.groupBy("t1", "t2").agg(
        F.sum("bytes").alias("bytes"),
        F.min_by("was", F.struct(-F.col("bytes"), F.col("was"))).alias("home")), "groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    split = F.col("bytes") > F.lit(GROUP_SHARE * total / n_new)
    # a hot group is known by few rows: at most n_new / GROUP_SHARE of them
    hot = groups.where(split).select("t1", "t2", F.lit(True).alias("hot"))
    small = groups.where(~split).select("t1", "t2", "home")
    tagged = rows.join(F.broadcast(hot), ["t1", "t2"], "left")
    alone = tagged.where("hot").withColumn("home", F.col("was")) \
        .withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit("rows")), F.lit(BLOCKS)))
    grouped = tagged.where("hot is null").join(small, ["t1", "t2"]) \
        .withColumn("block", F.pmod(F.xxhash64("t1", "t2"), F.lit(BLOCKS)))
    cols = ["doc_id", "size", "text_crc32", "was", "home", "block", "t1"] + ["row_id"] * len(own)
    placed = saved(grouped.select(*cols).unionByName(alone.select(*cols)), "placed")
    sizes = placed.groupBy("home", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    share, over = divmod(total, n_new)
    goes = lay_out([(r.home, r.block, r.bytes) for r in sizes],
                   [share + (j < over) for j in range(n_new)])
    first, start = {}, [0] * n_new                            # slots of a block begin here
    for r in sorted(sizes, key=lambda r: (r.home, r.block)):
        j = goes[(r.home, r.block)]
        first[(r.home, r.block)] = start[j]
        start[j] += r.n
    to = docs.sparkSession.createDataFrame(
        [(h, b, j, first[(h, b)]) for (h, b), j in goes.items()], "home int, block long, shard int, first long")
    # a row per block: at most BLOCKS x old shards
    inside = Window.partitionBy("home", "block").orderBy(F.col("doc_id").asc_nulls_first(), "t1", *cols[7:])
    return placed.join(F.broadcast(to), ["home", "block"]).select(
        "doc_id", "size", "text_crc32", F.col("was").alias("old_shard"), "shard",
        (F.col("first") + F.row_number().over(inside) - 1).alias("slot"), *[F.col("row_id").alias(row_id) for _ in own])


def rewrite(old: DataFrame, moves: DataFrame, path: str, doc_id: str = "doc_id",
            row_id: str | None = None) -> list[int]:
    """Write the new content of every affected shard (one that gains or
    loses a row) below ``path``/shard=N, in slot order; returns the affected
    shards. ``row_id`` names a column of ``old`` and ``moves`` that tells
    rows apart; without it the ids must, and null or repeated ones raise.
    Shards that keep their rows are left alone; a rerun replaces what it
    wrote."""
    key = row_id or doc_id
    n, ids = old.agg(F.count("*"), F.count_distinct(key)).first()
    if n != ids:
        raise ValueError(f"{key} is null or repeated: rewrite needs a row_id that tells rows apart")
    changed = moves.where("old_shard <> shard").select(
        F.explode(F.array("old_shard", "shard")).alias("s")).distinct()
    affected = sorted(r.s for r in changed.collect())         # bounded by the number of shards
    if affected:
        rows = old.drop("shard", "slot").join(moves.where(F.col("shard").isin(affected)).select(
            F.col(row_id or "doc_id").alias(key), "shard", "slot"), key)
        rows.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot") \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd") \
            .partitionBy("shard").parquet(path)
    return affected


def after(old: DataFrame, moves: DataFrame, path: str, row_id: str) -> DataFrame:
    """Rewrite the affected shards below ``path`` and read all shards as they
    are now: the rewritten ones from their files, the others from ``old``.
    The columns of ``old``, shard and slot."""
    affected = rewrite(old, moves, path, row_id=row_id)
    rows = old.drop("shard", "slot")
    kept = rows.join(moves.where(~F.col("shard").isin(affected)).select(row_id, "shard", "slot"), row_id)
    if not affected:
        return kept
    written = old.sparkSession.read.schema(kept.schema).parquet(path)
    # every row is in a rewritten shard: nothing of the old ones is read
    return written.unionByName(kept) if moves.where(~F.col("shard").isin(affected)).head() else written
