"""Prefix trie of conversations: ternary search trees per range shard.

A node is a distinct sequence of a conversation's first d turns (role and
text); its members are the conversations that start with it. Per node:
smallest member, its parent's smallest member, members, children, leaves
below, and the words that need not be computed again if every node's last
turn is kept for all its members, summed over the subtree.

1. ``positions``: place of every turn in its conversation, by a prefix sum
   in two levels (ranges of turn numbers).
2. ``chunks``: turns are encoded by a dictionary (a written table of
   distinct turns and their numbers) and packed, ``CHUNK`` turns a row.
   What stands before a chunk is known by a sum of position-dependent
   hashes (two of 61 bits), so a very long conversation is many rows.
3. ``nodes``: equal chunks after equal beginnings are one row. Rows are cut
   into ranges of the sequence of ids; a shard inserts its rows into a
   ternary search tree, the median first, then the medians of both halves,
   so each level is balanced. An iterative traversal sums members, leaves
   and savings from the leaves up. Nodes that another shard may have too
   (beginnings of a shard's first and last row, first and last node of a
   chunk) are merged by key with partial sums; all others are final.
4. Leaves and savings of a subtree may lie in other chunks and shards. Both
   are sums over members once it is known from which depth on a member is
   the smallest one of its nodes: a member shares the turns above that
   depth, and a leaf counts for its smallest member. So ``trie`` runs step
   3 twice, first for the smallest members, then with these weights.
5. ``ends``: per node the conversations that end there, as one hash; they
   are sorted by Spark and streamed.

Null role or text is empty; turns without a number come first; turns of
one number are ordered by role and text. Rows without a conversation id
belong to no conversation. Conversations without a turn (``members``) end
at the root. Repeated turns are turns of their own. Without a conversation
there is no node. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, saved

#: Turns in a row of ids, and turn numbers in a range.
CHUNK = 256
#: Turns in a shard, on average.
SHARD_TURNS = 200_000
_LOW = -(1 << 62)


# ---------------------------------------------------------------- turns ---

def positions(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, text of every turn of a conversation."""
    part = F.coalesce(F.expr(f"cast(turn AS bigint) div {CHUNK}"), F.lit(_LOW))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), part.alias("part"))
    order = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("conv_id", "part").count() \
        .withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inner = rows.withColumn("at", F.row_number().over(order))
    return inner.join(base, ["conv_id", "part"]).select("conv_id", (F.col("base") + F.col("at")).alias("pos"),
                                                        "role", "text")


def chunks(turns: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """``turns(conv_id, pos, role, text)`` as rows of turn ids (a written
    table): conv_id, k, ids, toks (words of each turn), p1, p2, base (hashes
    and words of what stands before), q1, q2 (hashes with this chunk), total
    (words of the conversation), last."""
    turn = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    rows = turns.select("conv_id", "pos", F.unhex(F.sha2(turn, 256)).alias("turn"),
                        F.regexp_count("text", F.lit(WORD)).cast("long").alias("tok"))
    rows = saved(rows, "trie-turns")
    words = saved(rows.select("turn").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    rows = rows.join(words, "turn").withColumn("k", F.expr(f"(pos - 1) div {CHUNK}"))
    packed = rows.groupBy("conv_id", "k").agg(F.array_sort(F.collect_list(F.struct("pos", "id", "tok"))).alias("t")) \
        .select("conv_id", "k", F.col("t.id").alias("ids"), F.col("t.tok").alias("toks"))
    if members is not None:
        none = members.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id")) \
            .distinct().join(turns.select("conv_id").distinct(), "conv_id", "left_anti")
        empty = F.array().cast("array<bigint>")
        packed = packed.unionByName(none.select("conv_id", F.lit(0).cast("long").alias("k"), empty.alias("ids"),
                                                empty.alias("toks")))
    size = F.aggregate("toks", F.lit(0).cast("long"), lambda a, x: a + x)
    span = F.lit(1 << 61)
    packed = packed.select("*", size.alias("size"), *[
        F.pmod(F.xxhash64(F.col("ids"), F.col("k"), F.lit(seed)), span).cast("decimal(38,0)").alias(f"d{seed}")
        for seed in (1, 2)])
    conv = Window.partitionBy("conv_id")
    before = conv.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)

    def prior(c: str):
        return F.coalesce(F.sum(c).over(before), F.lit(0)).cast("decimal(38,0)")

    out = packed.select("conv_id", "k", "ids", "toks", prior("d1").alias("p1"), prior("d2").alias("p2"),
                        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), "d1", "d2",
                        F.sum("size").over(conv).alias("total"), (F.max("k").over(conv) == F.col("k")).alias("last"))
    out = out.withColumn("q1", (F.col("p1") + F.col("d1")).cast("decimal(38,0)")) \
        .withColumn("q2", (F.col("p2") + F.col("d2")).cast("decimal(38,0)")).drop("d1", "d2")
    return saved(out, "trie-chunks")


# ---------------------------------------------------------------- shard ---

def medians(n: int) -> Iterator[int]:
    """0 .. n-1: the middle first, then the middles of both halves."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


class TernaryTree:
    """A ternary search tree over sequences of ids. Cell 0 is the root (no
    id); ``down`` is the first cell of the next level, ``low`` and ``high``
    cells of the same level with a smaller or a larger id."""

    def __init__(self):
        self.id, self.low, self.high, self.down = [None], [0], [0], [0]
        self.rows: list[list[int]] = [[]]                    # rows that end at the cell

    def _cell(self, x: int) -> int:
        for column, v in ((self.id, x), (self.low, 0), (self.high, 0), (self.down, 0), (self.rows, [])):
            column.append(v)
        return len(self.id) - 1

    def insert(self, seq, row: int) -> None:
        at = 0
        for x in seq:
            cell = self.down[at]
            if not cell:
                cell = self.down[at] = self._cell(x)
            while self.id[cell] != x:
                side = self.low if x < self.id[cell] else self.high
                if not side[cell]:
                    side[cell] = self._cell(x)
                cell = side[cell]
            at = cell
        self.rows[at].append(row)

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(cell, parent cell, depth), parents before children."""
        todo = [(0, 0, 0)]
        while todo:
            cell, parent, depth = todo.pop()
            yield cell, parent, depth
            level = [self.down[cell]] if self.down[cell] else []
            while level:
                c = level.pop()
                todo.append((c, cell, depth + 1))
                level += [x for x in (self.low[c], self.high[c]) if x]


def _key(depth: int, p1, p2, ids=()) -> bytes:
    """Name of a node: depth, what stands before its chunk, ids in the chunk."""
    tail = b"".join(struct.pack("<q", x) for x in ids)
    return hashlib.blake2b(f"{depth},{int(p1)},{int(p2)},".encode() + tail, digest_size=16).digest()


#: Of a node in a shard. kind: 0 final, 1 final but for its parent, 2 shared with another shard or chunk.
LOCAL = ("kind int, key binary, parent binary, depth long, owner long, owner_share long, parent_owner long, "
         "n long, children long, path long, tok long, share long, leaves long, end_min long")


def _class_nodes(rows: list[dict], edge_first: bool, edge_last: bool) -> Iterator[tuple]:
    """Nodes of the rows (sorted) of one chunk number and beginning."""
    head = rows[0]
    k, p1, p2, base = head["k"], head["p1"], head["p2"], head["base"]
    tree = TernaryTree()
    for i in medians(len(rows)):
        tree.insert(rows[i]["ids"], i)
    order = list(tree.walk())
    cells = len(tree.id)
    n, share, leaves, kids = [0] * cells, [0] * cells, [0] * cells, [0] * cells
    owner: list[tuple | None] = [None] * cells               # smallest member and what it shares
    ending: list[int | None] = [None] * cells
    following: list[tuple | None] = [None] * cells           # names of full chunks' last nodes
    for cell, _, depth in order:
        for i in tree.rows[cell]:
            r = rows[i]
            n[cell] += r["n"]
            share[cell] += r["share"]
            leaves[cell] += r["leaves"]
            mine = (r["owner"], r["owner_share"])
            owner[cell] = mine if owner[cell] is None else min(owner[cell], mine)
            if r["end_min"] is not None:
                ending[cell] = r["end_min"] if ending[cell] is None else min(ending[cell], r["end_min"])
            if depth == CHUNK:
                following[cell] = (r["q1"], r["q2"])
    for cell, parent, depth in reversed(order):              # children before parents
        if depth:
            n[parent] += n[cell]
            share[parent] += share[cell]
            leaves[parent] += leaves[cell]
            kids[parent] += 1
            owner[parent] = owner[cell] if owner[parent] is None else min(owner[parent], owner[cell])
    edges = [r["ids"] for r, on in ((rows[0], edge_first), (rows[-1], edge_last)) if on]
    names: dict[int, bytes] = {0: _key(k * CHUNK, p1, p2)}
    path, on_edge, tok = [base] * cells, [()] * cells, [0] * cells
    on_edge[0] = tuple(range(len(edges)))
    sizes = _sizes(tree, rows, order)
    for cell, parent, depth in order:
        if depth:
            tok[cell] = sizes[cell]
            path[cell] = path[parent] + tok[cell]
            on_edge[cell] = tuple(e for e in on_edge[parent] if len(edges[e]) >= depth and edges[e][depth - 1] == tree.id[cell])
            if following[cell] is not None:
                names[cell] = _key((k + 1) * CHUNK, *following[cell])
            elif on_edge[cell]:
                names[cell] = _key(k * CHUNK + depth, p1, p2, edges[on_edge[cell][0]][:depth])
        if cell == 0 and k:                                   # counted as the last node of the chunk before
            yield 2, names[0], None, k * CHUNK, None, None, None, 0, 0, None, None, 0, 0, None
            continue
        above = names.get(parent) if depth else None
        kind = 2 if cell in names else 1 if above else 0
        yield (kind, names.get(cell), above, k * CHUNK + depth, owner[cell][0], owner[cell][1],
               owner[parent][0] if depth and above is None else None, n[cell], 0 if kind == 2 else kids[cell], path[cell], tok[cell],
               share[cell], leaves[cell], ending[cell])


def _sizes(tree: TernaryTree, rows: list[dict], order) -> list[int]:
    """Words of each cell's turn, from any row that passes through it."""
    passing: list[int | None] = [None] * len(tree.id)
    out = [0] * len(tree.id)
    for cell, parent, depth in reversed(order):
        if tree.rows[cell]:
            passing[cell] = tree.rows[cell][0]
        if depth:
            out[cell] = rows[passing[cell]]["toks"][depth - 1]
            passing[parent] = passing[cell]
    return out


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one sorted range. One class of rows is held at a time."""
    schema = pa.schema([("kind", pa.int32()), ("key", pa.binary()), ("parent", pa.binary()),
                        *[(c.split()[0], pa.int64()) for c in LOCAL.split(", ")[3:]]])

    def classes():
        group: list[dict] = []
        for b in batches:
            for r in b.to_pylist():
                if group and (r["k"], r["p1"], r["p2"]) != (group[0]["k"], group[0]["p1"], group[0]["p2"]):
                    yield group
                    group = []
                group.append(r)
        if group:
            yield group

    out: list[tuple] = []
    held, first = None, True
    for group in classes():
        if held is not None:
            out += _class_nodes(held, first, False)
            first = False
        held = group
        if len(out) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if held is not None:
        out += _class_nodes(held, first, True)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


# ---------------------------------------------------------------- nodes ---

def nodes(rows: DataFrame) -> DataFrame:
    """The merged nodes of ``rows`` (``chunks`` with share and leaf, the
    weights of their conversation): depth, owner, parent_owner, n, children,
    path, tok, share (without the owner's), leaves, end_min."""
    ended = F.when(F.col("last"), F.col("conv_id"))
    order = ["k", "p1", "p2", "ids"]
    alike = rows.groupBy(*order, "base", "toks", "q1", "q2").agg(
        F.count("*").alias("n"), F.min(F.struct("conv_id", "share")).alias("o"), F.sum("share").alias("share"),
        F.sum("leaf").alias("leaves"), F.min(ended).alias("end_min"))
    alike = saved(alike.select(*order, "base", "toks", "q1", "q2", "n", F.col("o.conv_id").alias("owner"),
                               F.col("o.share").alias("owner_share"), "share", "leaves", "end_min"), "trie-rows")
    turns = alike.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    ranged = alike.repartitionByRange(max(1, -(-turns // SHARD_TURNS)), *order).sortWithinPartitions(*order)
    local = saved(ranged.mapInArrow(_shard, LOCAL), "trie-local")
    shared = local.where("kind = 2").groupBy("key").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"),
        F.min(F.when(F.col("owner").isNotNull(), F.struct("owner", "owner_share"))).alias("o"),
        F.sum("n").alias("n"), F.max("path").alias("path"), F.max("tok").alias("tok"), F.sum("share").alias("share"),
        F.sum("leaves").alias("leaves"), F.min("end_min").alias("end_min"),
        F.max("parent_owner").alias("parent_owner"))        # known where the parent is final
    shared = saved(shared, "trie-shared")
    below = shared.select("parent").unionByName(local.where("kind = 1").select("parent"))
    below = below.groupBy("parent").agg(F.count("*").alias("children"))
    owners = shared.select(F.col("key").alias("parent"), F.col("o.owner").alias("above"))
    top = shared.join(below.select(F.col("parent").alias("key"), "children"), "key", "left") \
        .join(owners, "parent", "left")
    cols = ["depth", "owner", "parent_owner", "n", "children", "path", "tok", "share", "leaves", "end_min"]
    top = top.select("depth", F.col("o.owner").alias("owner"), F.coalesce("above", "parent_owner").alias("parent_owner"), "n",
                     F.coalesce("children", F.lit(0)).alias("children"), "path", "tok",
                     (F.col("share") - F.col("o.owner_share")).alias("share"), "leaves", "end_min")
    own = local.where("kind < 2").withColumn("share", F.col("share") - F.col("owner_share"))
    middle = own.where("kind = 1").join(owners, "parent").withColumn("parent_owner", F.col("above"))
    return own.where("kind = 0").select(*cols).unionByName(middle.select(*cols)).unionByName(top.select(*cols))


def ends(rows: DataFrame) -> DataFrame:
    """(end_min, ends_sha256): conversations that are equal as a whole, by
    the smallest of them; the ids are hashed in ascending order as they
    stream by, so a large group takes no memory."""
    same = ["k", "size", "q1", "q2"]
    done = rows.where("last").select("conv_id", "k", F.size("ids").alias("size"), "q1", "q2")

    def work(batches):
        now, first, h, out = None, None, None, []
        for b in batches:
            columns = [b.column(c).to_pylist() for c in (*same, "conv_id")]
            for *key, conv in zip(*columns):
                if key != now:
                    if now is not None:
                        out.append((first, h.hexdigest()))
                    now, first, h = key, conv, hashlib.sha256(str(conv).encode())
                else:
                    h.update(f",{conv}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["end_min", "ends_sha256"])
                out = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([h.hexdigest()])],
                                             names=["end_min", "ends_sha256"])

    return done.repartition(*same).sortWithinPartitions(*same, "conv_id") \
        .mapInArrow(work, "end_min long, ends_sha256 string")


def trie(turns: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """One row per node of the trie of ``turns(conv_id, pos, role, text)``
    (see ``positions``): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. ``members(conv_id)``
    may name conversations without a turn."""
    rows = chunks(turns, members)
    zero = F.lit(0).cast("long")
    shape = saved(nodes(rows.withColumn("share", zero).withColumn("leaf", zero)), "trie-shape")
    weight = shape.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min_by(F.col("path") - F.col("tok"), "depth").alias("_share"),
        F.max((F.col("children") == 0).cast("long")).alias("_leaf"))
    weighted = rows.join(weight, "conv_id", "left").withColumn("share", F.coalesce("_share", "total")) \
        .withColumn("leaf", F.coalesce("_leaf", zero)).drop("_share", "_leaf")
    done = nodes(weighted).join(ends(rows), "end_min", "left")
    none = hashlib.sha256(b"").hexdigest()
    return done.select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent_owner").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("share") - (F.col("n") - 1) * (F.col("path") - F.col("tok"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


# ------------------------------------------------- the query's own input ---

def with_shared_heads(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation c starts with the first h turns of conversation c -
    c % 20 (h = crc32 of c as text, modulo 4) and goes on after its own
    first h. Returns the turns with their places, and all conversations."""
    rows = saved(positions(conversations), "trie-placed")
    convs = rows.select("conv_id").distinct() \
        .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4) \
        .withColumn("source", F.col("conv_id") - F.col("conv_id") % 20)
    heads = rows.where("pos <= 3").withColumnRenamed("conv_id", "source")
    taken = convs.join(heads, "source").where("pos <= h").select("conv_id", "pos", "role", "text")
    size = convs.join(heads.groupBy("source").agg(F.max("pos").alias("has")), "source", "left") \
        .select("conv_id", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("taken"))
    own = rows.join(size, "conv_id").where("pos > h") \
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "role", "text")
    return taken.unionByName(own), convs.select("conv_id")


ORACLE = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, c - c % 20 AS b,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1),
               lambda i: ascii(substr(s, i, 1))::BIGINT)),
             lambda crc, v: list_reduce(list_concat([xor(crc, v)], range(8)::BIGINT[]),
               lambda w, i: xor(w >> 1, 3988292384 * (w & 1)))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM t)),
got AS (SELECT i.c, i.h, count(t.p) AS n FROM ids i LEFT JOIN t ON t.c = i.b AND t.p <= i.h GROUP BY i.c, i.h),
turns AS (
  SELECT i.c, t.p, t.r, t.x FROM ids i JOIN t ON t.c = i.b AND t.p <= i.h
  UNION ALL
  SELECT t.c, t.p - g.h + g.n, t.r, t.x FROM t JOIN got g ON g.c = t.c WHERE t.p > g.h),
hashed AS (
  SELECT c, p AS d, md5(length(r) || ':' || r || x) AS m,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w FROM turns),
pairs AS (
  SELECT c, d, sha256(string_agg(m, '') OVER (PARTITION BY c ORDER BY d)) AS k, w FROM hashed
  UNION ALL SELECT c, 0, '', 0 FROM ids),
placed AS (
  SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, max(d) OVER (PARTITION BY c) = d AS done FROM pairs),
node AS (
  SELECT d, k, min(up) AS up, count(*) AS n, min(c) AS c, max(w) AS w,
         string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE done) AS ended
  FROM placed GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY d, up),
full_node AS (
  SELECT v.*, coalesce(s.n, 0) AS children FROM node v LEFT JOIN kids s ON s.d = v.d AND s.k = v.k),
summed AS (
  SELECT a.d, a.k, sum(CASE WHEN u.children = 0 THEN 1 ELSE 0 END) AS leaves, sum((u.n - 1) * u.w) AS saved
  FROM full_node u JOIN pairs a ON a.c = u.c AND a.d <= u.d GROUP BY a.d, a.k)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, q.c AS parent_conv_id, v.n AS n_convs, v.children AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(v.ended, '')) AS ends_sha256
FROM full_node v JOIN summed s ON s.d = v.d AND s.k = v.k
LEFT JOIN node q ON q.d = v.d - 1 AND q.k = v.up
"""
