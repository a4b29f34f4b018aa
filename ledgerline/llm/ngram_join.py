"""Exact n-gram Jaccard join: documents whose sets of word 5-grams have a
similarity of 0.75 or more are linked; linked documents form components.

1. Candidates (prefix filter). Two linked sets share a word gram among the
   floor(n/4) + 1 first ones of each, in any order that is the same for all
   documents. Here grams that occur in one document only come first: texts
   are dealt into blocks by a hash of the id, each block sends its grams,
   packed and cut by hash range, and gets back those that also occur
   elsewhere, with how often. A document with enough grams of its own needs no
   comparison; the others enter their rarest shared grams, and documents that
   share one fall into one candidate cluster. (In the order of the hash, lines
   that are everywhere would tie most candidates into one cluster, whose tiles
   grow with its square.)
2. Size-banded tiles. A small cluster is one tile. A large one is cut by
   size into bands (each 4/3 times the one before, so that linked sets lie
   in the same or in neighbouring bands) and by a hash into parts of about
   ``TILE`` documents; every two parts that may hold a link meet in a tile,
   which is a task of bounded size.
3. In a tile, hashed bitmaps bound the overlap from above by bit counts;
   pairs that pass are checked by exact intersection of the sorted grams. A
   pair that is connected already is not checked again, so a tile returns a
   forest of links, never all pairs of a group.

Documents with equal sets are one node (the smallest id). Rows that share an
id are in one component; a null id takes the component of its equals, or
null. Null or empty text: size 0, linked with nothing. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import components, freed, joined, packed, saved, text_blocks, total_bytes, unpacked

WORDS = 5
#: Text bytes of a block, and documents of a tile's side.
BLOCK, TILE = 8 << 20, 2048
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xBF58476D1CE4E5B9)


def gram_sets(texts: list[str], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word n-grams (A-Z in
    lower case, words between ASCII white space; fewer than n words: the
    whole sequence)."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    split = [np.array([number[w] for w in t.encode().lower().split()], np.int64) for t in texts]
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    out = []
    for s in split:
        if not len(s):
            out.append(np.zeros(0, np.uint64))
            continue
        h = word[s]
        k = min(n, len(h))
        g = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            g = (g ^ h[i:len(h) - k + 1 + i]) * _P
            g ^= g >> np.uint64(29)
        g *= _Q
        g ^= g >> np.uint64(32)
        out.append(np.unique(g))
    return out


def _range_bits(size: int) -> int:
    """Bits of the hash that make its range: some million grams a range."""
    return min(24, max(4, math.ceil(math.log2(max(1, size / 6 / 2e6)))))


def shared_grams(docs: DataFrame, bits: int) -> DataFrame:
    """``docs(block, text)`` -> (block, part, vals, often): for each block its
    grams that occur in two or more documents, and twice the logarithm of how
    often they were sent; a gram is known by ``bits`` + 32 bits (equal ones by
    chance cost time, not correctness)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(joined(batches, 2 * BLOCK), "text", 2 * BLOCK):
            sets = gram_sets(texts)
            g = np.concatenate(sets) >> np.uint64(32 - bits)
            b = np.repeat(rows.column("block").to_numpy(), [len(s) for s in sets])
            order = np.lexsort((g, b, g >> np.uint64(32)))
            g, b = g[order], b[order]
            third = np.zeros(len(g), bool)                    # two of a kind tell as much as more
            third[2:] = (g[2:] == g[:-2]) & (b[2:] == b[:-2])
            g, b = g[~third], b[~third]
            part = (g >> np.uint64(32)).astype(np.int32)
            first = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (b[1:] != b[:-1])) if len(g) else [])
            runs = np.stack((b[first], np.diff(np.append(first, len(g)))), 1).astype(np.int32)
            # a row a range: one a range and block would be a row a gram on a large corpus
            yield pa.RecordBatch.from_arrays(
                [*packed([part], g.astype(np.uint32)), packed([part[first]], runs.view("V8").ravel())[1]],
                ["part", "vals", "runs"])

    def several(key: tuple, t: pa.Table) -> pa.Table:
        v, _ = unpacked(t.column("vals"), np.uint32)
        b = np.repeat(*unpacked(t.column("runs"), np.int32)[0].reshape(-1, 2).T)
        order = np.argsort(v, kind="stable")
        v, b = v[order], b[order]
        same = np.zeros(len(v) + 1, bool)
        same[1:-1] = v[1:] == v[:-1]
        run = np.cumsum(~same[:-1]) - 1
        often = (2 * np.log2(np.bincount(run))).astype(np.uint8)[run]
        twice = same[1:] | same[:-1]
        v, b, often = v[twice], b[twice], often[twice]
        order = np.lexsort((v, b))
        v, b, often = v[order], b[order], often[order]
        once = np.append(True, (v[1:] != v[:-1]) | (b[1:] != b[:-1])) if len(v) else np.zeros(0, bool)
        v, b, often = v[once], b[once], often[once]
        keys = [np.full(len(v), key[0].as_py(), np.int32), b]
        return pa.Table.from_arrays([*packed(keys, v), packed(keys, often)[2]], ["part", "block", "vals", "often"])

    def back(key: tuple, t: pa.Table) -> pa.Table:
        return freed(several, key, t)

    return docs.mapInArrow(send, "part int, vals binary, runs binary").groupBy("part") \
        .applyInArrow(back, "part int, block int, vals binary, often binary")


def sets_with_shared(docs: DataFrame, shared: DataFrame, bits: int) -> DataFrame:
    """One row per row of ``docs(block, doc_id, text)``: doc_id, n, digest
    (d1, d2); for documents that may have a link also their gram set and the
    shared grams of their prefix: the rarest first, by hash among equally rare
    ones. ``often`` belongs to the gram, so the order is the same for all."""

    def of_block(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = [t or "" for t in left.column("text").to_pylist()]
        v, row = unpacked(right.column("vals"), np.uint32)
        known = (right.column("part").to_numpy().astype(np.uint64)[row] << np.uint64(32)) | v \
            if len(v) else np.zeros(0, np.uint64)
        order = np.argsort(known)
        known, often = known[order], unpacked(right.column("often"), np.uint8)[0][order]
        n, d1, d2, grams, prefix = [], [], [], [], []
        for s in gram_sets(texts):
            digest = xxhash.xxh3_128_digest(s.tobytes())
            n.append(len(s))
            d1.append(int.from_bytes(digest[:8], "big", signed=True))
            d2.append(int.from_bytes(digest[8:], "big", signed=True))
            rest = None
            if len(s) and len(known):
                cut = s >> np.uint64(32 - bits)
                at = np.minimum(np.searchsorted(known, cut), len(known) - 1)
                here = known[at] == cut
                others = s[here]
                room = len(s) // 4 + 1 - (len(s) - len(others))
                rest = others[np.argsort(often[at[here]], kind="stable")[:room]] if room > 0 else None
            grams.append(None if rest is None else s.tobytes())
            prefix.append(None if rest is None else rest.view(np.int64).tolist())
        return pa.Table.from_arrays([left.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()),
                                     pa.array(d2, pa.int64()), pa.array(grams, pa.binary()),
                                     pa.array(prefix, pa.list_(pa.int64()))],
                                    ["doc_id", "n", "d1", "d2", "grams", "prefix"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return freed(of_block, left, right)

    return docs.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        run, "doc_id long, n long, d1 long, d2 long, grams binary, prefix array<long>")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, of sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 175 * both >= 75 * (len(a) + len(b))


def tile_links(sets: list[np.ndarray], side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A forest of the links between ``sets`` (of different ``side`` only,
    if given)."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sets = [sets[i] for i in order]
    side = side[order] if side is not None else None
    size = np.array([len(s) for s in sets], np.int64)
    width = 1 << max(8, int(size[-1] * 2).bit_length()) if len(sets) else 256
    bits = np.zeros((len(sets), width // 64), np.uint64)
    for i, s in enumerate(sets):
        at = s >> np.uint64(64 - width.bit_length() + 1)
        np.bitwise_or.at(bits[i], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    ones = np.bitwise_count(bits).sum(1).astype(np.int64)
    group = np.arange(len(sets))
    out = []
    for i in range(1, len(sets)):
        lo = int(np.searchsorted(size, -(-75 * size[i] // 100)))
        if lo >= i:
            continue
        may = group[lo:i] != group[i]
        if side is not None:
            may &= side[lo:i] != side[i]
        js = lo + np.flatnonzero(may)
        if not len(js):
            continue
        both = np.bitwise_count(bits[js] & bits[i]).sum(1).astype(np.int64)
        # a bit that only one side has stands for a gram that only that side has
        most = np.minimum(size[i] - (ones[i] - both), size[js] - (ones[js] - both))
        good = 175 * most >= 75 * (size[i] + size[js])
        js = js[good][np.argsort(-most[good], kind="stable")]
        while len(js):
            j = js[0]
            js = js[1:]
            if linked(sets[i], sets[j]):
                out.append((order[i], order[j]))
                group[group == group[j]] = group[i]
                js = js[group[js] != group[i]]
    return out


def tiles(nodes: DataFrame) -> DataFrame:
    """``nodes(cluster, node, n, grams)`` with the tiles of each node: key
    (k1, k2, k3) and side. Small clusters share a key by a hash."""
    spark = nodes.sparkSession
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(4 / 3)).cast("long")
    nodes = nodes.withColumn("band", band)
    counts = nodes.groupBy("cluster", "band").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    sizes = counts.groupBy("cluster").agg(F.sum("m").alias("all_m"), F.sum("w").alias("all_w"))
    heavy = sizes.where(F.col("all_m") > TILE)
    parts = counts.join(heavy.select("cluster"), "cluster", "left_semi") \
        .select("cluster", "band", F.ceil(F.col("m") / TILE).alias("s"))
    weight = sizes.agg(F.coalesce(F.sum("all_w"), F.lit(0))).first()[0]
    few = max(spark.sparkContext.defaultParallelism, int(weight * 8 / (8 << 20)) + 1)
    light = nodes.join(heavy.select("cluster"), "cluster", "left_anti").select(
        F.pmod(F.xxhash64("cluster"), F.lit(few)).alias("k1"), F.lit(-1).cast("long").alias("k2"),
        F.lit(-1).cast("long").alias("k3"), F.lit(0).alias("side"), "cluster", "node", "grams")
    near = nodes.join(parts, ["cluster", "band"])
    for d, name in ((-1, "below"), (1, "above")):
        near = near.join(parts.select("cluster", (F.col("band") - d).alias("band"), F.col("s").alias(name)),
                         ["cluster", "band"], "left")
    at = lambda b, i: b * F.lit(1 << 32) + i
    own = F.pmod(F.xxhash64("node"), F.col("s"))
    pair = lambda lo, hi, side: F.struct(lo.cast("long").alias("k2"), hi.cast("long").alias("k3"), side.alias("side"))
    me = at(F.col("band"), F.col("own"))
    same = F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda j: pair(
        at(F.col("band"), F.least(j, F.col("own"))), at(F.col("band"), F.greatest(j, F.col("own"))),
        (F.col("own") > j).cast("int")))
    up = F.transform(F.sequence(F.lit(0), F.coalesce("above", F.lit(1)) - 1), lambda j: pair(
        me, at(F.col("band") + 1, j), F.lit(0)))
    down = F.transform(F.sequence(F.lit(0), F.coalesce("below", F.lit(1)) - 1), lambda j: pair(
        at(F.col("band") - 1, j), me, F.lit(1)))
    none = F.array().cast("array<struct<k2:bigint,k3:bigint,side:int>>")
    heavy_rows = near.withColumn("own", own).withColumn("t", F.explode(F.concat(
        same, F.when(F.col("above").isNotNull(), up).otherwise(none),
        F.when(F.col("below").isNotNull(), down).otherwise(none)))) \
        .select(F.col("cluster").alias("k1"), "t.k2", "t.k3", "t.side", "cluster", "node", "grams")
    return light.unionByName(heavy_rows)


def links(tiled: DataFrame) -> DataFrame:
    """A forest (a, b) of the links of each tile."""

    def of_tile(t: pa.Table) -> pa.Table:
        node, side = t.column("node").to_numpy(), t.column("side").to_numpy()
        cluster = t.column("cluster").to_numpy()
        cross = t.column("k2")[0].as_py() != t.column("k3")[0].as_py()
        grams = [np.frombuffer(x, np.uint64) for x in t.column("grams").to_pylist()]
        order = np.argsort(cluster, kind="stable")
        out = []
        for at in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            if len(at) > 1:
                found = tile_links([grams[i] for i in at], side[at] if cross else None)
                out += [(node[at[a]], node[at[b]]) for a, b in found]
        return pa.Table.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    def run(t: pa.Table) -> pa.Table:
        return freed(of_tile, t)

    return tiled.groupBy("k1", "k2", "k3").applyInArrow(run, "a long, b long")


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = total_bytes(docs)
    bits, n_blocks = _range_bits(size), max(1, math.ceil(size / BLOCK))
    docs = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int").alias("block"), "doc_id", "text")
    # each step's shuffle files go with it: together they are several times the input
    shared = saved(shared_grams(docs, bits), "gram-shared", tidy=True)
    sets = saved(sets_with_shared(docs, shared, bits), "gram-sets", tidy=True)
    rows = sets.select("doc_id", "n", "d1", "d2")
    # a written table: its joins are of two plain exchanges, which Spark can split at a frequent set
    reps = saved(rows.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "gram-reps", tidy=True)
    first = reps.withColumnRenamed("node", "doc_id")          # by id too: of equal sets one is kept, none is moved together
    nodes = saved(sets.where("grams is not null").join(first, ["d1", "d2", "doc_id"])
                  .select(F.col("doc_id").alias("node"), "n", "grams", "prefix")
                  .dropDuplicates(["node", "n", "prefix"]), "gram-nodes", tidy=True)
    posts = nodes.select("node", F.explode("prefix").alias("g"))
    least = posts.groupBy("g").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    meet = posts.join(least.select("g", "a"), "g").where("a < node").select("a", F.col("node").alias("b")).distinct()
    clusters = components(meet, "gram-clusters").select("node", F.col("root").alias("cluster"))
    found = links(tiles(nodes.join(clusters, "node").select("cluster", "node", "n", "grams")))
    placed = rows.join(reps, ["d1", "d2"], "left")
    # an id of several rows holds the nodes of all its texts together
    held = placed.where("node is not null and doc_id is not null").select("doc_id", "node").distinct()
    several = held.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    same_id = held.join(several, "doc_id").where("node > a").select("a", F.col("node").alias("b"))
    roots = components(found.unionByName(same_id), "gram-links")
    # a root of links between smallest ids is the smallest id of its component
    out = placed.join(roots, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("doc_id"))
                      .otherwise(F.coalesce("root", "node", "doc_id")).alias("component_id"))
