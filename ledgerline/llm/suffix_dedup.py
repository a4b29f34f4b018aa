"""Exact removal of repeated 100-byte strings with a collection BWT.

A byte goes if a ``SPAN``-byte string covers it that also starts earlier (in
a document of smaller id, or earlier in the same one). All strings are
judged on the input.

1. Minimum-substring partitioning. The key of a string is the smallest hash
   among its ``GRAM``-byte grams; equal strings have equal keys. Runs of
   neighbouring strings with one key form a segment. Texts are dealt into
   blocks by a hash of the id; each block sends the hashes of its key grams,
   packed and cut by range, and gets back those that stand in two places or
   more. Only segments with such a key go on, each once a block.
2. Column-wise construction. Segments of one hash range are cut to the
   strings whose hash stands twice among them, and form collections. Round by round one symbol of every segment is inserted, from
   its last to its first: the place of the new suffix follows from the rank
   of its first symbol in the collection's Burrows-Wheeler transform, its
   common prefix with its neighbours from the range minimum of the common
   prefixes between equal symbols (+ 1). Every round reads transform, common
   prefixes and places in order and writes them in order, with the new rows
   merged in. A segment has less than SPAN + WIDTH bytes, so the rounds are
   bounded. Neighbours with a common prefix of SPAN or more are equal
   strings; all but the first in the order of the documents are repeats.
   A key with more than ``HOT`` bytes of segments (a passage between ever
   different neighbours) is no collection: its strings are looked at one by
   one. Each batch of segments keeps the earliest place of a string; those
   meet by the string's SHA-256, and all but the first are repeats.
3. The spans go back to the blocks, which cut their texts.

The rounds run over arrays in the memory of a task (a collection is one hash
range of a few MB), not over files: executors' folders are not shared.

Null text counts as empty; texts under SPAN bytes lose nothing. Null ids
come last in the order. Rows that share an id are ordered by their text, so
all but one of some equal rows lose all they have. Extra columns are kept
by ``remove`` and ignored by ``spans``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import freed, give_back, joined, packed, saved, text_blocks, total_bytes, unpacked

SPAN, GRAM = 100, 48
#: Grams of a string; strings of a segment at most.
WIDTH = SPAN - GRAM + 1
BLOCK = 8 << 20
#: Strings of a long text that are looked at together.
PIECE = 1 << 20
#: Bytes of a collection, if no single key needs more.
COLLECTION = 1 << 16
#: Bytes of a key's segments above which its strings are dealt one by one.
HOT = 1 << 20
LAST = np.iinfo(np.int64).max
_B = 0x9E3779B97F4A7C15
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if len(_POW.get("up", ())) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for name, base in (("up", _B), ("down", pow(_B, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POW[name] = np.cumprod(p)
    return _POW["up"][:n], _POW["down"][:n]


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        x = best(x[:-have], x[have:])
        have *= 2
    return best(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def pieces(text: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of a text: first string, key of each string, hash of each gram; a
    long text comes in pieces."""
    for a in range(0, max(0, len(text) - SPAN + 1), PIECE):
        t = np.frombuffer(text, np.uint8, min(len(text) - a, PIECE + SPAN - 1), a).astype(np.uint64) + np.uint64(1)
        up, down = _powers(len(t))
        s = np.zeros(len(t) + 1, np.uint64)
        np.cumsum(t * up, out=s[1:])
        h = (s[GRAM:] - s[:-GRAM]) * down[:len(t) - GRAM + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        yield a, _slide(h, WIDTH, np.minimum), h


def key_places(key: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Grams that are the key of a string: no string around them has a
    larger key than their hash."""
    wide = np.concatenate((np.zeros(WIDTH - 1, np.uint64), key, np.zeros(WIDTH - 1, np.uint64)))
    return np.flatnonzero(_slide(wide, WIDTH, np.maximum) == h)


def _range_bits(size: int) -> int:
    return min(24, max(4, math.ceil(math.log2(max(1, size / 35 / 2e5)))))


def repeated_keys(docs: DataFrame, bits: int) -> DataFrame:
    """``docs(block, text)`` -> (part, block, vals): of each block the keys
    (``bits`` + 32 bits of them) that stand in several places."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(joined(batches, BLOCK), "text", BLOCK):
            found, blocks = [np.zeros(0, np.uint64)], []
            for b, t in zip(rows.column("block").to_pylist(), texts):
                got = [h[key_places(key, h)] for _, key, h in pieces(t.encode())]
                found += got
                blocks.append((b, sum(map(len, got))))
            v = np.concatenate(found) >> np.uint64(32 - bits)
            b = np.repeat(np.array([x[0] for x in blocks], np.int32), [x[1] for x in blocks])
            order = np.lexsort((v, b))
            v, b = v[order], b[order]
            third = np.zeros(len(v), bool)                    # two of a kind tell as much as more
            third[2:] = (v[2:] == v[:-2]) & (b[2:] == b[:-2])
            v, b = v[~third], b[~third]
            yield pa.RecordBatch.from_arrays(
                packed([(v >> np.uint64(32)).astype(np.int32), b], v.astype(np.uint32)), ["part", "block", "vals"])

    def several(key: tuple, t: pa.Table) -> pa.Table:
        v, row = unpacked(t.column("vals"), np.uint32)
        b = t.column("block").to_numpy()[row]
        order = np.lexsort((b, v))
        v, b = v[order], b[order]
        same = np.zeros(len(v) + 1, bool)
        same[1:-1] = v[1:] == v[:-1]
        twice = same[1:] | same[:-1]
        v, b = v[twice], b[twice]
        once = np.append(True, (v[1:] != v[:-1]) | (b[1:] != b[:-1])) if len(v) else np.zeros(0, bool)
        v, b = v[once], b[once]
        order = np.argsort(b, kind="stable")
        return pa.Table.from_arrays(packed([np.full(len(v), key[0].as_py(), np.int32), b[order]], v[order]),
                                    ["part", "block", "vals"])

    def back(key: tuple, t: pa.Table) -> pa.Table:
        return freed(several, key, t)

    kind = "part int, block int, vals binary"
    return docs.mapInArrow(send, kind).groupBy("part").applyInArrow(back, kind)


def _ordered(t: pa.Table) -> tuple[list[int], list[bytes], np.ndarray]:
    """Rows of a block in the order of the documents: row numbers, texts and
    ids (null: LAST)."""
    texts = [(x or "").encode() for x in t.column("text").to_pylist()]
    ids = t.column("doc_id").fill_null(LAST).to_numpy()
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return order, [texts[i] for i in order], ids[order]


def _several(at: np.ndarray, value: np.ndarray, lo: np.ndarray, hi: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether ``key`` stands twice or more among ``value`` at places lo..hi."""
    i, j = np.searchsorted(at, lo), np.searchsorted(at, hi, "right")
    n = np.zeros(len(lo), np.int64)
    for k in range(8):
        p = np.minimum(i + k, len(at) - 1)
        n += (i + k < j) & (value[p] == key)
    return (n > 1) | (j - i > 8)


def segments(docs: DataFrame, repeated: DataFrame, bits: int, ranges: int) -> DataFrame:
    """Segments with repeated keys, each distinct one once a block (part,
    key, block, row, id, start, body, periodic), and rows without a body:
    spans that repeat an earlier segment of the same block."""

    def cut_up(left: pa.Table, right: pa.Table) -> pa.Table:
        _, texts, ids = _ordered(left)
        v, row = unpacked(right.column("vals"), np.uint32)
        known = np.sort((right.column("part").to_numpy().astype(np.uint64)[row] << np.uint64(32)) | v) \
            if len(v) else np.zeros(0, np.uint64)
        seen: set[bytes] = set()
        out = []
        for r, t in enumerate(texts if len(known) else []):
            for a, key, h in pieces(t):
                cut = key >> np.uint64(32 - bits)
                hit = known[np.minimum(np.searchsorted(known, cut), len(known) - 1)] == cut
                if not hit.any():
                    continue
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                n = np.diff(np.append(first, len(key)))
                more = -(-n // WIDTH)                          # longer runs are cut
                at = np.repeat(first, more) + WIDTH * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more))
                end = np.minimum(at + WIDTH, np.repeat(first + n, more))
                keep = hit[at]
                at, end = at[keep], end[keep]
                places = key_places(key, h)
                twice = _several(places, h[places], at, end + WIDTH - 2, key[at])
                for s, e, k, p in zip((at + a).tolist(), (end + a).tolist(), key[at].tolist(), twice.tolist()):
                    body = t[s:e + SPAN - 1]
                    if body in seen:
                        out.append((k, r, int(ids[r]), s, e + SPAN - 1, None, False))
                    else:
                        seen.add(body)
                        out.append((k, r, int(ids[r]), s, e + SPAN - 1, body, p))
        cols = list(zip(*out)) if out else [()] * 7
        key = np.array(cols[0], np.uint64)
        block = left.column("block")[0].as_py() if len(left) else 0
        return pa.Table.from_arrays(
            [pa.array((key % np.uint64(ranges)).astype(np.int64)), pa.array(key.view(np.int64)),
             pa.array([block] * len(out), pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.binary()),
             pa.array(cols[6], pa.bool_())],
            ["part", "key", "block", "row", "doc_id", "a", "b", "body", "periodic"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return freed(cut_up, left, right)

    return docs.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(
        run, "part long, key long, block int, row int, doc_id long, a long, b long, body binary, periodic boolean")


def _merged(old: np.ndarray, fresh: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``old`` with the ``fresh`` rows merged in at the places ``at``."""
    gap = np.ones(len(old) + len(fresh), bool)
    gap[at] = False
    out = np.empty(len(gap), old.dtype)
    out[gap] = old
    out[at] = fresh
    return out


def collection_bwt(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of all ``bodies`` in order: document, length and common
    prefix with the suffix before (at most 255), the empty ones first.

    The transform is kept in the order of its symbols: ``by`` has, sorted,
    the symbol before each suffix (high bits) and the suffix's place. So a
    round neither sorts it nor looks at it by place."""
    m = len(bodies)
    size = np.array([len(b) for b in bodies], np.int64)
    end = np.cumsum(size)
    text = np.frombuffer(b"".join(bodies), np.uint8)
    used = np.zeros(256, bool)
    used[text] = True
    code = np.cumsum(used)                                    # symbols from 1 on; 0: nothing stands before
    bits, kind = (24, np.uint32) if code[-1] < 256 and m + len(text) < 1 << 24 else (40, np.uint64)
    flat = (code.astype(kind) << kind(bits))[text]
    place = kind((1 << bits) - 1)
    lcp = np.zeros(m, np.uint8)
    old = live = np.flatnonzero(size > 0)                     # old: where each live document's newest suffix stands
    own = flat[end[live] - 1]
    by = np.arange(m, dtype=kind)
    by[live] |= own
    by.sort()
    for j in range(1, int(size.max(initial=0)) + 1):
        n = len(by)
        k = np.searchsorted(by, own | old.astype(kind))
        new = k + len(live)                                   # symbol + suffix stands here, new rows included
        # common prefixes: 1 + least one between the neighbours with the same symbol
        before, after = by[k - 1], by[np.minimum(k + 1, n - 1)]
        has_before = (k > 0) & (before & ~place == own)
        has_after = (k + 1 < n) & (after & ~place == own)
        before, after = (before & place).astype(np.int64), (after & place).astype(np.int64)
        low = _range_min(lcp, np.where(has_before, before + 1, old), old)
        high = _range_min(lcp, np.where(has_after, old + 1, old), np.where(has_after, after, old))
        symbol = np.zeros(len(live), kind)
        more = size[live] > j
        symbol[more] = flat[end[live[more]] - j - 1]
        # write transform and common prefixes again, the new rows merged in
        moved = np.ones(n + len(live), bool)
        moved[new] = False
        moved = np.flatnonzero(moved).astype(kind)            # new places of the old rows
        by = (by & ~place) | moved.take(by & place, mode="clip")
        fresh = np.sort(symbol | new.astype(kind))
        by = _merged(by, fresh, np.searchsorted(by, fresh) + np.arange(len(fresh)))
        lcp = _merged(lcp, np.where(has_before, np.minimum(low.astype(np.int64) + 1, 255), 0), new)
        lcp[new[has_after] + 1] = np.minimum(high[has_after].astype(np.int64) + 1, 255)
        order = np.flatnonzero(more)[np.argsort(new[more])]    # by place: range minima then read the array once
        live, old, own = live[order], new[order], symbol[order]
    # the longer suffixes' places follow from the shorter ones' by the whole transform
    longer = np.empty(len(by), np.int64)
    longer[by & place] = np.arange(len(by))
    doc, length = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
    live = at = np.arange(m)
    for j in range(int(size.max(initial=0)) + 1):
        doc[at], length[at] = live, j
        more = size[live] > j
        live, at = live[more], longer[at[more]]
    return doc, length, lcp


def _range_min(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of x[lo..hi], both ends included."""
    at = np.empty(2 * len(lo), np.int64)
    at[::2], at[1::2] = lo, hi + 1
    return np.minimum.reduceat(np.append(x, x.dtype.type(255)), at)[::2] if len(lo) else x[:0]


def repeated_runs(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (body, first byte, end) of SPAN-byte strings that start earlier
    in the collection, whose bodies are in the order of their places."""
    doc, length, lcp = collection_bwt(bodies)
    same = np.cumsum(lcp < SPAN)                              # one number for equal strings
    whole = length >= SPAN
    doc, same = doc[whole], same[whole]
    start = np.array([len(x) for x in bodies], np.int64)[doc] - length[whole]
    order = np.lexsort((start, doc, same))
    doc, start, same = doc[order], start[order], same[order]
    later = np.append(False, same[1:] == same[:-1]) if len(same) else np.zeros(0, bool)
    doc, start = doc[later], start[later]
    if not len(doc):
        return doc, start, start
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)))
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], start[last] + SPAN


def may_repeat(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bodies with SPAN-byte strings whose hash stands twice, and the least
    stretch (first byte, end) of each that holds all of them. Equal strings
    have equal hashes, so no repeat stands outside."""
    size = np.array([len(x) for x in bodies], np.int64)
    t = np.frombuffer(b"".join(bodies), np.uint8).astype(np.uint64) + np.uint64(1)
    n = np.maximum(size - SPAN + 1, 0)                        # strings of each
    doc = np.repeat(np.arange(len(n)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(size) - size, n) + start
    up, down = _powers(len(t))
    s = np.zeros(len(t) + 1, np.uint64)
    np.cumsum(t * up, out=s[1:])
    h = (s[at + SPAN] - s[at]) * down[at]
    order = np.argsort(h)
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order] = same[1:] | same[:-1]
    doc, start = doc[twice], start[twice]
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else first
    return doc[first], start[first], start[last] + SPAN


def _whole_keys(rows: np.ndarray, key: np.ndarray, size: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """``rows``, sorted by key, in groups of ``limit`` bytes or a bit more;
    keys stay whole."""
    ends = np.flatnonzero(np.append(key[rows][1:] != key[rows][:-1], True)) + 1 if len(rows) else []
    total, at = np.cumsum(size[rows]), 0
    for end in ends:
        if total[end - 1] - (total[at - 1] if at else 0) < limit and end < len(rows):
            continue
        yield rows[at:end]
        at = end


def repeats(parts: DataFrame) -> DataFrame:
    """Spans (block, row, a, b) of the segments' strings that start earlier
    elsewhere."""

    def later(t: pa.Table) -> pa.Table:
        cols = [t.column(c).to_numpy() for c in ("doc_id", "row", "a", "b", "block", "key")]
        ids, row, a, b, block, key = cols
        a, b = a.copy(), b.copy()
        body, periodic = t.column("body").to_pylist(), t.column("periodic").to_pylist()
        order = np.lexsort((a, row, ids))
        seen: set[bytes] = set()
        first, out = [], []
        for i in order.tolist():
            if body[i] in seen:
                out.append((block[i], row[i], a[i], b[i]))
            else:
                seen.add(body[i])
                first.append(i)
        first = np.array(first, np.int64)
        _, which, n = np.unique(key[first], return_inverse=True, return_counts=True)
        first = first[(n[which] > 1) | np.array([periodic[i] for i in first], bool)]
        by_key = first[np.argsort(key[first], kind="stable")]
        left = []
        for i in _whole_keys(by_key, key, b - a, PIECE):
            cut, lo, hi = may_repeat([body[k] for k in i])
            for k, x, y in zip(i[cut].tolist(), lo.tolist(), hi.tolist()):
                body[k], a[k], b[k] = body[k][x:y], a[k] + x, a[k] + y
            left.append(i[cut])
        by_key = np.concatenate(left) if left else by_key
        for i in _whole_keys(by_key, key, b - a, COLLECTION):  # quickest if it fits the processor's cache
            i = i[np.lexsort((a[i], row[i], ids[i]))]
            which, start, stop = repeated_runs([body[k] for k in i])
            i = i[which]
            out += list(zip(block[i], row[i], a[i] + start, a[i] + stop))
        return pa.Table.from_arrays([pa.array([int(x[k]) for x in out], kind) for k, kind in
                                     enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                                    ["block", "row", "a", "b"])

    def run(t: pa.Table) -> pa.Table:
        return freed(later, t)

    return parts.groupBy("part").applyInArrow(run, "block int, row int, a long, b long")


def hot_repeats(parts: DataFrame) -> DataFrame:
    """As ``repeats``, string by string: no task holds a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {k: batch.column(k).to_pylist() for k in ("doc_id", "row", "a", "block", "body")}
            seen: set[bytes] = set()
            out = []
            for i in sorted(range(batch.num_rows), key=lambda i: (c["doc_id"][i], c["row"][i], c["a"][i])):
                body, d, r, a, k = c["body"][i], c["doc_id"][i], c["row"][i], c["a"][i], c["block"][i]
                run_from = None
                for p in range(len(body) - SPAN + 1):
                    s = body[p:p + SPAN]
                    if s in seen:
                        run_from = p if run_from is None else run_from
                        continue
                    seen.add(s)
                    out.append((hashlib.sha256(s).digest(), d, r, k, a + p, a + p + SPAN))
                    if run_from is not None:
                        out.append((None, d, r, k, a + run_from, a + p - 1 + SPAN))
                        run_from = None
                if run_from is not None:
                    out.append((None, d, r, k, a + run_from, a + len(body)))
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], names)
            give_back()

    names = ["string", "doc_id", "row", "block", "a", "b"]
    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    found = saved(parts.select("doc_id", "row", "a", "block", "body").mapInArrow(
        run, "string binary, doc_id long, row int, block int, a long, b long"), "hot-strings", tidy=True)
    place = F.struct("doc_id", "row", "a")
    strings = found.where("string is not null")
    first = strings.groupBy("string").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    # a string has a row a batch here, however often it stands
    later = strings.join(first, "string").where(place != F.col("first"))
    return found.where("string is null").unionByName(later.select(*found.columns)).select("block", "row", "a", "b")


def _dealt(docs: DataFrame, text: str, doc_id: str, size: int) -> DataFrame:
    n = max(1, math.ceil(size / BLOCK))
    return docs.withColumn("block", F.pmod(F.xxhash64(doc_id), F.lit(n)).cast("int"))


def spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``docs`` as (block, doc_id, text), and the spans (block, row, a, b) of
    repeated strings; they may overlap."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = total_bytes(docs)
    bits = _range_bits(size)
    docs = _dealt(docs, "text", "doc_id", size)
    parts = saved(segments(docs, repeated_keys(docs, bits), bits, 1 << (bits + 3)), "segments", tidy=True)
    whole = parts.where("body is null").select("block", "row", "a", "b")
    parts = parts.where("body is not null")
    # few: one for HOT bytes of segments at most
    hot = saved(parts.groupBy("key").agg(F.sum(F.octet_length("body")).alias("bytes")).where(F.col("bytes") > HOT)
                .select("key"), "hot-keys")
    found = whole.unionByName(repeats(parts.join(F.broadcast(hot), "key", "left_anti")))
    if not hot.isEmpty():
        found = found.unionByName(hot_repeats(parts.join(F.broadcast(hot), "key", "left_semi")))
    return docs, saved(found, "spans", tidy=True)


def _joined(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    cut = np.append(True, a[1:] > b[:-1])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(a)) - 1
    return list(zip(a[first].tolist(), b[last].tolist()))


def _cuts(left: pa.Table, right: pa.Table):
    """(row of ``left``, text, its maximal spans), in the order of the block."""
    order, texts, _ = _ordered(left)
    row = right.column("row").to_numpy()
    by = np.argsort(row, kind="stable")
    row, a, b = row[by], right.column("a").to_numpy()[by], right.column("b").to_numpy()[by]
    ends = np.searchsorted(row, np.arange(len(texts) + 1))
    for r, t in enumerate(texts):
        lo, hi = ends[r], ends[r + 1]
        yield order[r], t, _joined(a[lo:hi], b[lo:hi]) if hi > lo else []


def _kept(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in gone:
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return b"".join(out)


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    dealt, gone = spans(docs, text, doc_id)

    def of_block(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("doc_id").to_pylist()
        out = [(ids[i], len(t), sum(b - a for a, b in cut), len(cut), hashlib.sha256(_kept(t, cut)).hexdigest())
               for i, t, cut in _cuts(left, right)]
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.Table.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)],
                                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return freed(of_block, left, right)

    return dealt.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``. A character
    that loses some of its bytes is lost whole; null stays null."""
    _, gone = spans(docs, text, doc_id)
    names = docs.columns
    # positions, not names: other columns may be called like ours
    inner = docs.toDF(*[{text: "text", doc_id: "doc_id"}.get(c, f"c{i}") for i, c in enumerate(names)])
    dealt = _dealt(inner, "text", "doc_id", total_bytes(inner))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in inner.schema])

    def without(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = left.column("text").to_pylist()
        for i, t, cut in _cuts(left, right):
            if cut:
                texts[i] = _kept(t, cut).decode("utf-8", "ignore")
        at = left.column_names.index("text")
        return left.set_column(at, "text", pa.array(texts, pa.string())).select(schema.names)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return freed(without, left, right)

    return dealt.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(run, schema).toDF(*names)
