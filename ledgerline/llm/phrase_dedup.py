"""Repeated phrases, found by sharded Aho-Corasick automata.

Words stand between ASCII white space and are compared unchanged. A window
is ``window`` consecutive words of one text. A window whose word sequence
also starts anywhere else, in the same text or another, is recurring, and
every word that a recurring window covers is removed: no copy stays.
Windows are judged on the input, not on what is left.

1. ``texts``: equal texts are one row with its number of copies.
2. ``anchors``: of the grams of G words in a window (G: the largest power
   of two up to half a window) the one with the least hash is its anchor,
   the leftmost of equal ones. Equal windows have equal anchors at equal
   places, so a window can only recur if its anchor occurs twice; anchors
   are counted by hash with partial sums, so a frequent one is no group.
3. ``segments``: the windows of one anchor occurrence are neighbours; the
   words they cover travel, once a text block, to the shard of the anchor.
   An anchor with over ``HOT`` places is dealt window by window instead (by
   a hash of the window), so no anchor is one task.
4. In a shard, windows are counted by their exact words; the longest runs
   of recurring windows of each segment are the confirmed phrases. They
   are compiled into one automaton (pyahocorasick, over numbers of the
   shard's words), and all segments of all texts stream through it, which
   locates every occurrence of every phrase.
5. Occurrences come back to their text as word ranges.

A shard holds about ``SHARD_WORDS`` words of segments; their number grows
with the data. Hashes only route and preselect: what is removed is decided
on words.

Null text is empty, as is one without a word; both are kept as they are
(no words, nothing removed). Rows may share an id or have none: results
follow the row's own text, and equal texts in two rows are two places. Very
long texts are taken in pieces of ``PIECE`` bytes. Extra columns are kept
by ``remove``; one that has the name of an added column is an error. An
empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import give_back, saved, text_blocks

WINDOW = 35
#: Text bytes whose words are held at once.
PIECE = 2 << 20
#: Words of segments in a shard, on average.
SHARD_WORDS = 400_000
#: Places of an anchor above which its windows are dealt one by one.
HOT = 4096
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def gram_of(window: int) -> int:
    return 1 << max(0, (window // 2).bit_length() - 1)


def word_pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in pieces (``bytes.split`` parts at ASCII white space)."""
    at = 0
    while at < len(data):
        gap = _SPACE.search(data, at + PIECE)
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end


# ---------------------------------------------------------------- anchors ---

def anchor_runs(hashes: np.ndarray, sizes: list[int], window: int) -> tuple[np.ndarray, ...]:
    """``hashes`` of the words of several runs of ``sizes`` words, one after
    the other. Per anchor occurrence: its hash, its run, the first window
    that it is the anchor of (from the run's start) and how many are."""
    gram = gram_of(window)
    g, width = hashes, 1
    with np.errstate(over="ignore"):
        while width < gram:                                   # hash of 2, 4, 8 ... words
            g = g[:-width] * np.uint64(0x9E3779B97F4A7C15) + g[width:]
            g ^= g >> np.uint64(29)
            g *= np.uint64(0xBF58476D1CE4E5B9)
            g ^= g >> np.uint64(32)
            width *= 2
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return np.zeros(0, np.uint64), none, none, none
    order = np.argsort(g, kind="stable")
    least = np.empty(len(g), np.int32)
    least[order] = np.arange(len(g), dtype=np.int32)
    want, width = window - gram + 1, 1
    while width * 2 <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[:width - want], least[want - width:])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    run = np.repeat(np.arange(len(sizes)), sizes)[:len(least)]
    at = np.arange(len(least))
    ok = at + window <= ends[run]
    at, run, anchor = at[ok], run[ok], order[least[ok]]
    if not len(at):
        return np.zeros(0, np.uint64), none, none, none
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (run[1:] != run[:-1])
    first = np.flatnonzero(new)
    return g[anchor[first]], run[first], at[first] - starts[run[first]], np.diff(np.append(first, len(at)))


def _anchor_batches(batches, window: int):
    """(key, tid, first, n, weight) of every anchor occurrence."""
    hashed = xxhash.xxh3_64_intdigest
    for part, texts in text_blocks(batches, limit=PIECE):
        tids, copies = part.column("tid").to_pylist(), part.column("copies").to_pylist()
        arrays, sizes, of = [], [], []
        for tid, n, text in zip(tids, copies, texts):
            tail, base = np.zeros(0, np.uint64), 0
            for words in word_pieces(text.encode("utf-8")):
                h = np.concatenate([tail, np.fromiter(map(hashed, words), np.uint64, len(words))])
                if len(h) >= window:
                    arrays.append(h)
                    sizes.append(len(h))
                    of.append((tid, base, min(n, 2)))
                    base += len(h) - window + 1
                    tail = h[len(h) - window + 1:]
                else:
                    tail = h
        if not arrays:
            continue
        key, run, first, n = anchor_runs(np.concatenate(arrays), sizes, window)
        tid, base, weight = (np.array(c, np.int64)[run] for c in zip(*of))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(tid), pa.array(first + base), pa.array(n.astype(np.int32)),
             pa.array(weight)], names=["key", "tid", "first", "n", "weight"])


def texts_of(docs: DataFrame) -> DataFrame:
    """Distinct texts with a number and how many rows have them (a written table)."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select(text).groupBy("text").agg(F.count("*").alias("copies"))
    return saved(rows.withColumn("tid", F.monotonically_increasing_id()), "phrase-texts")


# --------------------------------------------------------------- segments ---

def _segment_batches(batches, window: int, shards: int):
    """The words around recurring anchors: shard, words joined by blanks, and
    places (text, first word, weight) of equal segments as packed longs."""
    digest = xxhash.xxh3_64_intdigest
    for part, texts in text_blocks(batches, limit=PIECE):
        found: dict[tuple[int, bytes], list[int]] = {}
        for tid, n, text, at in zip(part.column("tid").to_pylist(), part.column("copies").to_pylist(), texts,
                                    part.column("places").to_pylist()):
            weight, base, tail, i = min(n, 2), 0, [], 0
            at.sort(key=lambda p: p["first"])
            for words in word_pieces(text.encode("utf-8")):
                words = tail + words
                while i < len(at) and at[i]["first"] + at[i]["n"] + window - 1 <= base + len(words):
                    p, i = at[i], i + 1
                    first = p["first"] - base
                    if p["hot"]:
                        for k in range(first, first + p["n"]):
                            seg = b" ".join(words[k:k + window])
                            found.setdefault((digest(seg) % shards, seg), []).extend((tid, base + k, weight))
                    else:
                        seg = b" ".join(words[first:first + p["n"] + window - 1])
                        found.setdefault((p["key"] % shards, seg), []).extend((tid, p["first"], weight))
                keep = max(0, len(words) - 2 * window)        # a segment is shorter than two windows
                tail, base = words[keep:], base + keep
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.binary()),
                 pa.array([np.array(v, np.int64).tobytes() for v in found.values()], pa.binary())],
                names=["shard", "words", "places"])


# ------------------------------------------------------------------ shard ---

def phrases_of(segments: list[str], weights: list[int], window: int) -> set[str]:
    """The longest runs of recurring windows of each segment (a word is one
    character). ``weights``: in how many places a segment stands."""
    seen: dict[str, int] = {}
    for s, w in zip(segments, weights):
        for k in range(len(s) - window + 1):
            x = s[k:k + window]
            seen[x] = seen.get(x, 0) + w
    out = set()
    for s in segments:
        start = None
        for k in range(len(s) - window + 2):
            if k <= len(s) - window and seen[s[k:k + window]] > 1:
                start = k if start is None else start
            elif start is not None:
                out.add(s[start:k + window - 1])
                start = None
    return out


def automaton_of(phrases: set[str]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for p in phrases:
        machine.add_word(p, len(p))
    machine.make_automaton()
    return machine


def covered(machine: ahocorasick.Automaton, text: str) -> list[tuple[int, int]]:
    """Ranges of ``text`` that occurrences of phrases cover, joined where they touch."""
    out: list[list[int]] = []
    for end, size in machine.iter(text):
        lo, hi = end - size + 1, end + 1
        while out and lo <= out[-1][1]:
            prev = out.pop()
            lo, hi = min(lo, prev[0]), max(hi, prev[1])
        out.append([lo, hi])
    return [(a, b) for a, b in out]


class _Letters(dict):
    """A character for each word, in the order they come (no surrogates)."""

    def __missing__(self, word):
        n = len(self) + 1
        self[word] = c = chr(n if n < 0xD800 else n + 0x800)
        return c


def _shard(window: int):
    def work(table: pa.Table) -> pa.Table:
        letter = _Letters()
        segments = ["".join(map(letter.__getitem__, w.split(b" "))) for w in table.column("words").to_pylist()]
        places = [np.frombuffer(p, np.int64).reshape(-1, 3) for p in table.column("places").to_pylist()]
        total: dict[str, int] = {}
        for s, p in zip(segments, places):
            total[s] = total.get(s, 0) + int(p[:, 2].sum())
        phrases = phrases_of(list(total), list(total.values()), window)
        tids, first, last = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if phrases:
            machine = automaton_of(phrases)
            for s, p in zip(segments, places):
                for a, b in covered(machine, s):
                    tids.append(p[:, 0])
                    first.append(p[:, 1] + a)
                    last.append(p[:, 1] + b)
        out = pa.table({"tid": np.concatenate(tids), "start": np.concatenate(first), "stop": np.concatenate(last)})
        del segments, places, total, phrases, letter
        give_back()
        return out

    return work


def ranges(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Word ranges (tid, start, stop) of ``texts`` covered by recurring
    windows; ranges of one text may touch or overlap."""
    anchors = saved(texts.mapInArrow(lambda b: _anchor_batches(b, window),
                                     "key long, tid long, first long, n int, weight long"), "phrase-anchors")
    # a written table: a join of two plain exchanges is what Spark can split at a frequent anchor
    known = saved(anchors.groupBy("key").agg(F.sum("weight").alias("_w"), F.count("*").alias("_n")).where("_w > 1")
                  .select("key", (F.col("_n") > HOT).alias("hot")), "phrase-known")
    places = saved(anchors.select("key", "tid", "first", "n").join(known, "key"), "phrase-places")
    words = places.agg(F.sum(F.when(F.col("hot"), F.col("n") * window).otherwise(F.col("n") + window - 1))).first()[0]
    shards = max(1, -(-int(words or 0) // SHARD_WORDS))
    by_text = places.groupBy("tid").agg(F.collect_list(F.struct("first", "n", "key", "hot")).alias("places"))
    segments = texts.join(by_text, "tid").mapInArrow(lambda b: _segment_batches(b, window, shards),
                                                     "shard int, words binary, places binary")
    return segments.groupBy("shard").applyInArrow(_shard(window), "tid long, start long, stop long")


# -------------------------------------------------------------------- cut ---

def _cut_batches(batches):
    for part, texts in text_blocks(batches, limit=PIECE):
        rows = []
        for text, spans in zip(texts, part.column("spans").to_pylist()):
            joined: list[list[int]] = []
            for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            kept, n = [], 0
            for words in word_pieces(text.encode("utf-8")):
                mask = bytearray(b"\x01") * len(words)
                for a, b in joined:
                    lo, hi = max(a - n, 0), min(b - n, len(words))
                    if lo < hi:
                        mask[lo:hi] = bytes(hi - lo)
                n += len(words)
                some = b" ".join(compress(words, mask))
                if some:
                    kept.append(some)
            rows.append((n, sum(b - a for a, b in joined), [{"start": a, "stop": b} for a, b in joined],
                         b" ".join(kept).decode("utf-8")))
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        made = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), span, pa.string()))]
        yield pa.RecordBatch.from_arrays([part.column("digest"), *made],
                                         names=["digest", "n_words", "n_removed", "spans", "kept"])


def _digest(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def cut(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per distinct text: digest (SHA-256), n_words, n_removed, spans (word
    ranges, joined) and kept (the other words, joined by one space)."""
    if window < 2:
        raise ValueError("a window has two words or more")
    texts = texts_of(docs)
    found = saved(ranges(texts, window).distinct(), "phrase-ranges")
    spans = found.groupBy("tid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rows = texts.join(spans, "tid", "left").select("text", "spans", _digest(F.col("text")).alias("digest"))
    kind = "array<struct<start:bigint,stop:bigint>>"
    return rows.mapInArrow(_cut_batches, f"digest binary, n_words long, n_removed long, spans {kind}, kept string")


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_removed, spans and kept added."""
    added = ("n_words", "n_removed", "spans", "kept")
    clash = [c for c in docs.columns if c.lower() in (*added, "digest", "_digest")]
    if clash:
        raise ValueError(f"rename these columns first: {clash}")
    out = cut(docs, window)
    rows = docs.withColumn("_digest", _digest(F.col("text")))
    return rows.join(out, F.col("_digest") == F.col("digest")).select(*docs.columns, *added)


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words."""
    out = cut(docs, window).select("digest", "n_words", "n_removed",
                                   F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    rows = docs.select("doc_id", _digest(F.col("text")).alias("_digest"))
    return rows.join(out, F.col("_digest") == F.col("digest")).drop("_digest", "digest")
