"""Benchmark decontamination: BM25 search with block-max WAND, then a check
of question and answer.

The test items are the indexed side: an inverted index of their terms, in
blocks of ``ITEMS_A_BLOCK`` items, with the largest impact of each term in
each block. Impacts are BM25 weights divided by the item's score for its own
text, so a score of 1 means that a passage holds the whole item. Every
training text is cut into passages that overlap by half and are twice as
long as the longest item, so that each copy of an item lies whole in one.

A passage is a query. The sums of block maxima leave few pairs of passage
and block; in these, document-at-a-time WAND moves the posting lists
from pivot to pivot and returns all items at or above ``THRESHOLD``. A hit
stands when the passage holds at least ``SHARED`` of the item's word
``SHINGLE``-grams, and of its question's (first three quarters) and its
answer's (the rest) 3-grams ``PART``.

Document frequencies, the number of items, their mean and greatest length
are taken over all items, so a score doesn't depend on the shard of an item.
Shards are runs of items with ``SHARD_BYTES`` bytes of words (one item more
at most); a task builds the index of each. An index is broadcast and makes a
pass over the texts, which are never shuffled. The bounds of a long text's
passages are held for ``CELLS`` pairs of passage and block at a time.

Words are lower-cased and stripped of all but letters and digits. Null or
empty texts and items match nothing; an item of fewer words than a shingle
is one shingle. Repeated items or rows each give their rows; ties don't
matter, as all hits are kept. Extra columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import saved, text_blocks

THRESHOLD = 0.6
SHINGLE, SHARED, PART = 5, 0.75, 0.5
ITEMS_A_BLOCK = 4
#: Bytes of the words of one broadcast index; more items make more passes.
SHARD_BYTES = 8 << 20
#: Pairs of passage and block whose bounds are held at once.
CELLS = 1 << 22
K1, B = 1.2, 0.75
BLOCK = 8 << 20
NOT_WORD = re.compile(r"[\W_]+")


def words_of(text: str) -> list[str]:
    return [w for w in (NOT_WORD.sub("", x) for x in text.lower().split()) if w]


def shingles(words: list, n: int) -> set:
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def held(part: set, whole: set) -> float:
    return len(part & whole) / len(part) if part else 1.0


@dataclass(frozen=True)
class Lengths:
    """Number of items, their mean and greatest number of words."""

    n: int
    mean: float
    longest: int


class ItemIndex:
    """Inverted index of items (id, words) with list and block maxima of the
    impacts. ``df`` and ``lengths`` are those of all items, where these are
    a part of them."""

    def __init__(self, items: list[tuple[int, list[str]]], per_block: int = ITEMS_A_BLOCK,
                 df: dict[str, int] | None = None, lengths: Lengths | None = None):
        items = [(i, w) for i, w in items if w]
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        own = Counter(w for ws in self.words for w in set(ws))
        df = own if df is None else {w: df[w] for w in own}
        sizes = [len(ws) for ws in self.words]
        lengths = lengths or Lengths(len(items), sum(sizes) / max(len(items), 1), max(sizes, default=0))
        n, mean, self.longest = lengths.n, lengths.mean, lengths.longest
        self.term = {w: k for k, w in enumerate(sorted(df))}
        idf = {w: float(np.log(1 + (n - d + 0.5) / (d + 0.5))) for w, d in df.items()}
        self.postings: list[list[tuple[int, float]]] = [[] for _ in df]
        for i, ws in enumerate(self.words):
            norm = K1 * (1 - B + B * len(ws) / mean)
            raw = {w: idf[w] * tf * (K1 + 1) / (tf + norm) for w, tf in Counter(ws).items()}
            whole = sum(raw.values())
            for w, x in raw.items():
                self.postings[self.term[w]].append((i, x / whole))
        self.per_block = per_block
        self.n_blocks = -(-len(items) // per_block)
        self.top = np.array([max(x for _, x in p) for p in self.postings])          # list maxima
        self.block_top: list[dict[int, float]] = []
        for p in self.postings:
            best: dict[int, float] = {}
            for i, x in p:
                best[i // per_block] = max(best.get(i // per_block, 0.0), x)
            self.block_top.append(best)
        # terms of more than a quarter of the blocks have a row of bounds each
        self.common = np.array([len(b) * 4 > self.n_blocks and self.n_blocks > 4 for b in self.block_top], bool)
        self.row = np.cumsum(self.common) - 1
        self.dense = np.zeros((int(self.common.sum()) + 1, self.n_blocks))
        for t in np.flatnonzero(self.common):
            self.dense[self.row[t], list(self.block_top[t])] = list(self.block_top[t].values())
        size = [0 if c else len(b) for b, c in zip(self.block_top, self.common)]
        self.at = np.cumsum([0, *size])
        rare = [b for b, c in zip(self.block_top, self.common) if not c]
        self.rare_block = np.array([k for b in rare for k in b], np.int64)
        self.rare_top = np.array([x for b in rare for x in b.values()])
        self.block_postings: list[dict[int, list[tuple[int, float]]]] = []
        for p in self.postings:
            cut: dict[int, list[tuple[int, float]]] = {}
            for i, x in p:
                cut.setdefault(i // per_block, []).append((i, x))
            self.block_postings.append(cut)

    def candidates(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of passage and block whose bound reaches the threshold, of
        distinct pairs of passage and term, ordered by passage."""
        if not len(passage):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        own, at = np.unique(passage, return_inverse=True)
        bound = np.zeros((len(own), self.n_blocks))
        c = self.common[term]
        if c.any():
            here = at[c]
            first = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
            bound[here[first]] = np.add.reduceat(self.dense[self.row[term[c]]], first, axis=0)
        p, t = at[~c], term[~c]
        n = self.at[t + 1] - self.at[t]
        if n.sum():
            post = np.arange(int(n.sum())) + np.repeat(self.at[t] - (np.cumsum(n) - n), n)
            bound += np.bincount(np.repeat(p, n) * self.n_blocks + self.rare_block[post], self.rare_top[post],
                                 bound.size).reshape(bound.shape)
        p, b = np.nonzero(bound >= threshold - 1e-9)
        return own[p], b

    def wand(self, terms: list[int], blocks: list[int], threshold: float) -> list[tuple[int, float]]:
        """Items of ``blocks`` with a score of ``threshold`` or more."""
        out = []
        for block in blocks:
            lists = [[0, self.block_postings[t][block], self.block_top[t][block]]
                     for t in terms if block in self.block_top[t]]
            while lists:
                lists.sort(key=lambda x: x[1][x[0]][0])
                bound, pivot = 0.0, None
                for k, (_, _, top) in enumerate(lists):
                    bound += top
                    if bound >= threshold - 1e-9:
                        pivot = lists[k][1][lists[k][0]][0]
                        break
                if pivot is None:
                    break
                if lists[0][1][lists[0][0]][0] == pivot:      # all lists before stand at the pivot: score it
                    s = 0.0
                    for x in lists:
                        if x[1][x[0]][0] == pivot:
                            s += x[1][x[0]][1]
                            x[0] += 1
                    if s >= threshold - 1e-9:
                        out.append((pivot, s))
                else:                                         # bring the lists before up to it
                    for x in lists[:k]:
                        while x[0] < len(x[1]) and x[1][x[0]][0] < pivot:
                            x[0] += 1
                lists = [x for x in lists if x[0] < len(x[1])]
        return out

    def verify(self, item: int, passage: list[str]) -> tuple[float, float, float]:
        """Shares of the item, its question and its answer that the passage holds."""
        ws = self.words[item]
        cut = max(1, len(ws) * 3 // 4) if len(ws) > 1 else 1
        tri = shingles(passage, 3)
        own = shingles(passage, min(SHINGLE, len(ws)))
        part = lambda x: held(shingles(x, 3), tri if len(x) >= 3 else shingles(passage, len(x)))
        return held(shingles(ws, SHINGLE), own), part(ws[:cut]), part(ws[cut:]) if ws[cut:] else 1.0

    def search(self, texts: list[str], threshold: float = THRESHOLD) -> list[tuple[int, int, int, float, float, float, float]]:
        """(text, item, first word of the passage, score, shares of item,
        question and answer) of all verified hits, the best passage of each
        text and item."""
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        split = [np.array([number[w] for w in t.lower().split()], np.int64) for t in texts]
        plain = [NOT_WORD.sub("", w) if not w.isalpha() else w for w in number]
        term = np.array([self.term.get(w, -1) if w else -2 for w in plain], np.int64)
        long, step = 2 * self.longest, max(1, self.longest)
        found: dict[tuple[int, int], tuple] = {}
        for d, s in enumerate(split):
            t = term[s] if len(s) else s
            if len(t) and (t == -2).any():
                s, t = s[t != -2], t[t != -2]
            split[d] = s
            if not (t >= 0).any():
                continue
            n_pass = max(1, -(-(len(t) - long) // step) + 1) if len(t) > long else 1
            pos = np.flatnonzero(t >= 0)
            last = np.minimum(pos // step, n_pass - 1)
            two = (last >= 1) & (pos - (last - 1) * step < long)
            key = np.unique(np.concatenate((last * len(self.top) + t[pos],
                                            (last[two] - 1) * len(self.top) + t[pos[two]])))
            passage, terms = key // len(self.top), key % len(self.top)
            by: dict[int, list[int]] = {}
            held_at_once = max(1, CELLS // max(self.n_blocks, 1))
            edges = np.searchsorted(passage, np.arange(0, n_pass + held_at_once, held_at_once))
            for a, z in zip(edges[:-1], edges[1:]):
                for p, b in zip(*(x.tolist() for x in self.candidates(passage[a:z], terms[a:z], threshold))):
                    by.setdefault(p, []).append(b)
            for p, blocks in by.items():
                own = terms[np.searchsorted(passage, p):np.searchsorted(passage, p, "right")].tolist()
                ws = None
                for item, score in self.wand(own, blocks, threshold):
                    ws = ws or [plain[k] for k in s[p * step:p * step + long].tolist()]
                    whole, question, answer = self.verify(item, ws)
                    if whole >= SHARED and question >= PART and answer >= PART:
                        key2, new = (d, item), (whole, score, -p, question, answer)
                        if key2 not in found or new > found[key2]:
                            found[key2] = new
        return [(d, self.ids[i], -p * step, s, w, q, a) for (d, i), (w, s, p, q, a) in sorted(found.items())]


HITS = ("doc_id long, item_id long, first_word long, score double, item_overlap double, "
        "question_overlap double, answer_overlap double")


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``rid``, ``pid``, ``item_id`` and ``words`` of every item with a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "text", BLOCK):
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id"), pa.array([words_of(t) for t in texts], pa.list_(pa.string()))],
                ["item_id", "words"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")) \
        .mapInArrow(run, "item_id long, words array<string>").where("size(words) > 0")
    return saved(rows.select(F.monotonically_increasing_id().alias("rid"), F.spark_partition_id().alias("pid"), "*"),
                 "items")


def shards(items: DataFrame, item_id: str = "item_id", text: str = "text",
           limit: int = SHARD_BYTES) -> Iterator[ItemIndex]:
    """The indexes of runs of items with ``limit`` bytes of words, one after
    the other; statistics are those of all items."""
    spark = items.sparkSession
    rows = item_words(items, item_id, text).withColumn("size", F.octet_length(F.array_join("words", " ")).cast("long"))
    parts = rows.groupBy("pid").agg(F.sum("size").alias("size"), F.count("*").alias("n"),
                                    F.sum(F.size("words")).alias("words"), F.max(F.size("words")).alias("longest"))
    parts = sorted(parts.collect())                           # a row a partition of the items
    if not parts:
        return
    n, words = sum(r.n for r in parts), sum(r.words for r in parts)
    lengths = Lengths(n, words / n, max(r.longest for r in parts))
    starts, total = [], 0
    for r in parts:
        starts.append((r.pid, total))
        total += r.size
    before = Window.partitionBy("pid").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    dealt = rows.join(F.broadcast(spark.createDataFrame(starts, "pid int, start long")), "pid").select(
        F.floor((F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0))) / limit).alias("shard"),
        "rid", "item_id", "words")
    df = rows.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    known = dealt.select(F.col("shard").alias("of"), F.explode("words").alias("word")).distinct().join(df, "word")

    def build(items: pa.Table, known: pa.Table) -> pa.Table:
        items = items.sort_by("rid")
        own = dict(zip(known.column("word").to_pylist(), known.column("df").to_pylist()))
        index = ItemIndex(list(zip(items.column("item_id").to_pylist(), items.column("words").to_pylist())),
                          df=own, lengths=lengths)
        return pa.table({"shard": items.column("shard")[:1], "body": pa.array([pickle.dumps(index)], pa.binary())})

    built = saved(dealt.groupBy("shard").cogroup(known.groupBy("of")).applyInArrow(
        build, "shard long, body binary"), "index")
    for k in range(total // limit + 1):
        found = built.where(F.col("shard") == k).first()      # none: a long item covers this run
        if found is not None:
            yield pickle.loads(bytes(found.body))


def hits(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
         threshold: float = THRESHOLD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``docs`` and item that it holds."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = None
    for shard in shards(items, limit=shard_bytes):
        index = spark.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            own = index.value
            for part, texts in text_blocks(batches, "text", BLOCK):
                ids = part.column("doc_id").to_pylist()
                got = [(ids[d], *rest) for d, *rest in own.search(texts, threshold)]
                cols = list(zip(*got)) if got else [()] * 7
                kinds = [pa.int64()] * 3 + [pa.float64()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 [c.split()[0] for c in HITS.split(", ")])

        found = rows.mapInArrow(run, HITS)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], HITS)
