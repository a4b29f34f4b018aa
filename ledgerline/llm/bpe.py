"""Byte-level BPE: encode whole texts with a given rank file, and decode.

Encoding replays the merges over a block of documents as one corpus: the
distinct words of the block stand behind each other in flat arrays of token
ids with links to the neighbours, and an inverted index holds, for every
rank, the positions of the pairs that merge into it. The lowest rank is
applied first, at all its positions from left to right; a merge looks only
at the two pairs it makes anew and enters them into the index. A block is
``BLOCK`` bytes of text, so memory is bounded and no row crosses a shuffle;
a lost task is simply run again.

Null or empty text: no ids, empty bytes. Rows (repeated ones too) and extra
columns are kept as they are.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerline.llm.common import text_blocks

# Unicode White_Space, which is what \s means in the split pattern.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of non-space with the space before it, or white space: no match of
#: the split pattern reaches over the ends of one of these.
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Text bytes of a block: the more, the fewer words are encoded twice, and the more memory.
BLOCK = 4 << 20
NONE = 1 << 40
#: Places whose pairs are looked up at once at first.
SLICE = 1 << 18


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 token and rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _pairs(ranks: dict[bytes, int]) -> Iterator[tuple[int, int]]:
    for t, r in ranks.items():
        for i in range(1, len(t)):
            a, b = ranks.get(t[:i]), ranks.get(t[i:])
            if a is not None and b is not None:
                yield a << 32 | b, r


class MergeReplay:
    """Merges of one rank table, applied to many words at once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.token: list[bytes] = [b""] * (1 + max(ranks.values()))
        for t, r in ranks.items():
            self.token[r] = t
        inner = regex.sub(r"\\s(?=[^\]]*\])", lambda _: SPACE, pattern)       # \s inside [...]
        self.word = regex.compile(inner.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        #: every way to make a token of two tokens: key of the pair, sorted, and the rank
        pairs = np.fromiter(_pairs(ranks), np.dtype([("key", np.int64), ("rank", np.int64)]))
        pairs.sort(order="key")
        self.keys = np.append(pairs["key"], np.iinfo(np.int64).max)
        self.made = np.append(pairs["rank"], NONE)

    @property
    def ranks(self) -> dict[bytes, int]:
        return {t: r for r, t in enumerate(self.token) if t}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it merges into no token."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], NONE)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of (distinct, non-empty) words: all ids behind each
        other, and where each word's ids end."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        n = len(flat)
        word = np.repeat(np.arange(len(words)), sizes)
        sym = np.append(self.byte[flat], -1)                  # the last place stands for "no neighbour"
        nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
        nxt[ends - 1], nxt[n] = n, n
        prv[ends - sizes], prv[n] = n, n
        #: the inverted index: rank of a pair -> places of its left token
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(rank: np.ndarray, place: np.ndarray) -> None:
            order = np.argsort(rank, kind="stable")
            rank, place = rank[order], place[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for r, a, b in zip(rank[starts].tolist(), starts, [*starts[1:], len(rank)]):
                if r in index:
                    index[r].append(place[a:b])
                else:
                    index[r] = [place[a:b]]
                    heapq.heappush(heap, r)

        for a in range(0, n, SLICE):                          # the search takes several times its input
            first = np.flatnonzero(nxt[a:min(a + SLICE, n)] < n) + a
            rank = self.rank_of(sym[first], sym[first + 1])
            if (some := rank < NONE).any():
                enter(rank[some], first[some])
        while heap:
            r = heapq.heappop(heap)
            found = index.pop(r)
            at = np.sort(np.concatenate(found))
            at = at[np.append(True, at[1:] != at[:-1])]
            right = nxt[at]
            at = at[self.rank_of(sym[at], sym[right]) == r]   # others lost a token to an earlier merge
            if not len(at):
                continue
            if len(at) > 1:
                at = self._together(at, r, sym, nxt, prv, word, enter)
            right = nxt[at]
            after = nxt[right]
            sym[at], sym[right] = r, -1
            nxt[at], prv[after] = after, at
            before = prv[at]
            place = np.concatenate((at, before))
            rank = self.rank_of(np.concatenate((sym[at], sym[before])), np.concatenate((sym[after], sym[at])))
            if (some := rank < NONE).any():
                enter(rank[some], place[some])
        alive = sym[:n] >= 0
        return sym[:n][alive], np.cumsum(alive)[ends - 1]

    def _together(self, at, r, sym, nxt, prv, word, enter) -> np.ndarray:
        """Those of the places ``at`` of rank ``r`` that can be merged at
        once with the result of merging from left to right; the rest is
        entered again."""
        right = nxt[at]
        k = np.arange(len(at))
        joined = np.zeros(len(at), bool)
        joined[1:] = right[:-1] == at[1:]                     # shares a token with the place before
        kept = (k - np.maximum.accumulate(np.where(joined, 0, k))) % 2 == 0
        at, right = at[kept], right[kept]
        same = word[at[1:]] == word[at[:-1]]
        if same.any():
            before, after = prv[at], nxt[right]
            left = sym[before]
            left[1:] = np.where(before[1:] == right[:-1], r, left[1:])
            low = (self.rank_of(left, np.full(len(at), r)) < r) | (self.rank_of(np.full(len(at), r), sym[after]) < r)
            if low.any():                                     # in these words a lower rank comes between
                later = np.append(False, same) & np.isin(word[at], word[at[low]])
                if later.any():
                    enter(np.full(int(later.sum()), r), at[later])
                    at = at[~later]
        return at

    def decode(self, ids) -> bytes:
        return b"".join([self.token[i] for i in ids])

    def split(self, chunk: str) -> list[str]:
        """Words of a chunk; the usual ones (letters, letters and a mark)
        need no pattern."""
        letters = chunk[1:] if chunk[0] == " " else chunk
        if letters.isalpha():
            return [chunk]
        if chunk[-1] in ".,;:!?" and letters[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.word.findall(chunk)

    def block(self, texts: list[str]) -> "Block":
        """The texts as token ids, by distinct chunk."""
        gc.disable()                                          # many small objects and no cycle
        try:
            return self._block(texts)
        finally:
            gc.enable()

    def _block(self, texts: list[str]) -> "Block":
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        split = [np.array([number[c] for c in CHUNK.findall(t)], np.int32) for t in texts]
        parts = [self.split(c) for c in number]
        del number
        words: defaultdict[str, int] = defaultdict()
        words.default_factory = words.__len__
        of = np.array([words[w] for p in parts for w in p], np.int64)
        count = np.fromiter(map(len, parts), np.int64, len(parts))
        del parts
        if not len(of):
            return Block(split, np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        ids, ends = self.encode_words([w.encode() for w in words])
        size = np.diff(ends, prepend=0)
        own = size[of]
        return Block(split, ids.astype(np.int32)[ranges((ends - size)[of], own)],
                     *_runs(np.add.reduceat(own, np.cumsum(count) - count)))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges (start, size) behind each other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _runs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(sizes) - sizes, sizes


@dataclass
class Block:
    """Texts of one block: the chunks of each, all chunks' ids behind each
    other, and where a chunk's ids begin and how many they are."""

    split: list[np.ndarray]
    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    def of(self, text: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.start[text], self.size[text])]

    def ids(self) -> Iterator[list[int]]:
        for cs in self.split:
            yield self.of(cs).tolist()

    def arrow(self) -> pa.Array:
        """The ids of all texts as one list column."""
        own = [self.of(cs) for cs in self.split]
        ends = np.cumsum([0, *map(len, own)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(own), pa.int32()))

    def of_chunks(self) -> Iterator[list[int]]:
        """The ids of each chunk."""
        ids = self.flat.tolist()
        for a, n in zip(self.start.tolist(), self.size.tolist()):
            yield ids[a:a + n]


@lru_cache(maxsize=2)
def replay_of(path: str, pattern: str) -> MergeReplay:
    """One table a worker."""
    return MergeReplay(load_ranks(path), pattern)


def _with(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    taken = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema if f.name.lower() not in taken] + list(fields))


def _columns(part: pa.RecordBatch, names: list[str], more: list[pa.Array], all_names: list[str]):
    return pa.RecordBatch.from_arrays([part.column(n) for n in names] + more, all_names)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with an array column ``out`` of token ids."""
    schema = _with(docs.schema, T.StructField(out, T.ArrayType(T.IntegerType())))
    keep, names = schema.names[:-1], schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = replay_of(path, pattern)
        for part, texts in text_blocks(batches, text, BLOCK):
            yield _columns(part, keep, [model.block(texts).arrow()], names)

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with a binary column ``out``: the bytes of the ids (null: empty)."""
    schema = _with(docs.schema, T.StructField(out, T.BinaryType()))
    keep, names = schema.names[:-1], schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = replay_of(path, pattern)
        for b in batches:
            back = [model.decode(x or ()) for x in b.column(ids).to_pylist()]
            yield _columns(b, keep, [pa.array(back, pa.binary())], names)

    return docs.mapInArrow(run, schema)


def _digests(model: MergeReplay, texts: list[str], with_ids: bool) -> list[pa.Array]:
    """The columns that ``digests`` adds, of one block."""
    block = model.block(texts)

    def hashed(of_chunk: list, sep) -> pa.Array:
        return pa.array([hashlib.sha256(sep.join([of_chunk[c] for c in cs.tolist()])).hexdigest()
                         for cs in block.split], pa.string())

    n = pa.array([int(block.size[cs].sum()) for cs in block.split], pa.int64())
    ids = hashed([",".join(map(str, x)).encode() for x in block.of_chunks()], b",")
    back = hashed([model.decode(x) for x in block.of_chunks()], b"")
    return [block.arrow()] * with_ids + [n, ids, back]


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256, and the ids if asked for: encoding and decoding in one
    pass, so that ids need not travel to the JVM and back in between."""
    schema = _with(docs.schema, *[T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids,
                   T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                   T.StructField("decoded_sha256", T.StringType()))
    keep, names = schema.names[:-3 - with_ids], schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = replay_of(path, pattern)
        for part, texts in text_blocks(batches, text, BLOCK):
            more = _digests(model, texts, with_ids)           # a function of its own: nothing of a block outlives it
            del texts
            yield _columns(part, keep, more, names)
            del part, more

    return docs.mapInArrow(run, schema)
