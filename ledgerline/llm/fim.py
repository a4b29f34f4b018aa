"""Fill-in-the-middle transformation with a learned rank index.

A text is cut into units (code points, or the matches of a pattern, left to
right; what stands after a match belongs to it, what stands before the
first match to the first; a text without a match has no unit and stays
plain). Where unit i starts in the text's UTF-8 bytes is boundary i; n
units have n + 1 boundaries. Over all of them a piecewise-linear index is
fitted: a segment is a line through its first boundary, and goes on as long
as some slope keeps every boundary within ``BOUND`` bytes. What the rounded line misses is kept as a signed byte, so
a cut is predicted by its segment's line and then corrected exactly.
Boundaries are made and fitted in pieces of ``PIECE`` bytes of text, a
text at a time: what is held is one byte a unit, and its segments.

Two cuts come from a hash of the row's id. The text is written as

* psm  prefix mark, prefix, suffix mark, suffix, middle mark, middle
* spm  suffix mark, suffix, prefix mark, prefix, middle mark, middle
* plain the text itself, for an empty text, one that holds a mark, and the
  share of rows that is left alone.

``restore`` rebuilds the text from output and form alone; marks must
differ, be no part of each other and not end as any of them starts, so that
no mark can arise where a part and a mark meet.

Null text is empty. A null id is hashed as an empty one. Equal rows give
equal rows. Extra columns are kept, whatever they are called (the added
columns come last; a column of the same name as an added one is renamed to
``<name>_in``). An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_blocks

#: Largest distance, in bytes, of a boundary from its segment's line (residuals fit a signed byte).
BOUND = 60
#: Text bytes whose boundaries are made at once.
PIECE = 1 << 20
MARKS = ("<P>", "<S>", "<M>")
ADDED = ("n", "form", "prefix_chars", "middle_chars", "n_segments", "output")


# ------------------------------------------------------------ rank index ---

@dataclass
class RankIndex:
    """Segments (first rank, first offset, slope) and a residual a rank."""

    rank: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def at(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of these ranks."""
        ranks = np.asarray(ranks, np.int64)
        seg = np.searchsorted(self.rank, ranks, "right") - 1
        line = self.offset[seg] + np.rint(self.slope[seg] * (ranks - self.rank[seg])).astype(np.int64)
        return line + self.residual[ranks]

    def __len__(self) -> int:
        return len(self.residual)


def fit(offsets: Iterator[np.ndarray], bound: int = BOUND) -> RankIndex:
    """Fit the index to rising offsets that come in pieces. A segment ends
    with its piece at the latest."""
    ranks, firsts, slopes, residuals, base = [], [], [], [], 0
    for ys in offsets:
        at = 0
        while at < len(ys):
            n, slope = _segment(ys[at:], bound)
            run = ys[at:at + n]
            ranks.append(base + at)
            firsts.append(run[0])
            slopes.append(slope)
            residuals.append((run - run[0] - np.rint(slope * np.arange(n)).astype(np.int64)).astype(np.int8))
            at += n
        base += len(ys)
    return RankIndex(np.array(ranks, np.int64), np.array(firsts, np.int64), np.array(slopes, float),
                     np.concatenate(residuals) if residuals else np.zeros(0, np.int8))


def _segment(ys: np.ndarray, bound: int) -> tuple[int, float]:
    """How many offsets one line through the first holds, and its slope:
    the slopes that the offsets allow are a narrowing interval."""
    low, high, done, width = -np.inf, np.inf, 1, 256
    while done < len(ys):
        end = min(len(ys), done + width)
        x, y = np.arange(done, end, dtype=float), (ys[done:end] - ys[0]).astype(float)
        lows = np.maximum.accumulate(np.maximum((y - bound) / x, low))
        highs = np.minimum.accumulate(np.minimum((y + bound) / x, high))
        bad = np.flatnonzero(lows > highs)
        if len(bad):
            if bad[0]:
                low, high = lows[bad[0] - 1], highs[bad[0] - 1]
            done += int(bad[0])
            break
        low, high, done, width = lows[-1], highs[-1], end, width * 4
    return done, 1.0 if done == 1 else (low + high) / 2


def boundaries(data: bytes, unit: str | None = None) -> Iterator[np.ndarray]:
    """Byte offsets at which units start, then the length of ``data``, in
    pieces. ``unit``: a pattern over the text; None: code points."""
    if unit is None:
        for at in range(0, len(data), PIECE):
            part = np.frombuffer(data, np.uint8, min(PIECE, len(data) - at), at)
            yield np.flatnonzero((part & 0xC0) != 0x80) + at
    else:
        text, done, size, first = data.decode("utf-8"), 0, 0, True
        starts: list[int] = []
        for m in re.finditer(unit, text):
            if m.end() == m.start():
                continue
            size += len(text[done:m.start()].encode("utf-8"))
            starts.append(0 if first else size)               # what stands before the first match is its own
            done, first = m.start(), False
            if len(starts) >= PIECE:
                yield np.array(starts, np.int64)
                starts = []
        yield np.array(starts, np.int64)
    yield np.array([len(data)], np.int64)


# ------------------------------------------------------------- transform ---

@dataclass(frozen=True)
class Recipe:
    """``seed`` goes before the id in the hash; ``plain`` and ``spm`` are
    percentages (of all rows; of the rows that are not plain)."""

    seed: str = "1:"
    plain: int = 10
    spm: int = 20
    marks: tuple[str, str, str] = MARKS
    unit: str | None = None

    def __post_init__(self):
        for i, a in enumerate(self.marks):
            if not a:
                raise ValueError("a mark is empty")
            for j, b in enumerate(self.marks):
                if (i != j and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"marks {a!r} and {b!r} overlap")


def cut(text: str, doc_id, recipe: Recipe = Recipe()) -> tuple:
    """n, form, prefix and middle sizes in units, segments, output."""
    key = recipe.seed + ("" if doc_id is None else str(doc_id))
    h = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    data = text.encode("utf-8")
    index = fit(boundaries(data, recipe.unit))
    n = len(index) - 1
    if n == 0 or h3 % 100 >= 100 - recipe.plain or any(m in text for m in recipe.marks):
        return n, "plain", None, None, len(index.rank), text
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = index.at(np.array([one, two]))
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = (x.encode("utf-8") for x in recipe.marks)
    if h4 % 100 < recipe.spm:
        form, out = "spm", s + suffix + p + prefix + m + middle
    else:
        form, out = "psm", p + prefix + s + suffix + m + middle
    return n, form, one, two - one, len(index.rank), out.decode("utf-8")


def transform(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars (units; null if
    plain), n_segments (of the rank index) and output. No shuffle: each row
    is made from itself."""
    clash = {c.lower() for c in docs.columns}
    docs = docs.select(*[F.col(f"`{c}`").alias(f"{c}_in" if c.lower() in ADDED else c) for c in docs.columns])
    if clash & set(ADDED) and len(set(map(str.lower, docs.columns))) < len(docs.columns):
        raise ValueError("two columns have the same name")
    out = docs.withColumns({
        "n": F.lit(0).cast("long"), "form": F.lit(""), "prefix_chars": F.lit(None).cast("long"),
        "middle_chars": F.lit(None).cast("long"), "n_segments": F.lit(0).cast("int"), "output": F.lit("")})

    def work(batches):
        for part, texts in text_blocks(batches):
            rows = [cut(t, i, recipe) for t, i in zip(texts, part.column("doc_id").to_pylist())]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *ADDED])

    return docs.mapInArrow(work, out.schema)


def restore(rows: DataFrame, recipe: Recipe = Recipe(), output: str = "output", form: str = "form",
            out: str = "restored") -> DataFrame:
    """``rows`` with the text rebuilt from output and form (built-in
    functions only): a mark's first place after the mark before it is its own."""
    p, s, m = (F.lit(x) for x in recipe.marks)
    text = F.col(output)

    def rebuilt(first, second, prefix_first: bool):
        head = F.length(first) + 1
        at2 = F.locate(recipe.marks[1 if prefix_first else 0], text)
        one = F.substring(text, head, at2 - head)
        rest = F.substring(text, at2 + F.length(second), F.length(text))
        at3 = F.locate(recipe.marks[2], rest)
        two = F.substring(rest, F.lit(1), at3 - 1)
        middle = F.substring(rest, at3 + F.length(m), F.length(text))
        return F.concat(one, middle, two) if prefix_first else F.concat(two, middle, one)

    return rows.withColumn(out, F.when(F.col(form) == "psm", rebuilt(p, s, True))
                           .when(F.col(form) == "spm", rebuilt(s, p, False)).otherwise(text))


def digests(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """Sizes and hashes of output and rebuilt text, one row a document."""
    rows = restore(transform(docs.select("doc_id", "text"), recipe), recipe)
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output").alias("output_sha256"),
                       sha("restored").alias("restored_sha256"))


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
k AS (
  SELECT doc_id, t, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4
  FROM d),
f AS (
  SELECT doc_id, t, n, least(a, b) AS c1, greatest(a, b) AS c2,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN c1 END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN c2 - c1 END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || substr(t, 1, c1) || '<S>' || substr(t, c2 + 1) || '<M>' || substr(t, c1 + 1, c2 - c1)
              ELSE '<S>' || substr(t, c2 + 1) || '<P>' || substr(t, 1, c1) || '<M>' || substr(t, c1 + 1, c2 - c1)
              END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
