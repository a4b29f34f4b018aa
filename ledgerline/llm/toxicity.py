"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed words. The model adds to the linear weights
an inner product of two factors for each pair of terms, so that a pair (an
insult beside a mention of a group) can weigh more or less than its parts.
In the pairs a term counts REACH / sqrt(size of the set), so that a long
text's many pairs of plain words don't outweigh one that matters.

``learn`` fits on a bounded sample (``SAMPLE`` rows of each class, first in
the order of a hash of the id). All hashed terms of the sample are the
model's input, without a filter: a pair can be toxic though each of its terms
is as frequent in both classes. AdaGrad fits the weights of the slots that
each step touches; linear weights shrink towards zero (``SHRINK``), which
keeps words of one or two rows from being learned by heart. A model has at
most ``SLOTS`` terms, whatever the corpus' size.

The fit is made ``FOLDS`` + 1 times, each a task of its own: once on the
whole sample, and once without each fold. The folds' rows, scored by the fit
that has not seen them, calibrate the score (a line through the logit). The
sample itself never reaches the driver.

Null or empty text has no terms: its score is the model's bias, calibrated.
Rows without a label, or with a null one, teach nothing; of several labels
for an id the largest counts. With one class only, every score is the rate
of that class. Repeated rows are scored alike; extra columns are kept.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import first_by_hash, give_back, saved, text_blocks

#: Rows of each class in the fitting sample, at most.
SAMPLE = 6000
SLOTS = 1 << 20
FACTORS, EPOCHS, RATE, RIDGE = 4, 16, 0.2, 1e-3
#: What a term counts in pairs: REACH / sqrt(size of the set), of FLOOR at least.
REACH, FLOOR = 4.0, 32
#: What a linear weight must be worth in the sample (sum of its rows' errors) to leave zero.
SHRINK = 1.5
#: Parts of the sample for calibration.
FOLDS = 5
#: Rows of a step at most; where AdaGrad's sums begin (weights, factors): a
#: term of few rows must not take a full step at its first sight.
BATCH, BEGIN = 256, (0.01, 0.1)
WORDS = re.compile(r"\w+")


def term_sets(texts: list[str]) -> list[np.ndarray]:
    """Distinct hashed words of each text."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    split = [np.array([number[w] for w in set(WORDS.findall(t.lower()))], np.int64) for t in texts]
    slot = np.array([zlib.crc32(w.encode()) % SLOTS for w in number], np.int64)
    return [np.unique(slot[s]) if len(s) else s for s in split]


@dataclass
class Machine:
    bias: float
    terms: np.ndarray     # sorted slots
    w: np.ndarray         # (terms,)
    v: np.ndarray         # (terms, FACTORS)
    slope: float = 1.0    # of the calibrated logit
    offset: float = 0.0

    def places(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(row, term) of every known term."""
        if not sets or not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(self.terms, flat), len(self.terms) - 1)
        hit = self.terms[at] == flat
        return row[hit], at[hit]

    def logits(self, row: np.ndarray, term: np.ndarray, n: int, share=1.0) -> tuple[np.ndarray, np.ndarray]:
        """Of each row: the sum, and the sum of its factors. ``share``: what
        each place counts in pairs."""
        v = self.v[term] * np.reshape(share, (-1, 1))
        held = _sums(row, v, n)
        square = np.bincount(row, (v ** 2).sum(1), n)
        pairs = 0.5 * ((held ** 2).sum(1) - square)
        return self.bias + np.bincount(row, self.w[term], n) + pairs, held

    def raw(self, sets: list[np.ndarray]) -> np.ndarray:
        row, term = self.places(sets)
        return self.logits(row, term, len(sets), _shares(sets)[row])[0]

    def score(self, texts: list[str]) -> np.ndarray:
        return _odds(self.slope * self.raw(term_sets(texts)) + self.offset)


def _odds(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _shares(sets: list[np.ndarray]) -> np.ndarray:
    return REACH / np.sqrt(np.maximum(FLOOR, np.array([len(s) for s in sets], float)))


def fit(terms: np.ndarray, sets: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss; ``sets`` hold slots. A linear weight's
    shrinkage is settled when its term is next met, and at the end."""
    rng = np.random.default_rng(seed)
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
    m = Machine(float(np.log(rate / (1 - rate))), terms, np.zeros(len(terms)),
                rng.normal(0, 0.02, (len(terms), FACTORS)))
    if not len(y) or y.min() == y.max():
        return m
    row, term = m.places(sets)
    share = _shares(sets)[row]
    ends = np.searchsorted(row, np.arange(len(y) + 1))
    gb, gw, gv = BEGIN[0], np.full(m.w.shape, BEGIN[0]), np.full(m.v.shape, BEGIN[1])
    batch = min(BATCH, max(16, len(y) // 16))
    settled, step = np.zeros(len(terms)), 0

    def settle(u, until):
        debt = RATE * (until - settled[u]) * SHRINK / len(y) / np.sqrt(gw[u])
        m.w[u] = np.sign(m.w[u]) * np.maximum(np.abs(m.w[u]) - debt, 0)
        settled[u] = until

    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for part in np.array_split(order, max(1, len(y) // batch)):
            size = ends[part + 1] - ends[part]
            k = np.repeat(np.arange(len(part)), size)
            at = np.arange(size.sum()) + np.repeat(ends[part] - (np.cumsum(size) - size), size)
            u, t = np.unique(term[at], return_inverse=True)   # only these terms take a step
            settle(u, step)
            step += 1
            x = share[at][:, None]
            z, held = m.logits(k, term[at], len(part), x)
            g = (_odds(z) - y[part]) / len(part)
            dw = np.bincount(t, g[k], len(u))
            dv = _sums(t, g[k][:, None] * x * (held[k] - m.v[term[at]] * x), len(u)) + RIDGE * m.v[u]
            db = g.sum()
            gb += db * db
            gw[u] += dw * dw
            gv[u] += dv * dv
            m.bias -= RATE * db / np.sqrt(gb)
            m.w[u] -= RATE * dw / np.sqrt(gw[u])
            m.v[u] -= RATE * dv / np.sqrt(gv[u])
    settle(np.arange(len(terms)), step)
    return m


def calibration(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic line through (z, y), drawn a little
    towards (1, 0), which it is without both classes."""
    if not len(y) or y.min() == y.max():
        return 1.0, 0.0
    ones = y.sum()
    goal = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    line, start, pull = np.array([1.0, 0.0]), np.array([1.0, 0.0]), 0.1
    x = np.stack([z, np.ones(len(z))], 1)
    for _ in range(100):                                      # Newton, in bounded steps
        p = _odds(x @ line)
        slope = x.T @ (p - goal) + pull * (line - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(2), slope)
        line -= step * min(1, 2 / max(np.abs(step).max(), 1e-9))
    return float(line[0]), float(line[1])


def _sums(group: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``x`` by group."""
    return np.stack([np.bincount(group, c, n) for c in x.T], 1)


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, text: str = "text",
          doc_id: str = "doc_id", label: str = "toxic", sample: int = SAMPLE) -> Machine:
    """``learn_from``: a condition on ``doc_id``."""
    y = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(learn_from) \
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    y = y.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = first_by_hash(y, "y", "doc_id", sample)
    # bounded: ``sample`` ids of each class
    sampled = rows.join(F.broadcast(chosen), "doc_id")

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches):
            slots = [s.astype(np.int32).tobytes() for s in term_sets(texts)]
            yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(slots, pa.binary())], ["y", "slots"])

    held = saved(sampled.mapInArrow(terms_of, "y int, slots binary"), "toxic-sample")
    fold = F.pmod(F.xxhash64("slots"), F.lit(FOLDS)).cast("int")
    copies = held.withColumn("fold", fold).withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))))
    fits = copies.groupBy("fit").applyInArrow(_fit_one, "bias double, terms binary, w binary, v binary, z binary, y binary")
    # a model of the whole sample, and a number a row of it
    got = saved(fits, "toxic-fits").collect()
    whole = [r for r in got if r.terms is not None]
    if not whole:
        return fit(np.zeros(0, np.int64), [], np.zeros(0))
    m = Machine(whole[0].bias, *[np.frombuffer(whole[0][c], k) for c, k in (("terms", np.int64), ("w", float), ("v", float))])
    m.v = m.v.reshape(-1, FACTORS)
    z, y = (np.concatenate([np.frombuffer(r[c], float) for r in got]) for c in ("z", "y"))
    m.slope, m.offset = calibration(z, y)
    return m


def _fit_one(table: pa.Table) -> pa.Table:
    """The fit without one fold, and that fold's raw scores; fit number
    FOLDS is on all rows and gives the model."""
    which = table.column("fit")[0].as_py()
    keys = sorted(zip(table.column("slots").to_pylist(), table.column("y").to_pylist(), table.column("fold").to_pylist()))
    learn_, rest = [k for k in keys if k[2] != which], [k for k in keys if k[2] == which]
    sets, y = [np.frombuffer(k[0], np.int32) for k in learn_], np.array([k[1] for k in learn_], float)
    known = len(y) and 0 < y.sum() < len(y)                   # without both classes no term is kept
    m = fit(np.unique(np.concatenate(sets)).astype(np.int64) if known else np.zeros(0, np.int64), sets, y)
    z = m.raw([np.frombuffer(k[0], np.int32) for k in rest]) if known else np.zeros(0)
    model = [m.terms.tobytes(), m.w.tobytes(), m.v.tobytes()] if which == FOLDS else [None] * 3
    kinds = [pa.float64(), *[pa.binary()] * 5]
    values = [m.bias, *model, z.tobytes(), np.array([k[1] for k in rest][:len(z)], float).tobytes()]
    give_back()
    return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                names=["bias", "terms", "w", "v", "z", "y"])


def score(docs: DataFrame, machine: Machine, text: str = "text", out: str = "score",
          keep_text: bool = True) -> DataFrame:
    """``docs`` with a score of 0 to 1."""
    schema = T.StructType([f for f in docs.schema if f.name != out and (keep_text or f.name != text)]
                          + [T.StructField(out, T.DoubleType())])
    keep = schema.names[:-1]
    model = docs.sparkSession.sparkContext.broadcast(machine)  # at most SLOTS terms: some 50 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, text):
            yield pa.RecordBatch.from_arrays([part.column(n) for n in keep] + [pa.array(model.value.score(texts))],
                                             schema.names)

    return docs.mapInArrow(run, schema)
