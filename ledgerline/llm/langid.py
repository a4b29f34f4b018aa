"""Language identification with spans.

Every word gets a score for each learned language: the log-likelihood of
its letter trigrams (with both word ends), hashed into a table. The script
ranges of the word's first letter narrow the candidates to languages that
use that script. A Viterbi pass over the words of a text, with a penalty
for switching, labels each word; runs of one label are spans. The language
of the text is the one with most letters.

``learn`` fits the table on a bounded sample: ``SAMPLE`` labelled rows for
each language, the first in the order of a hash of the id. Prediction reads
the text alone, whole, a block of texts at a time.

The score is the share of the letters that are labelled so; letters of a
script that no learned language uses count for none. Null text or text
without a letter: ``und``, score 0, no span. Ties go to
the first language in alphabetic order. Repeated rows are labelled alike;
extra columns are kept. With no labelled row every text is ``und``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import first_by_hash, text_blocks

#: Labelled rows a language is learned from, at most.
SAMPLE = 2000
#: Slots of the hashed trigram table.
SLOTS = 1 << 15
#: Loss of log-likelihood that a change of language must make good.
SWITCH = 12.0
#: A script belongs to a language when it holds at least this share of its letters.
SCRIPT_SHARE = 0.02
BLOCK = 8 << 20
UND = "und"
LETTERS = re.compile(r"[^\W\d_]+")
# First code points of Unicode script ranges.
SCRIPTS = np.array([0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xE00, 0x1000, 0x1100,
                    0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD800], np.int64)
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram slots of all words, where each word's begin, and each word's
    script (of its first letter)."""
    code = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    h = code[:-2] * _MIX[0] ^ code[1:-1] * _MIX[1] ^ code[2:] * _MIX[2]
    slot = ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)).astype(np.int64)
    inner = code[1:-1] != 32
    starts = np.flatnonzero(inner & (code[:-2] == 32))
    script = np.searchsorted(SCRIPTS, code[starts + 1].astype(np.int64), "right") - 1
    return slot[inner], np.cumsum(inner)[starts] - 1, script


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray      # (SLOTS, languages)
    uses: np.ndarray      # (scripts, languages): the language is written in the script

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each word and language, and whether any uses its script
        (of the others no language knows anything)."""
        slot, starts, script = grams(words)
        may = self.uses[script]
        some = may.any(1)
        score = np.add.reduceat(self.logp[slot], starts, axis=0)
        return np.where(may, score, np.where(some[:, None], np.float32(-1e4), np.float32(0))), some


def learn(docs: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang",
          doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    rows = docs.where(learn_from & F.col(lang).isNotNull() & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    ids = first_by_hash(rows, "lang", "doc_id", sample).select("doc_id").distinct()
    rows = rows.join(F.broadcast(ids), "doc_id", "left_semi")  # bounded: ``sample`` ids a language

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, texts in text_blocks(batches):
            for name, t in zip(part.column("lang").to_pylist(), texts):
                words = LETTERS.findall(t.lower())
                if not words:
                    continue
                slot, _, script = grams(words)
                size = np.array([len(w) for w in words])
                own = sums.setdefault(name, np.zeros(SLOTS + len(SCRIPTS)))
                own[:SLOTS] += np.bincount(slot, minlength=SLOTS)
                own[SLOTS:] += np.bincount(script, size, minlength=len(SCRIPTS))
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(own[at])],
                                             ["lang", "slot", "n"])

    got = rows.mapInArrow(count, "lang string, slot long, n double").groupBy("lang", "slot") \
        .agg(F.sum("n").alias("n")).toPandas()                 # languages x table size at most
    langs = sorted(got["lang"].unique())
    counts = np.zeros((SLOTS + len(SCRIPTS), max(len(langs), 1)))
    if langs:
        counts[got["slot"].to_numpy(), np.searchsorted(langs, got["lang"].to_numpy())] = got["n"].to_numpy()
    c = counts[:SLOTS] + 0.5
    share = counts[SLOTS:] / np.maximum(counts[SLOTS:].sum(0), 1)
    return Model(langs, np.log(c / c.sum(0)).astype(np.float32), share >= SCRIPT_SHARE)


def viterbi(score: np.ndarray, word: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
            switch: float = SWITCH) -> np.ndarray:
    """Best label of every word. ``word``: rows of ``score``, the texts'
    words behind each other; ``starts``, ``sizes``: the texts. All texts of
    the block step together, the longest first."""
    n_lang = score.shape[1]
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), "left")         # texts with more than t words
    value = np.zeros((len(sizes), n_lang), np.float32)
    came = np.zeros((len(word), n_lang), np.uint8)
    stay = np.arange(n_lang, dtype=np.uint8)
    for t in range(steps):
        a = active[t]
        at = starts[:a] + t
        v = value[:a]
        if t:
            best = v.argmax(1)
            jump = v[np.arange(a), best] - np.float32(switch)
            moved = jump[:, None] > v
            came[at] = np.where(moved, best[:, None].astype(np.uint8), stay)
            np.maximum(v, jump[:, None], out=v)
        v += score[word[at]]
    label = np.zeros(len(word), np.uint8)
    state = value.argmax(1).astype(np.uint8)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        at = starts[:a] + t
        label[at] = state[:a]
        if t:
            state[:a] = came[at, state[:a]]
    return label


def label_texts(model: Model, texts: list[str]) -> tuple[list, list, list, list]:
    """Of each text: language, score, and word spans as (words, language)
    runs: two lists of lists."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    split = [np.array([number[w] for w in LETTERS.findall(t.lower())], np.int64) for t in texts]
    words = list(number)
    if not words or not model.langs:
        return [UND] * len(texts), [0.0] * len(texts), [[] for _ in texts], [[] for _ in texts]
    sizes = np.array([len(s) for s in split])
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate(split)
    score, known = model.word_scores(words)
    label = viterbi(score, flat, starts, sizes)
    # a letter is what str.isalpha says; the word pattern also takes a few number signs
    size = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words])[flat]
    n_lang = len(model.langs)
    doc = np.repeat(np.arange(len(texts)), sizes)
    total = np.bincount(doc * n_lang + label, size * known[flat], len(texts) * n_lang).reshape(-1, n_lang)
    letters = np.bincount(doc, size, len(texts))
    best = total.argmax(1)
    share = total.max(1) / np.maximum(letters, 1)
    lang = [model.langs[b] if n else UND for b, n in zip(best.tolist(), letters.tolist())]
    change = np.flatnonzero(np.append(True, (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])))
    runs, names = [[] for _ in texts], [[] for _ in texts]
    for i, k, n in zip(doc[change].tolist(), label[change].tolist(), np.diff(np.append(change, len(flat))).tolist()):
        runs[i].append(n)
        names[i].append(model.langs[k])
    return lang, share.tolist(), runs, names


def identify(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with lang_pred, score and the spans: span_words (number of
    words of each run) and span_langs."""
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
             T.StructField("span_words", T.ArrayType(T.IntegerType())),
             T.StructField("span_langs", T.ArrayType(T.StringType()))]
    names = {f.name for f in added}
    schema = T.StructType([f for f in docs.schema
                           if f.name not in names and (keep_text or f.name != text)] + added)
    keep = schema.names[:-4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, text, BLOCK):
            lang, score, runs, langs = label_texts(model, texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in keep] + [pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                                  pa.array(runs, pa.list_(pa.int32())),
                                                  pa.array(langs, pa.list_(pa.string()))], schema.names)

    return docs.mapInArrow(run, schema)
