"""Corpus pipeline: language, near copies, repeated strings, benchmark
passages, tokens.

Each stage takes the documents that its predecessor kept, as Parquet, and
works on all of them. All but the last return the columns of the documents.

* language_id drops texts without a letter, or with hardly any in a script
  that the learned languages use. It learns from labelled rows whose
  crc32(id) mod 3 is not 1.
* near_copies keeps the document with the smallest id of each component of
  the 5-gram Jaccard join.
* repeated_strings cuts the bytes of 100-byte strings that start earlier;
  ``n_chars``, if there, follows the new text. A document may become empty
  and is kept.
* benchmark_passages drops documents that hold a benchmark item.
* tokens encodes and decodes the text by the rank file and adds ids,
  n_tokens, ids_sha256 and decoded_sha256.

Null texts end at the first stage. Rows with a null id pass the stages that
compare documents by id (2 and 4); rows that share an id stay or go
together. Empty tables pass through. Extra columns are kept, whatever they
are called.

Documents travel to Python in batches of ``BATCH_ROWS`` rows, where the
session has Spark's own number: a batch stands in the JVM's buffers, twice,
and in Python, beside a full heap.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontam, langid, ngram_join, suffix_dedup
from ledgerline.llm.common import id_bucket, saved, table
from ledgerline.llm.queries import bpe_files

#: Texts with a smaller share of letters in a learned language are dropped.
LEAST_SHARE = 0.2
#: Rows of a batch between JVM and Python, for Spark's 10,000.
BATCH_ROWS, SPARK_ROWS = 1000, "10000"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_batches(stage: Stage) -> Stage:
    """A stage is run after it returns, so its session keeps the setting."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if spark.conf.get(key) == SPARK_ROWS:
            spark.conf.set(key, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


def _inner(docs: DataFrame) -> DataFrame:
    """Other columns than the operators' get names that can't clash."""
    own = {"doc_id", "text", "lang"}
    return docs.toDF(*[c if c in own else f"_c{i}" for i, c in enumerate(docs.columns)])


@small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _inner(docs)
    model = langid.learn(rows, id_bucket(F.col("doc_id"), 3) != 1)
    found = langid.identify(rows, model)
    kept = found.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= LEAST_SHARE))
    return kept.select(*rows.columns).toDF(*docs.columns)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    return docs.join(gone.select(F.col("doc_id").alias("_gone")).distinct(), F.col("doc_id") == F.col("_gone"),
                     "left_anti")


@small_batches
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _inner(docs)
    found = ngram_join.join(rows)
    return _without(rows, found.where("doc_id <> component_id")).toDF(*docs.columns)


@small_batches
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.coalesce(F.length("text").cast(kind), F.col("n_chars"))
        out = out.select(*[size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
    return out


@small_batches
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _inner(docs)
    # kept in a table, as the index of the items is read by one pass only
    found = saved(decontam.hits(rows, table(spark, sf_dir, "benchmark")), "leaks")
    return _without(rows, found).toDF(*docs.columns)


@small_batches
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, *bpe_files(), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("repeated_strings", repeated_strings),
    ("benchmark_passages", benchmark_passages),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The join, the suffix order and the merges have no form in SQL; tests hold
#: the stages against brute force.
ORACLE_SQL = None
