"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (bpe, chat, decontam, fim, gru_lm, langid, ngram_join, phrase_dedup, prefix_trie, reshard,
                            suffix_dedup, toxicity, winnow)
from ledgerline.llm.common import id_bucket, saved, table
from ledgerline.session import work_dir

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
SHARDS = 16


def bpe_files() -> tuple[str, str]:
    """Path of the rank file, and the split pattern."""
    import public_tokenizers as P

    return P.path(BPE_RANKS), P.PATTERN


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, *bpe_files()).drop("text")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs, id_bucket(F.col("doc_id"), 3) != 1)
    out = langid.identify(docs.select("doc_id", "text"), model, keep_text=False)
    return out.select("doc_id", (id_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score",
                      F.size("span_words").alias("n_spans"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.learn(docs, table(spark, sf_dir, "labels"), id_bucket(F.col("doc_id"), 3) != 1)
    out = toxicity.score(docs, machine, keep_text=False)
    return out.select("doc_id", (id_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    return decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = gru_lm.score(table(spark, sf_dir, "documents"), id_bucket(F.col("doc_id"), 7) != 2)
    return out.withColumn("held_out", id_bucket(F.col("doc_id"), 7) == 2)


def op9_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout keeps the documents of a source together, so its
    shards are as uneven as the sources. A row is known by its file and its
    place in it. Sizes and checksums are those of the texts that stand in
    the shards after the rewrite."""
    docs = table(spark, sf_dir, "documents")
    old = docs.select("doc_id", "text", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("row_id"),
                      (F.coalesce(F.crc32(F.col("source").cast("binary")), F.lit(0)) % SHARDS)
                      .cast("int").alias("old_shard"))
    moves = saved(reshard.plan(old, F.col("old_shard"), SHARDS, row_id="row_id"), "moves")
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return reshard.after(old, moves, work_dir(spark, "new-shards"), "row_id").select(
        "doc_id", (F.length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op10_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compare_edits(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = prefix_trie.with_shared_heads(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(turns, members)


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op13_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat": op1_chat,
    "op2_bpe": op2_bpe,
    "op3_ngram_join": op3_ngram_join,
    "op4_langid": op4_langid,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_decontam": op7_decontam,
    "op8_gru_lm": op8_gru_lm,
    "op9_reshard": op9_reshard,
    "op10_winnow": op10_winnow,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fim": op12_fim,
    "op13_phrase_dedup": op13_phrase_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat": chat.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_fim": fim.ORACLE,
}
