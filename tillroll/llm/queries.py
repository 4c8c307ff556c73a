"""The operators bound to the driver's tables: one query for each, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (binary_ids, html_text, language_id, mixing, ngram_join, pii, prefix_trie,
                          quality_lines, runs, sentence_pieces, token_counts, topk, turns)
from tillroll.llm.storage import new_path, remove_at_end

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(table, table.filter("vec_id % 50 = 0"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir))


def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(documents(spark, sf_dir), PIECES)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.train(docs))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir))


def op8_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "binary-ids")
    binary_ids.write_ids(documents(spark, sf_dir), BYTE_BPE, out)
    remove_at_end(spark, out)
    return binary_ids.read_ids(spark, out, binary_ids.crc32_of, "ids_crc32 long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), BYTE_BPE)


def op10_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lines.quality(documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.find_runs(documents(spark, sf_dir), rewrite=runs.repeat_tail))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.repair(turns.damage(table), present_col="present")


def op13_prefix_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digests(documents(spark, sf_dir), BYTE_BPE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_top_k, op2_html_text, op3_mixing, op4_sentence_pieces, op5_language_id,
                             op6_pii, op7_ngram_join, op8_binary_ids, op9_token_counts, op10_quality_lines,
                             op11_periodic_runs, op12_turn_repair, op13_prefix_trie_bpe)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {}
