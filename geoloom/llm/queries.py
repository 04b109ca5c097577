"""One query for each operator over the whole tables of a folder, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm import bpe_codec, conversation_repair, fertility, fingerprints, language_id, line_dedup, mixing, ngram_join, sentence_pieces, token_counts, token_index, toxicity, whitening


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.apply_rules(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_with_next(documents(spark, sf_dir))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_classes(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op9_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index.encode_and_read(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_toxicity, op2_fertility_rules, op3_source_mixing, op4_line_dedup, op5_order_minhash,
        op6_ngram_jaccard_join, op7_language_id, op8_token_counts, op9_token_index, op10_bpe_round_trip,
        op11_whitening, op12_piece_round_trip, op13_conversation_repair,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op3_source_mixing": mixing.oracle(), "op4_line_dedup": line_dedup.oracle(), "op6_ngram_jaccard_join": ngram_join.oracle(), "op13_conversation_repair": conversation_repair.oracle()}
