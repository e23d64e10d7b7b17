"""One query per operator, over whole tables with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import (conversations, debruijn, decontaminate, licenses, packing, permutation_index, sharding, simhash, suffix_array,
                            token_count, token_planes, toxicity, whitening)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("spans")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.suffix_dedup(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.substring_dedup(table(spark, sf_dir, "documents"))


def op8_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())[1]


def op9_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_best_fit_packing, op2_feistel_sharding, op3_toxicity, op4_simhash, op5_suffix_array, op6_token_counts,
                             op7_debruijn, op8_token_planes, op9_permutation_index, op10_decontamination, op11_license_scan, op12_conversation_repair,
                             op13_whitening)}

#: Every query of this subpackage runs on text bytes, trained models or iterated joins that SQL has no words for;
#: tests/llm holds each against a brute-force version.
ORACLE: dict[str, str] = {}
