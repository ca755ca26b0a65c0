"""The registered queries of this subpackage: each applies its operator to the whole table it is meant for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm.bitpack import token_digests, write_packed
from claimloom.llm.common import table
from claimloom.llm.content_sort import exact_groups
from claimloom.llm.conversations import damaged, repair_report
from claimloom.llm.fim import fim_digests
from claimloom.llm.langid import language_predictions
from claimloom.llm.latent import benchmark_leaks
from claimloom.llm.lattice import similar_vectors
from claimloom.llm.licenses import scan_licenses
from claimloom.llm.maglev import place
from claimloom.llm.mixing import mix
from claimloom.llm.quality import quality_scores
from claimloom.llm.simhash import near_groups
from claimloom.llm.toxicity import toxicity_scores
from claimloom.session import scratch_dir

#: Shards of the registered sharding query and of the pipeline.
SHARDS = 32


def op1_bit_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_dir(spark, "llm-packed")
    write_packed(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_digests(spark, path)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_predictions(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations")
    return repair_report(convs, damaged(convs))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bit_packed_tokens": op1_bit_packed_tokens,
    "op2_toxicity": op2_toxicity,
    "op3_mix_sources": op3_mix_sources,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_language_id": op6_language_id,
    "op7_license_scan": op7_license_scan,
    "op8_quality": op8_quality,
    "op9_shard": op9_shard,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}
