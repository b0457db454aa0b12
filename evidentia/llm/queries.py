"""The registered queries: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import byte_bpe, exact_dedup, licenses, packing, passages, phrases, pii, prefix_trie, quality, secret_scan, sharding, simhash, toxicity
from evidentia.llm.common import read


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir), read(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir), one_per_passage=True)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read(spark, sf_dir))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(sharding.shuffle_records(read(spark, sf_dir)))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(read(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(read(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(read(spark, sf_dir))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir), read(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = prefix_trie.turn_lists(read(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_start(lists))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_packing, op3_pii, op4_license_scan, op5_exact_dedup,
                            op6_substring_dedup, op7_sharding, op8_byte_bpe, op9_simhash, op10_secrets,
                            op11_toxicity, op12_collocations, op13_prefix_trie)}
ORACLES: dict[str, str] = {"op5_exact_dedup": exact_dedup.ORACLE, "op12_collocations": phrases.ORACLE, "op13_prefix_trie": prefix_trie.ORACLE}
