"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and is one operator; ``run`` writes each
stage's result as Parquet in the shared folder and hands on what it reads
back. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evidentia.llm import exact_dedup, packing, pii, quality, simhash
from evidentia.llm.common import read, remove, scratch, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the model is trained on the labelled documents of ``sf_dir``."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"), labelled=read(spark, sf_dir))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each span of personal data replaced by its kind; n_chars follows."""
    return pii.redact(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("pii", personal_data),
    ("packing", packed),
]

#: SQL has neither the classifier nor the tokenizer; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn. What a stage wrote on its way, and its input, are removed once its result is committed,
    so that one copy of the documents stands on disk beside the one being written."""
    docs, before = read(spark, sf_dir), []
    for name, f in STAGES:
        with scratch() as made:
            docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
        remove(spark, [*before, *made[:-1]])
        before = made[-1:]
    return docs
