"""A training corpus from raw documents: quality rules, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept; ``run``
writes every stage's rows to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadtide.llm import mixing, packing, pii, quality, simhash
from leadtide.llm.common import documents, restored, sheltered, stored

#: Classifier, tokens and random numbers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.judge(sheltered(docs, "doc_id", "text"), quality.fit(docs, labels)).where("kept")
    return judged.select(*restored(judged, docs, "doc_id", "text"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each_group(docs, shingle_words=3, most_bits=2)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are masked; n_chars follows."""
    return pii.sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source is to give the same number of documents; rows repeat or go by a Poisson draw."""
    used = ("doc_id", "text", "source")
    mixed = mixing.mix(sheltered(docs, *used))
    return mixed.select(*restored(mixed, docs, *used))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents, placed in sequences of at most 1024 ids."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("PII", personal_data_stage),
    ("mixing sources", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
