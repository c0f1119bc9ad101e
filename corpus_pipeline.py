"""A corpus pipeline over ``documents``: each stage calls one operator of ``strata.llm``.

Every stage is written as Parquet in the shared folder and read back, so a lost
executor costs no stage that is done.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontamination, packing, quality_classifier, quality_rules, simhash_golay
from strata.llm.common import stage, table


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that a rule rejects go."""
    return quality_rules.filter_documents(docs, table(spark, sf_dir, "labels"))


def apply_quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the classifier rejects go."""
    return quality_classifier.filter_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of near copies stays."""
    return simhash_golay.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark item go."""
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the token ids in sequences of at most 2048.  The stages share the
    executors' memory, so the table of encoded words is a small one."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), table_bytes=64 << 20)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("quality_classifier", apply_quality_classifier),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# Token ids of a tokenizer and trained models are beyond SQL; tests/llm holds the
# pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
