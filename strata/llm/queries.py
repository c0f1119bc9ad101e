"""One thin query per operator, over the whole tables with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    chat_formatting,
    decontamination,
    fill_in_middle,
    license_scan,
    ngram_jaccard,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    sharding,
    simhash_golay,
    token_counts,
    token_files,
)
from strata.llm.common import scratch_path, table


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the edit distance."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, labels and score of every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered from every participant's perspective."""
    return chat_formatting.perspectives(table(spark, sf_dir, "conversations"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus written as binary token files in the shared folder, and read back."""
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, folder)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op8_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_golay.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-trained scores of every document."""
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts, the base verdict and the risk-controlled verdict per document."""
    report = quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's fill-in-middle form, and of the text rebuilt from it."""
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"))


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and component of every document."""
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, rebuilt with shared heads."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_license_scan": op3_license_scan,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_token_files": op5_token_files,
    "op6_packing": op6_packing,
    "op7_sharding": op7_sharding,
    "op8_simhash_golay": op8_simhash_golay,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_prefix_trie": op13_prefix_trie,
}
