"""Tables whose own columns bear the names that the operators use inside."""

import pytest
from pyspark.sql import functions as F

from strata.llm import decontamination, packing, quality_classifier, quality_rules, sharding, simhash_golay
from strata.llm import chat_formatting, fill_in_middle, license_scan, ngram_jaccard, prefix_trie, token_counts
from strata.llm.common import table

SF = "/root/testdata/sf0.001"
NAMES = ("id", "_id", "_fp", "_won", "_scored", "_rules_of_input", "rules", "RULES_", "fp", "component_id", "k", "n",
         "item_id", "holds", "score", "keep", "words", "root", "a", "b", "t")


def clashing(spark, name):
    df = table(spark, SF, name)
    return df.withColumns({c: F.lit(f"own {c}") for c in NAMES if c not in df.columns})


FILTERS = {
    "quality_rules": lambda s, d: quality_rules.filter_documents(d, table(s, SF, "labels")),
    "quality_classifier": lambda s, d: quality_classifier.filter_documents(d, table(s, SF, "labels")),
    "simhash": lambda s, d: simhash_golay.keep_one(d),
    "simhash_repeated_ids": lambda s, d: simhash_golay.keep_one(d.union(d)),
    "decontamination": lambda s, d: decontamination.drop_leaking(d, clashing(s, "benchmark")),
}


@pytest.mark.parametrize("name", FILTERS)
def test_filters_pass_all_columns_through(spark, name):
    docs, plain = clashing(spark, "documents"), table(spark, SF, "documents")
    got, want = FILTERS[name](spark, docs), FILTERS[name](spark, plain)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in want.select("doc_id").collect())
    assert all(r[c] == f"own {c}" for r in rows for c in NAMES)


def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


REPORTS = {
    "token_counts": ("documents", lambda s, d: token_counts.token_counts(d, tokenizer())),
    "decontamination": ("documents", lambda s, d: decontamination.leaks(d, clashing(s, "benchmark"))),
    "license_scan": ("documents", lambda s, d: license_scan.scan(d)),
    "chat_formatting": ("conversations", lambda s, d: chat_formatting.perspectives(d)),
    "packing": ("documents", lambda s, d: packing.pack(d, tokenizer()).select("doc_id", "start", "length")),
    "sharding": ("documents", lambda s, d: sharding.assign_shards(d)),
    "simhash": ("documents", lambda s, d: simhash_golay.near_duplicates(d)),
    "quality_classifier": ("documents", lambda s, d: quality_classifier.quality_scores(d, table(s, SF, "labels"))),
    "quality_rules": ("documents", lambda s, d: quality_rules.quality_report(d, table(s, SF, "labels"))),
    "fill_in_middle": ("documents", lambda s, d: fill_in_middle.fill_in_middle(d)),
    "ngram_jaccard": ("documents", lambda s, d: ngram_jaccard.jaccard_components(d)),
    "prefix_trie": ("conversations", lambda s, d: prefix_trie.conversation_trie(d)),
}


@pytest.mark.parametrize("name", REPORTS)
def test_reports_ignore_further_columns(spark, name):
    of, run = REPORTS[name]
    got, want = run(spark, clashing(spark, of)), run(spark, table(spark, SF, of))
    columns = want.columns
    assert set(columns) <= set(got.columns)
    plain = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert plain(got) == plain(want)
