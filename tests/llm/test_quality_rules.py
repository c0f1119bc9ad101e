"""Quality rules: counts against brute force, exact bounds, odd rows."""

import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from strata.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(lines), sum("A" <= c <= "Z" for c in text))


TEXTS = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "a a a a a a", "x\n\nx\ny\n x\nx", "É# ñ|\xa0 b\x0bc\x0cd",
         "A B C D " * 3 + "e f g", " ".join(str(i % 97) for i in range(9000)), "same " * 30000, "tie", "tie",
         " ".join(f"{i} {i + 1} q" for i in range(60)) + " " + " ".join(f"{i} {i + 1} q" for i in range(40))]


def test_counts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = Q.rule_counts(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert tuple(r["rules"][c] for c in Q.COUNTS) == brute(TEXTS[r["doc_id"]])


@pytest.mark.parametrize("n,k,p", [(1, 0, 0.3), (50, 3, 0.2), (400, 1, 0.01), (1000, 20, 0.05)])
def test_binomial_tail_is_exact(n, k, p):
    want = sum(comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k + 1))
    assert Q.binomial_cdf(k, n, p) == pytest.approx(want, rel=1e-9)


def test_certified_cutoffs_keep_their_promise():
    # Rejecting k of n clean documents is certified only far enough below the risk.
    assert not Q.certified(0, 100, 0.01, 1e-3)
    assert Q.certified(0, 1000, 0.01, 1e-3)
    assert not Q.certified(9, 1000, 0.01, 1e-3)
    assert not Q.certified(0, 0, 0.01, 0.5)
    assert Q.binomial_cdf(40, 10_000, 0.01) <= 1e-3 and Q.certified(40, 10_000, 0.01, 1e-3)


def corpus(spark, n):
    """Distinct texts; every tenth one is noisy."""
    rows = [(i, " ".join(f"word{i}x{j}" + "###" * (i % 10 == 0) for j in range(60)), "en" if i % 2 else "fr", "s")
            for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, rules string")
    labels = spark.createDataFrame([(i, int(i % 10 != 0), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    return docs, labels


def left_of(spark_df):
    return {r["doc_id"] for r in spark_df.select("doc_id").collect()}


def test_learnt_rungs_reject_and_too_few_labels_do_not(spark):
    docs, labels = corpus(spark, 2_000)
    kept = Q.filter_documents(docs, labels)
    assert kept.columns == docs.columns
    assert left_of(kept) == {i for i in range(2_000) if i % 10}
    assert Q.filter_documents(docs, labels.filter("doc_id < 100")).count() == 2_000
    assert Q.filter_documents(docs, labels.limit(0)).count() == 2_000


def test_copies_are_one_trial(spark):
    docs, labels = corpus(spark, 2_000)
    copies = docs.withColumn("text", F.when(F.col("doc_id") % 10 == 0, F.col("text")).otherwise(
        F.concat_ws(" ", *[F.lit(f"same{j}") for j in range(60)])))
    assert Q.filter_documents(copies, labels).count() == 2_000


def test_fixed_sequence_ends_at_the_first_failure():
    assert Q.climb(1000, [0, 2, 5, 400, 0], 0.03, 0.01) == 3
    assert Q.climb(1000, [0, 0, 0], 0.03, 0.01) == 3
    assert Q.climb(100, [0, 0, 0], 0.03, 0.01) == 0 == Q.climb(0, [0], 0.03, 0.5)


def test_ladder_never_becomes_laxer():
    assert all(a >= b for low, high in zip(Q.LADDER, Q.LADDER[1:]) for a, b in zip(low, high))


def test_strata_come_from_the_data(spark):
    docs, labels = corpus(spark, 2_000)
    some = docs.withColumn("lang", F.expr(
        "case when doc_id % 2 = 1 then 'xx' when doc_id < 100 then 'yy' when doc_id % 4 = 0 then null else 'other' end"))
    rungs = Q.learn_rungs(Q.counted(some), labels)
    assert set(rungs) == {"xx", "other"} and min(rungs.values()) > 0
    assert left_of(Q.filter_documents(some, labels)) == {i for i in range(2_000) if i % 10}


def test_rejections_of_clean_texts_stay_under_the_risk(spark):
    """Where many clean texts are noisy no rung that rejects them is certified."""
    docs, _ = corpus(spark, 2_000)
    labels = spark.range(2_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert Q.filter_documents(docs, labels).count() == 2_000


def test_odd_rows(spark):
    docs, labels = corpus(spark, 20)
    odd = docs.selectExpr("null as doc_id", "null as text", "null as lang", "null as rules").union(docs).union(docs)
    assert Q.quality_report(odd, labels.union(labels)).count() == 60
    empty = Q.quality_report(docs.limit(0), labels)
    assert empty.count() == 0
    nulls = spark.createDataFrame([(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert Q.filter_documents(docs, nulls).count() == 20
