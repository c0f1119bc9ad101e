"""Co-training: held-out accuracy, exchange of labels, odd rows."""

import numpy as np
import pytest

from strata.llm import quality_classifier as Q
from tests.conftest import SF_ORACLE


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = labels.filter("xxhash64(doc_id) % 4 <> 0")
    held = labels.subtract(known)
    scores = Q.quality_scores(docs, known)
    rows = scores.join(held, "doc_id").select("keep", "quality", "toxic").collect()
    good = [r for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r for r in rows if r["quality"] == 0 or r["toxic"] == 1]
    assert scores.count() == docs.count() and len(rows) > 500
    assert sum(r["keep"] for r in good) >= 0.99 * len(good)
    assert sum(not r["keep"] for r in bad) >= 0.93 * len(bad)


def test_views_exchange_pseudo_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = Q.train(docs, labels, fit_rows=1500, pool_rows=500)
    assert len(model.traded) == Q.ROUNDS and model.traded[-1][1] > 0
    assert 5 <= len(model.telling) <= Q.TELLING_WORDS


@pytest.fixture(scope="module")
def small(spark):
    return (spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), spark.read.parquet(f"{SF_ORACLE}/labels.parquet"))


def test_odd_rows(spark, small):
    docs, labels = small
    odd = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (10 ** 9, "", "xx", "new", -5), (10 ** 9, "big " * 50000, "en", "src1", 1)],
        docs.schema))
    nulls = spark.createDataFrame([(None, 1, 0), (5, None, None), (7, 1, None)], labels.schema)
    scored = Q.quality_scores(odd, labels.unionByName(labels).unionByName(nulls))
    assert scored.count() == odd.count()
    assert scored.filter("score is null or score < 0 or score > 1").count() == 0
    kept = Q.filter_documents(odd.withColumn("keep", odd.doc_id), labels)
    assert kept.columns == [*docs.columns, "keep"]


def test_too_few_labels_keep_everything(small):
    docs, labels = small
    assert Q.filter_documents(docs, labels.limit(0)).count() == docs.count()
    scored = Q.quality_scores(docs, labels.filter("quality = 1 and toxic = 0"))
    assert scored.filter("keep and score is null").count() == docs.count()
    assert Q.quality_scores(docs.limit(0), labels).count() == 0


def test_cutoff_is_bounded_on_all_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model, table = Q._train(docs, labels, fit_rows=300)
    rest = table.filter("fitted is null and x is not null")
    n = rest.filter("x = 0 and q = 1").count()
    scores = Q.quality_scores(docs, labels, fit_rows=300).join(
        rest.select(table.id.alias("doc_id"), "q", "x"), "doc_id").filter("x = 0 and q = 1")
    assert n > 2500 and scores.count() == n
    # The bounds hold over all labelled documents, not over a few of the sample.
    lost = scores.filter("not keep").count()
    assert model.cutoff >= 0.5 or lost <= Q.MAX_FALSE_REJECTION * (n + 300)


def test_cutoff_weighs_good_against_toxic():
    good, toxic = np.zeros(Q.BINS + 1, int), np.zeros(Q.BINS + 1, int)
    good[9000], toxic[100] = 1000, 100
    assert Q._cutoff(good, toxic) == 0.5
    good[50] = 3  # odd good documents cannot pull it below the toxic ones
    assert Q._cutoff(good, toxic) == 0.0101
    good[50], good[3000] = 0, 50
    assert Q._cutoff(good, toxic) == 0.3
    toxic[6000] = 20  # at a half too many toxic ones stay, and good ones have room
    good[3000] = 0
    assert Q._cutoff(good, toxic) == 0.6001
    assert Q._cutoff(good, toxic * 0) == 0.5


def test_every_unlabelled_document_takes_part(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model, table = Q._train(docs, labels, rounds=1)
    pool = table.filter("q is null")
    # More documents get a label than the fixed pool of 2,000 ever held.
    assert 2000 < model.traded[-1][1] <= pool.count()
    # The sums that Spark takes are those of all rows at once.
    sure = [Q.Round([model.text, model.meta], [(0.9, 0.9), (0.8, 0.9)])]
    found = Q.unlabelled_sums(pool, model.telling, [model.text, model.meta], sure)
    rows = Q.views_of(pool.toArrow().combine_chunks().to_batches()[0], model.telling)
    for x, view, given, (n, sums) in zip(rows, [model.text, model.meta], Q.given_labels(rows, sure), found):
        assert n == (given >= 0).sum()
        assert np.allclose(sums, view.sums(x[given >= 0], given[given >= 0]), rtol=1e-6, atol=1e-6)
    assert found[1][0] > 0
