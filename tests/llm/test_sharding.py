"""Extendible hashing: every shard fits, names are the shortest prefixes that fit."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import sharding as S
from tests.conftest import SF_ORACLE


def brute(rows, limit):
    """(id, key bits, bytes) -> id -> shard, by splitting buckets one bit at a time."""
    out, todo = {}, [("", rows)]
    while todo:
        name, bucket = todo.pop()
        if sum(b for *_, b in bucket) <= limit or len(bucket) == 1:
            out.update((i, name) for i, *_ in bucket)
            continue
        for bit in "01":
            part = [r for r in bucket if r[1][len(name)] == bit]
            if part:
                todo.append((name + bit, part))
    return out


@pytest.mark.parametrize("limit", [4_000, 40_000, 1 << 30])
def test_equals_splitting_bit_by_bit(spark, limit):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = {r["doc_id"]: r for r in S.assign_shards(docs, limit_bytes=limit).collect()}
    rows = [(r["doc_id"], format(r["h"] % 2 ** 64, "064b"), r["b"]) for r in docs.select(
        "doc_id", F.xxhash64("doc_id").alias("h"), F.octet_length("text").alias("b")).collect()]
    want = brute(rows, limit)
    assert {i: r["shard"] for i, r in got.items()} == want
    assert all(len(r["shard"]) == r["depth"] for r in got.values())


def test_one_key_with_a_third_of_all_rows_splits(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        F.lit("x" * 100).alias("text"), F.lit(1).alias("shard"))
    rows = S.assign_shards(docs, limit_bytes=10_000).collect()
    size = defaultdict(int)
    for r in rows:
        size[r["shard"]] += r["n_bytes"]
    assert len(rows) == 3000 and max(size.values()) <= 10_000
    assert sum("." in r["shard"] for r in rows if r["doc_id"] == 7) == 1001  # 7 itself and every third row
    listed = S.directory(S.assign_shards(docs, limit_bytes=10_000)).collect()
    assert sum(r["n_rows"] for r in listed) == 3000


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (None, "a"), (1, ""), (2, "b" * 500), (2, "b" * 500)],
                                 "doc_id long, text string")
    rows = S.assign_shards(docs, limit_bytes=100).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"]) for r in rows) == [(0, 0), (0, 1), (1, 0), (2, 500), (2, 500)]
    assert len({r["shard"] for r in rows if r["doc_id"] == 2}) == 2
    assert S.assign_shards(docs.limit(0)).count() == 0
