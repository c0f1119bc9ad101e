"""Packing: every id in exactly one piece, gapless sequences, little padding."""

import random
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import packing as P
from tests.conftest import SF_ORACLE

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(5))
def test_differencing_keeps_items_and_balances(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 2047) for _ in range(400)]
    bins = P.karmarkar_karp(sizes, 80)  # five items a bin
    assert sorted(i for _, items in bins for i in items) == list(range(400))
    assert all(s == sum(sizes[i] for i in items) for s, items in bins)
    assert bins[-1][0] - bins[0][0] < 0.1 * sum(sizes) / 80


@pytest.mark.parametrize("sizes", [[], [1], [2047], [2047, 2047, 2], [1025, 1025], [1500] * 3, [1] * 5000])
def test_windows_hold_everything_once(sizes):
    windows = P.fill_windows(sizes, 2048)
    assert all(sum(n for _, _, n in w) <= 2048 for w in windows)
    seen = sorted((i, s, n) for w in windows for i, s, n in w)
    at = {}
    for i, s, n in seen:
        assert s == at.get(i, 0) and n > 0
        at[i] = s + n
    assert [at[i] for i in range(len(sizes))] == sizes


def check(rows, docs):
    lib = Tokenizer.from_file(PATH)
    want = {}
    for i, t in docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want[i] = b"".join(x.to_bytes(4, "little") for x in ids)
    got, sequences = {}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        so_far = got.get(r["doc_id"], b"")
        assert len(so_far) == 4 * r["start"] and r["length"] > 0
        got[r["doc_id"]] = so_far + bytes(r["ids"])
        assert r["length"] * 4 == len(r["ids"]) and r["doc_tokens"] * 4 == len(want[r["doc_id"]])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
        padding += 2048 - at
    return padding / (2048 * len(sequences)) if sequences else 0


def test_pack_documents(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = P.pack(docs, PATH).collect()
    assert check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()]) < 0.01


def test_odd_texts(spark):
    data = [(1, None, "a"), (2, "", "b"), (3, "word " * 30000, "c"), (4, "tie", "d"), (5, "tie", "e"),
            (6, "<|endoftext|> x", "f")]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids string").coalesce(1)
    check(P.pack(docs, PATH).collect(), [(i, t) for i, t, _ in data])
    assert P.pack(docs.limit(0), PATH).count() == 0
    twice = P.pack(spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string"), PATH).collect()
    assert len(twice) == 2 and all(zlib.crc32(bytes(r["ids"])) for r in twice)
