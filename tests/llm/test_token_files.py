"""Binary token files: exact round trip."""

import json
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strata.llm import token_files as B
from tests.conftest import SF_ORACLE

PATH = public_tokenizers.path("byte_bpe_50k.json")


def want(rows):
    lib = Tokenizer.from_file(PATH)
    start, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_all_documents(spark, scratch):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    manifest = B.write_token_files(docs, scratch, PATH)
    got = [tuple(r) for r in B.read_token_files(spark, scratch).orderBy("doc_id").collect()]
    assert got == want([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert manifest["width"] == 2 and manifest["ids"] == sum(r[2] for r in got)
    flat = np.concatenate([np.fromfile(f"{scratch}/ids-{s['shard']:06d}.bin", "<u2") for s in manifest["shards"]])
    assert len(flat) == manifest["ids"] and json.load(open(f"{scratch}/manifest.json")) == manifest


def test_odd_rows(spark, scratch):
    rows = [(5, None), (3, ""), (None, "no id"), (9, "x <|endoftext|> y"), (4, "long  " * 20000), (7, "tie"), (7, "tie")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, start string")
    B.write_token_files(docs, scratch, PATH)
    got = sorted((tuple(r) for r in B.read_token_files(spark, scratch).collect()), key=lambda r: r[1])
    assert got == want(rows)


def test_empty_table(spark, scratch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert B.write_token_files(docs, scratch, PATH)["shards"] == []
    assert B.read_token_files(spark, scratch).count() == 0
