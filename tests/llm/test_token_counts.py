"""Token counts against the tokenizers library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import token_counts as C
from tests.conftest import SF_ORACLE

PATH = public_tokenizers.path("byte_bpe_50k.json")

ODD = ["", None, " ", "  ", "a  b", "a \n b", "\n\n x\t y ", "x<|endoftext|> y", "foo  <|endoftext|>  bar",
       "<|endoftext|><|endoftext|>", "é ́a", "a\x1cb \x1d c", "don't I'LL 's ''s", "\xa0 a\xa0b", "ΑΣ ΟΔΟΣ",
       "日本語 テスト", "İstanbul", "tail  ", "　　z", "aaaa aaaaa aaaaaaa", "!!!!!!!!! $$$$", "x" * 5000,
       "ab" * 3000, "word " * 30000, "1234567890" * 50, "🙂🙃 🙂", "tie", "tie"]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def test_odd_texts(lib):
    got = C.Counter(PATH).counts(ODD)
    assert got == [len(lib.encode(t or "", add_special_tokens=False).ids) for t in ODD]


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(lib, seed):
    rng = random.Random(seed)
    alphabet = "abcdeEST tion   \n\t.,'!$0123éßñ日 ́"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) for _ in range(300)]
    assert C.Counter(PATH).counts(texts) == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]


def test_all_documents(spark, lib):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in C.token_counts(docs, PATH).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, t in rows:
        n = len(lib.encode(t, add_special_tokens=False).ids)
        assert got[i] == (len(t.encode()), n, n > 512)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (1, None, 0), (None, "a", 0)], "doc_id long, text string, n_tokens int")
    got = sorted(str(tuple(r)) for r in C.token_counts(docs, PATH).collect())
    assert got == ["(1, 0, 0, False)", "(1, 0, 0, False)", "(None, 1, 1, False)"]
    assert C.token_counts(docs.limit(0), PATH).count() == 0
