"""Fill-in-middle against unit-by-unit rules, odd rows and long texts."""

import hashlib
import re

import pytest

from strata.llm import fill_in_middle as M
from tests.conftest import SF_ORACLE

ODD = ["", None, "a", "é", "ab", "a b", "\n\n", "x<P>y", "<S>", "tail <", "<S", "S>", "no <M marks", "A" * 1000,
       "aé" * 500, "日本 語 text\r\nline", "word " * 400, "P><", "<<", "\x00 a\x0b", "tie", "tie"]


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(spark, rows, **settings):
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, n long, output int")
    out = M.fill_in_middle(docs, **settings)
    got = [tuple(r) for r in out.withColumn("back", M.restored()).collect()]
    want = [(i, *expected(i, t), t or "") for i, t in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return got


@pytest.mark.parametrize("block", [1, 7, 64, M.BLOCK_CHARS])
def test_odd_rows(spark, block):
    rows = [(i, t) for k, t in enumerate(ODD) for i in (k, 1000 + k, 7)] + [(None, "a b c"), (None, None), (-5, "x y z")]
    got = check(spark, rows, block_chars=block)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_text_ids(spark):
    assert M.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    row = M.fill_in_middle(spark.createDataFrame([("k1", "one two")], "doc_id string, text string")).first()
    assert tuple(row) == ("k1", *expected("k1", "one two"))


def test_a_very_long_text(spark):
    text = "Some wörds, and\n" * 300_000 + "z" * 400_000 + " end"  # 5.2 million characters
    check(spark, [(3, text), (4, "short one")])


def test_all_documents(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: tuple(r)[1:] for r in M.fill_in_middle(docs).withColumn("back", M.restored()).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i] == (*expected(i, t), t or "")
