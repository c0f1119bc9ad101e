"""N-gram Jaccard join against all pairs, odd rows, families of near copies."""

import random
import re

import numpy as np
import pytest

from strata.llm import ngram_jaccard as J

UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k=5):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UPPER)) if w]
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1)))


def expected(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root(i)] = min(doc_id, ids.get(root(i), doc_id))
    return sorted(repr((d, len(sets[i]), ids.get(root(i)))) for i, (d, _) in enumerate(rows))


def check(spark, rows, parts=4, **settings):
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, v long, n string")
    got = sorted(repr(tuple(r)) for r in J.jaccard_components(docs.repartition(parts), **settings).collect())
    assert got == expected(rows, settings.get("percent", 80))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words))
        words[i] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("cells", [1 << 4, 1 << 20])
def test_families_and_odd_rows(spark, cells):
    rng = random.Random(cells)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(12):  # families of near copies, edited by less and more than the limit
        base = [rng.choice(vocabulary) for _ in range(rng.choice((6, 20, 90, 200)))]
        rows += [edited(rng, base, rng.choice((0, 0, 1, 1, 2, 3, 4, 6))) for _ in range(rng.randrange(1, 9))]
    rows += [" ".join(passage + [rng.choice(vocabulary) for _ in range(k)]) for k in (0, 5, 10, 12, 13, 14, 15, 16, 18, 40, 80)]
    rows += ["", None, " \t\n", "one", "One", "ONE  ", "a b", "a b c d", "a b c d e", "A b c d e f", "É b c d e", "é b c d e",
             "x\x0by\x0cz", "x y z", "rep " * 50, "rep " * 500]
    rows = [(i, t) for i, t in enumerate(rows)]
    rows += [(7, rows[3][1]), (None, rows[3][1]), (None, None), (None, "only null"), (4, "tie tie"), (4, "tie tie")]
    rng.shuffle(rows)
    check(spark, rows, cells=cells)


def test_a_large_family(spark):
    """Hundreds of different near copies: one component through stars."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = [(1000 + i, edited(rng, base, rng.randrange(5))) for i in range(400)]
    rows += [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(80))) for i in range(50)]
    check(spark, rows)


def test_limits_exactly(spark):
    """Pairs at 80 and just under 80 per cent: 8 of 10 shingles, 4 of 5, 79 of 99."""
    def text(n, tag, start=0):
        return " ".join(f"{tag}{i}" for i in range(start, start + n + 4))
    rows = [(1, text(9, "a")), (2, text(9, "a", 1)),   # 8 of 10
            (3, text(8, "b")), (4, text(8, "b", 1)),   # 7 of 9
            (5, text(89, "c")), (6, text(89, "c", 10)),  # 79 of 99
            (7, text(90, "d")), (8, text(90, "d", 10)),  # 80 of 100
            (9, text(4, "e")), (10, text(5, "e"))]     # 4 of 5
    check(spark, rows)
    check(spark, rows, percent=75)


def test_empty_table(spark):
    assert J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_adaptive_prefix():
    hashes = np.arange(100, dtype=np.uint64)
    rare, common = np.ones(100, np.uint32), np.full(100, 5000, np.uint32)
    few, prefix = J.adaptive_prefix(hashes, rare, 1, 80)
    assert 1 <= few <= J.MAX_MATCHES and len(prefix) == 20 + few
    steep = np.where(hashes < 21, 1, 10**6).astype(np.uint32)  # one more shingle would cost a million postings
    assert J.adaptive_prefix(hashes, steep, 1, 80)[0] == 1
    assert J.adaptive_prefix(hashes, common, 1, 80)[0] > 1
    assert J.adaptive_prefix(hashes[:1], rare[:1], 1, 80)[0] == 1
