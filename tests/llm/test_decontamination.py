"""Decontamination against brute force."""

import random

from strata.llm import decontamination as D


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def corpus(seed, n_docs, sizes, edits):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(20)]
    vocab = common * 40 + [f"w{i}" for i in range(1500)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice(sizes)))) for i in range(40)]
    docs, planted = [], set()
    for d in range(n_docs):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 250))]
        if d % 2:
            i, text = rng.choice(items)
            part = text.split()
            for _ in range(int(edits * len(part))):
                at = rng.randrange(len(part))
                kind = rng.random()
                if kind < 0.4:
                    part[at] = rng.choice(vocab)
                elif kind < 0.7:
                    del part[at]
                else:
                    part.insert(at, rng.choice(vocab))
            at = rng.randint(0, len(words))
            words[at:at] = part
            planted.add((d, i))
        docs.append((d, " ".join(w.upper() if rng.random() < 0.1 else w for w in words) + "."))
    return items, docs, planted


def brute(items, docs):
    return {(d, i) for d, t in docs for i, x in items
            if D.words_of(x)
            and plain_distance(D.words_of(x), D.words_of(t)) <= D.allowed_edits(len(D.words_of(x)))}


def test_least_distance_is_exact():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 70))]
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 90))]
        assert D.least_distance(item, text)[0] == plain_distance(item, text)


def test_recall_and_precision():
    for sizes, edits, least in (((25, 40, 60), 0.0, 1.0), ((25, 40, 60), 0.1, 0.97), ((25, 40, 60), 0.19, 0.9),
                                ((12, 15, 21), 0.0, 1.0), ((12, 15, 21), 0.15, 0.9), ((5, 8, 11), 0.0, 1.0),
                                ((1, 2, 3, 4), 0.0, 1.0), ((22, 26, 30), 0.19, 0.9), ((5, 7, 10), 0.19, 0.9)):
        items, docs, planted = corpus(7, 160, sizes, edits)
        want = brute(items, docs)
        found = {(docs[row][0], item) for row, item, *_ in D.Index(items).search([t for _, t in docs])}
        assert found <= want
        assert len(found) >= least * len(want), (sizes, edits, len(found), len(want))


def test_short_items_exactly():
    """Items of one to four words: all places' firsts, equal to a plain search."""
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abcdefg") for _ in range(1 + i % 4))) for i in range(60)]
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))) for _ in range(150)] + ["", None, "z"]
    want = set()
    for row, text in enumerate(texts):
        words = D.words_of(text)
        for i, x in items:
            item = D.words_of(x)
            ends = [k + len(item) for k in range(len(words) - len(item) + 1) if words[k:k + len(item)] == item]
            if ends:
                want.add((row, i, 0, len(item), ends[0]))
    found = list(D.Index(items).search(texts))
    assert len(found) == len(set(found)) and set(found) == want
    assert {x[1] for x in D.Index(items, min_words=3).search(texts)} == {i for _, i, _, n, _ in want if n >= 3}


def test_defined_results(spark):
    items = [(1, "Alpha beta gamma delta epsilon zeta eta"), (2, "alpha, beta gamma delta epsilon zeta eta"),
             (3, None), (4, ""), (5, "too short"), (None, "one two three four five six")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    long_text = "filler " * 60000 + "alpha beta gamma delta epsilon zeta eta " + "filler " * 10
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, long_text, "c"), (3, long_text, "c"),
                                  (None, "x ONE two three four five six y", "d"), (4, "too short", "e")],
                                 "doc_id long, text string, item_id string")
    got = sorted((str(r["doc_id"]), str(r["item_id"]), r["distance"]) for r in D.leaks(docs, bench).collect())
    assert got == [("3", "1", 0), ("3", "1", 0), ("3", "2", 0), ("3", "2", 0), ("4", "5", 0), ("None", "None", 0)]
    left = D.drop_leaking(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2]
    assert sorted(r["doc_id"] for r in D.drop_leaking(docs, bench, min_words=3).collect()) == [1, 2, 4]
    assert D.leaks(docs.limit(0), bench).count() == 0
    assert D.leaks(docs, bench.limit(0)).count() == 0
    assert D.drop_leaking(docs, bench.limit(0)).count() == docs.count()
    small = sorted((str(r["doc_id"]), str(r["item_id"])) for r in D.leaks(docs, bench, block_bytes=40).collect())
    assert small == [x[:2] for x in got]
