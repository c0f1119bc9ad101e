"""SimHash by Golay keys against brute force."""

import random

import numpy as np
import pytest
import xxhash

from strata.llm import simhash_golay as S


def brute_fingerprint(text):
    ws = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
          .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ")
          .split(" ") if w]
    if not ws:
        return 0
    shingles = [" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=4):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_golay_words_two_bits_apart_share_a_key():
    rng = random.Random(1)
    words = [rng.getrandbits(23) for _ in range(4000)]
    other = [w ^ sum(1 << b for b in rng.sample(range(23), rng.randint(0, 2))) for w in words]
    a, na = S.golay_keys(np.array(words, dtype=np.int64))
    b, nb = S.golay_keys(np.array(other, dtype=np.int64))
    assert all(set(x[:n]) & set(y[:m]) for x, n, y, m in zip(a.tolist(), na, b.tolist(), nb))
    assert set(na.tolist()) == {1, 6}


def test_fingerprints_four_bits_apart_share_a_key():
    rng = random.Random(2)
    for bits in range(5):
        fp = [rng.getrandbits(64) for _ in range(1500)]
        near = [f ^ sum(1 << b for b in rng.sample(range(64), bits)) for f in fp]
        seen = {}
        key, whose = S.bucket_keys(np.array(fp, dtype=np.uint64))
        for k, f in zip(key.tolist(), whose.tolist()):
            seen.setdefault(k, set()).add(f)
        key, whose = S.bucket_keys(np.array(near, dtype=np.uint64))
        found = set()
        for k, f in zip(key.tolist(), whose.tolist()):
            found.update((g, f) for g in seen.get(k, ()))
        assert all(pair in found for pair in zip(fp, near))


@pytest.mark.parametrize("seed", range(4))
def test_group_links_connect_what_is_near(seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = {0}
    for c in centres:
        for _ in range(60):
            prints.add(c ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 9))))
    prints = sorted(prints)
    joined = S.Joined()
    links = list(S.links_in_group(np.array(prints, dtype=np.uint64), joined))
    assert len(links) < len(prints)
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    want = brute_components(prints)
    groups = {}
    for p, w in zip(prints, want):
        groups.setdefault(w, set()).add(joined.root(p))
    roots = [next(iter(g)) for g in groups.values()]
    assert all(len(g) == 1 for g in groups.values()) and len(set(roots)) == len(roots)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"W{i}" for i in range(300)]
    texts = ["", None, " \t\n", "one", "One", "two words", "two  words", "É é", "a b c d"]
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randint(60, 200))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy))
    texts.append("long " * 30000 + "end")
    rows = [(i * 7 % 1009, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {r["doc_id"]: r for r in S.near_duplicates(docs).collect()}
    prints = [brute_fingerprint(t) for _, t, _ in rows]
    comp = brute_components(prints)
    smallest = {}
    for (i, _, _), c in zip(rows, comp):
        smallest[c] = min(smallest.get(c, i), i)
    assert len(got) == len(rows)
    for (i, _, _), f, c in zip(rows, prints, comp):
        assert got[i]["fp"] % 2 ** 64 == f
        assert got[i]["component_id"] == smallest[c]
    left = S.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(smallest.values())


def test_empty_table_nulls_and_repeated_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).count() == 0
    assert S.keep_one(docs).count() == 0
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (4, "x y z q"),
                                  (4, "other text it is"), (None, "alone here")], "doc_id long, text string")
    got = S.near_duplicates(docs).collect()
    assert len(got) == 7
    assert {r["component_id"] for r in got if r["doc_id"] == 3} == {3}
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in S.keep_one(docs).collect())
    assert kept == [(False, 3, "a b c"), (False, 4, "other text it is"), (False, 4, "x y z q"), (True, 0, "alone here")]


def test_one_row_stays_of_near_copies_with_equal_or_no_ids(spark):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(300)]

    def copies(n):
        """Texts with different fingerprints that are at most four bits apart."""
        found = {}
        base = [rng.choice(vocab) for _ in range(400)]
        found[brute_fingerprint(" ".join(base))] = " ".join(base)
        first = next(iter(found))
        while len(found) < n:
            copy = list(base)
            copy[rng.randrange(400)] = rng.choice(vocab)
            fp = brute_fingerprint(" ".join(copy))
            if (fp ^ first).bit_count() <= 4:
                found[fp] = " ".join(copy)
        return list(found.values())

    same_id, no_id, mixed = copies(3), copies(3), copies(2)
    rows = [(8, t) for t in same_id] + [(None, t) for t in no_id] + [(None, mixed[0]), (9, mixed[1]), (9, mixed[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = S.keep_one(docs).collect()
    signed = lambda t: (brute_fingerprint(t) + 2 ** 63) % 2 ** 64 - 2 ** 63
    want = [(8, min(same_id, key=signed)), (None, min(no_id, key=signed)), (9, mixed[1])]
    assert sorted(map(str, left)) == sorted(str(docs.sparkSession.createDataFrame([w], docs.schema).first()) for w in want)
