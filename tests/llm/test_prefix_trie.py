"""Conversation trie against a trie built turn by turn, odd rows, deep and wide tries."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import prefix_trie as P


def expected(rows, heads=True):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    convs = {c: [x[3] for x in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 6 if heads else 0
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(convs.get(base, [])[:h] + ts[h:])
    members, ends = {}, {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
        ends.setdefault(ts, []).append(c)
    children, saved, leaves = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, cs in members.items():
        own = (len(cs) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += node not in children
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(repr((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), children.get(n, 0), leaves[n],
                        saved[n], sha(ends.get(n, [])))) for n, cs in members.items())


def check(spark, rows):
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, key int, n string")
    assert sorted(repr(tuple(r)) for r in P.conversation_trie(df).collect()) == expected(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 450), 150):
        for t in range(rng.choice((1, 2, 3, 5, 8, 12))):
            rows.append((c, t, rng.choice(("user", "assistant", None)), rng.choice(("a", "bb", "é日本", "", None))))
    rng.shuffle(rows)
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(5, None, "user", "first"), (5, 0, "user", "second"), (5, 0, "user", "second"), (5, 0, "assistant", "tie"),
            (100, 1, None, None), (205, 1, "user", "x"), (205, 2, "user", "y"), (None, 0, "user", "lost"),
            (300, 0, "ab", "c"), (301, 0, "a", "bc"), (2**40, 0, "user", "far"), (7, 0, "user", "w " * 200_000)]
    check(spark, rows)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert P.conversation_trie(empty).collect() == []


def test_only_turnless(spark):
    """Ids whose heads swallow all their turns and whose stride has no first conversation."""
    ids = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1]
    check(spark, [(c, 0, "user", f"t{c}") for c in ids])


def test_deep_and_equal(spark):
    """A comb of 60 turns with a conversation ending and branching at every depth, and copies."""
    rows = []
    for c in range(60):
        rows += [(c * 100, t, "user", f"t{t}") for t in range(c + 1)]
        rows += [(c * 100 + 6000, t, "user", f"t{t}") for t in range(c)] + [(c * 100 + 6000, c, "user", "leaf")]
    rows += [(20_000 + 100 * c, t, "user", f"t{t}") for c in range(30) for t in range(40)]
    check(spark, rows)


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", P.two_fattest("a", "b").alias("f"))
    for a, b, f in df.collect():
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_general_strings(spark):
    """Without shared heads: the operator takes any strings."""
    rows = [(c, t, "u", "ab"[(c >> t) & 1]) for c in range(64) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(repr(tuple(r)) for r in P.trie(P.strings(df)).collect())
    assert got == expected(rows, heads=False)
    assert P.trie(P.strings(df)).agg(F.max("n_leaves")).first()[0] == 64
