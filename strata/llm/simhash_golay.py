"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments (22, 21 and 21 bits), each of two
halves.  If two fingerprints differ in at most four bits, the six halves share at
most four errors, and then two halves are equal and a segment beside them has at
most two errors:

* some segment is free of errors (both its halves are equal), and the smaller
  error count of the other two is at most two; or
* every segment has an error, so two of them have exactly one (one half of each is
  equal) and the third has at most two.

A segment with at most two errors is found by the [23, 12, 7] Golay code: decoded
to the codewords within distance four (one, or six if the nearest is at distance
three), any two words that differ in at most two bits share a codeword.  So a key
is (two equal halves, codeword index of a third segment): 18 ways, one or six
keys each, 33 bits or more.  Keys are made of distinct fingerprints only, rows of
equal key are brought together, and the members of a key are compared exactly.

From a group of equal key only links that join parts not yet joined in the same
task go on; which fingerprints hang together is the same, and a large group of
near copies never becomes all its pairs.  Components come from alternating
large-star and small-star steps on tables in the shared folder.

Defined results: null and empty texts have fingerprint zero and are linked like
any other; repeated rows and ids keep their own rows; a null id takes part, but a
component's id is its smallest id that is not null (null if there is none);
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import free_name, release, stage

SHINGLE_WORDS = 4
MAX_BITS = 4
# Seed of the shingle hash, generator polynomial of the Golay code.
SEED = 42
GOLAY_POLYNOMIAL = 0xC75
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash: per bit the majority of the shingles' XXH64."""
    import xxhash
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    if len(ws) <= words:
        return xxhash.xxh64_intdigest(b" ".join(ws), SEED)
    line = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(ws) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    stops = ends[words - 1:].tolist()
    for at in range(0, n, 65536):
        part = [digest(line[s:e], SEED) for s, e in zip(starts[at:at + 65536], stops[at:at + 65536])]
        bits = np.unpackbits(np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str, name: str, words: int = SHINGLE_WORDS) -> DataFrame:
    # Arrow texts become Python strings one by one, not a whole batch of them at once.
    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        release()
        return _signed([fingerprint(t.as_py(), words) for t in texts])

    return docs.withColumn(name, of(F.col(text_col)))


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By rule: the syndrome of every 12-bit data part, and per syndrome the masks
    that turn a word's data part into its codeword indices (1 or 6 are valid)."""
    def remainder(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY_POLYNOMIAL << (bit - 11)
        return x

    parity = np.array([remainder(d << 11) for d in range(4096)], dtype=np.int64)
    errors: list[list[int]] = [[] for _ in range(2048)]
    unit = [remainder(1 << b) for b in range(23)]
    for a in range(23):
        errors[unit[a]].append(1 << a)
        for b in range(a):
            errors[unit[a] ^ unit[b]].append(1 << a | 1 << b)
            for c in range(b):
                errors[unit[a] ^ unit[b] ^ unit[c]].append(1 << a | 1 << b | 1 << c)
                for d in range(c):
                    errors[unit[a] ^ unit[b] ^ unit[c] ^ unit[d]].append(1 << a | 1 << b | 1 << c | 1 << d)
    errors[0].append(0)
    masks, count = np.zeros((2048, 6), dtype=np.int64), np.ones(2048, dtype=np.int64)
    for s, es in enumerate(errors):
        nearest = min(e.bit_count() for e in es)
        use = [e for e in es if e.bit_count() == nearest or nearest == 3 and e.bit_count() == 4]
        count[s] = len(use)
        masks[s, :len(use)] = [e >> 11 for e in use]
        masks[s, len(use):] = masks[s, 0]
    return parity, masks, count


_GOLAY: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def golay_keys(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) codeword indices of 23-bit words, and how many of each row are valid."""
    if not _GOLAY:
        _GOLAY.append(golay_tables())
    parity, masks, count = _GOLAY[0]
    data = segment >> 11
    syndrome = parity[data] ^ (segment & 2047)
    return data[:, None] ^ masks[syndrome], count[syndrome]


def bucket_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (key, fingerprint) rows of distinct unsigned fingerprints."""
    seg = [((fp >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    halves = [[s & 2047, s >> 11] for s in seg]  # 11 and 10 or 11 bits
    coded = [golay_keys(s) for s in seg]
    ways = [((i, 0), (i, 1), j) for i in range(3) for j in range(3) if i != j]
    ways += [((i, a), (j, b), k) for i, j, k in ((0, 1, 2), (0, 2, 1), (1, 2, 0)) for a in (0, 1) for b in (0, 1)]
    keys, whose = [], []
    for way, ((i, a), (j, b), k) in enumerate(ways):
        index, count = coded[k]
        base = (halves[i][a] << 11 | halves[j][b]) << 12
        for c in range(6):
            rows = np.flatnonzero(count > c)
            keys.append((base[rows] | index[rows, c]) << 5 | way)
            whose.append(fp[rows])
    return np.concatenate(keys), np.concatenate(whose)


class Joined:
    """Union-find over fingerprints of one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while (y := up.get(x, x)) != top:
            up[x] = top
            x = y
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def links_in_group(group: np.ndarray, joined: Joined, bits: int = MAX_BITS) -> Iterator[tuple[int, int]]:
    """Links (pairs at most ``bits`` apart) that join all that hangs together in
    ``group`` (distinct unsigned fingerprints), as far as not yet joined."""
    if len(group) == 2:
        a, b = int(group[0]), int(group[1])
        if (a ^ b).bit_count() <= bits and joined.join(a, b):
            yield a, b
        return
    # Leaders: everything near a leader hangs on it; the rest find leaders of their own.
    rest, parts = group, []
    while len(rest):
        near = np.bitwise_count(rest ^ rest[0]) <= bits
        part = rest[near]
        lead = int(part[0])
        for x in part[1:].tolist():
            if joined.join(lead, x):
                yield lead, x
        parts.append(part)
        rest = rest[~near]
    leads = np.array([p[0] for p in parts], dtype=np.uint64)
    for i, part in enumerate(parts[:-1]):
        # Members of two parts can only be near if their leaders are within 3 x bits.
        for j in (np.flatnonzero(np.bitwise_count(leads[i + 1:] ^ leads[i]) <= 3 * bits) + i + 1).tolist():
            if joined.root(int(leads[i])) == joined.root(int(leads[j])):
                continue
            for x in part:
                hit = np.flatnonzero(np.bitwise_count(parts[j] ^ x) <= bits)
                if len(hit):
                    a, b = int(x), int(parts[j][hit[0]])
                    if joined.join(a, b):
                        yield a, b
                    break


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64), pa.int64())


def near_links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) over the distinct fingerprints of column ``fp`` that connect
    exactly what the links at most ``bits`` <= 4 apart connect."""
    if bits > MAX_BITS:
        raise ValueError(f"the keys find at most {MAX_BITS} differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 4096):
                key, whose = bucket_keys(fp[at:at + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), _signed(whose)], ["key", "fp"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        joined = Joined()
        open_key, open_group = None, []

        def groups(key: np.ndarray, fp: np.ndarray):
            """Groups of two or more that end in this batch; the last one stays open."""
            nonlocal open_key, open_group
            cuts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            if open_group and key[0] == open_key:
                open_group.append(fp[:cuts[1]])
                if len(cuts) == 2:
                    return
                cuts = cuts[1:]
            if open_group and sum(map(len, open_group)) > 1:
                yield np.concatenate(open_group)
            sizes = np.diff(cuts)
            for i in np.flatnonzero(sizes[:-1] > 1).tolist():
                yield fp[cuts[i]:cuts[i + 1]]
            open_key, open_group = key[-1], [fp[cuts[-2]:].copy()]

        def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([_signed([x for x, _ in found]), _signed([y for _, y in found])],
                                              ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                key = batch.column(0).to_numpy(zero_copy_only=False)
                fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
                found = [x for g in groups(key, fp) for x in links_in_group(g, joined, bits)]
                if found:
                    yield batch_of(found)
        if sum(map(len, open_group)) > 1:
            found = list(links_in_group(np.concatenate(open_group), joined, bits))
            if found:
                yield batch_of(found)

    # Some ninety rows come of each fingerprint: spread them before, not after.
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = prints.select("fp").repartition(n, "fp").mapInArrow(keyed, "key long, fp long")
    together = keys.repartition("key").sortWithinPartitions("key")
    return together.mapInArrow(linked, "a long, b long").distinct()


def star_components(links: DataFrame) -> DataFrame:
    """(v, root) for every vertex that is not its component's smallest: alternating
    large-star and small-star steps until every link is a star's."""
    both = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v"))
    swap = lambda e: e.select(F.col("b").alias("u"), F.col("a").alias("v"))
    state = links
    while True:
        around = both(state).unionByName(swap(state))
        low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        state_l = stage(large, "large-star")
        down = state_l.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")) \
            .unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        state = stage(small, "small-star")
        # A forest of stars: nobody is both a leaf and a root, and a leaf has one root.
        leaves = state.agg(F.count("*").alias("n"), F.countDistinct("a").alias("d")).first()
        if leaves["n"] == leaves["d"] and state.join(state.select(F.col("b").alias("a")).distinct(), "a",
                                                     "left_semi").isEmpty():
            return state.select(F.col("a").alias("v"), F.col("b").alias("root"))


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(id, ``fp``) per document, and per fingerprint (``fp``, ``first_id``, ``root``,
    ``component_id``): its smallest id and its component's root and smallest id."""
    prints = stage(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                                    "text", "fp", words).select("id", "fp"), "fingerprints")
    # Equal fingerprints are one vertex, whatever number of documents share it.
    vertices = stage(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "vertices")
    links = stage(near_links(vertices, bits), "links")
    root: Column = F.coalesce(F.col("root"), F.col("fp"))
    if links.isEmpty():
        classes = vertices.select("fp", "first_id", F.col("fp").alias("root"), F.col("first_id").alias("component_id"))
    else:
        stars = star_components(links)
        placed = stage(vertices.join(stars, F.col("fp") == F.col("v"), "left")
                       .select("fp", "first_id", root.alias("root")), "placed")
        smallest = stage(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
        classes = stage(placed.join(smallest, "root").select("fp", "first_id", "root", "component_id"), "classes")
    return prints, classes


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **settings) -> DataFrame:
    """One row per document: id, ``fp`` (long), ``component_id``."""
    prints, classes = components(docs, id_col=id_col, **settings)
    return prints.join(classes.select("fp", "component_id"), "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
             bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: of the smallest id (null only if there is
    no other), then of the smallest fingerprint; any one of rows equal in both."""
    prints, classes = components(docs, id_col=id_col, text_col=text_col, words=words, bits=bits)
    own, won, fp = (free_name(docs, name) for name in ("_id", "_won", "_fp"))
    if prints.groupBy("id").count().filter("count > 1").isEmpty():
        state = prints.join(classes.select("fp", "component_id"), "fp")
        losers = state.filter(~F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias(own))
        return docs.join(stage(losers, "losers"), F.col(id_col).eqNullSafe(F.col(own)), "left_anti")
    first = F.min(F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id").alias("id"), "fp"))
    winners = stage(classes.groupBy("root").agg(first.alias("w"))
                    .select(F.col("w.id").alias(own), F.col("w.fp").alias(won)), "winners")
    printed = with_fingerprint(docs, text_col, fp, words)
    return printed.join(winners, F.col(id_col).eqNullSafe(F.col(own)) & (F.col(fp) == F.col(won)),
                        "left_semi").dropDuplicates([id_col, fp]).drop(fp)
