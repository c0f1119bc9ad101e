"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A text's set is its distinct word shingles; two texts link if their sets are at least
``percent`` alike.  All shingles have one global order, rarest first.  If two sets share
at least ``o`` shingles, then for every ``l <= o`` their prefixes of ``size - o + l``
shingles share at least ``l`` of them.  A short prefix (``l = 1``) means few postings but
many false candidates, a longer one more postings and fewer candidates.  So every text
chooses its own ``l``: for each one the postings to read and the candidates to verify
(at most the postings divided by ``l``) are estimated from the shingles' frequencies, and
the cheapest ``l`` lengthens the prefix.  A pair must then share as many prefix shingles
as the smaller ``l`` of the two asks for before it is verified on the whole sets.

1. Frequencies: a count sketch of fixed size (``SKETCH_CELLS``) over all shingles of all
   texts, summed in Spark.  It only orders shingles and estimates costs; links are exact.
2. Prints: per document a 128-bit digest of its words, the size of its set, ``l`` and the
   prefix.  Equal word sequences are one vertex, whatever number of documents share them.
3. Postings (shingle, vertex) that no other vertex shares are dropped after one shuffle;
   so are vertices that share too few prefix shingles to reach any partner.
4. Stars: every posting list gives pairs of its most central vertex (that with the most
   shared postings) with its others, one per member.  Verified links join vertices, so a
   large family of near copies becomes one part without its pairs ever being formed.
5. The rest: in lists that still hold several parts, members of different parts meet if
   the shingle is in both one-match prefixes, and are verified if their whole prefixes
   share enough.  In lists of more than ``LONG_LIST`` parts that count is taken while the
   members meet, so a crowded list gives no pairs but those to verify.

So which texts hang together is the same as with all links; pairs inside a part that is
already joined are not formed.  Components come from alternating star steps.

Shingles are compared by 64-bit hashes of their words: two different shingles of one pair
of sets of 1,000 are taken for equal with a probability below 1e-13.

Defined results: null texts, empty texts and texts without words have size 0 and link with
nothing, each is its own component; fewer words than a shingle are one shingle; repeated
rows and ids keep their own rows; a component's id is its smallest id that is not null
(null if there is none); further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import stage
from strata.llm.simhash_golay import star_components

SHINGLE_WORDS = 5
PERCENT = 80
#: Cells of the frequency sketch (4 bytes each): the broadcast's size, however large the corpus.
SKETCH_CELLS = 1 << 20
SKETCH_BLOCK = 1 << 12
#: The most shared prefix shingles that a pair may have to show.
MAX_MATCHES = 8
#: Cost of verifying one shingle, in postings read.
VERIFY_COST = 0.05
#: Lists of more parts count a pair's shared shingles before they form the pair (speed only).
LONG_LIST = 16
#: Memory of a worker: hashes of words, digests seen in a task (more only cost work).
MAX_WORDS = 200_000
MAX_SEEN = 200_000
SEED = 7


class Shingler:
    """Sets of 64-bit shingle hashes; the words' own hashes are kept in two generations."""

    def __init__(self, words: int):
        rng = np.random.default_rng(SEED)
        self.odd = rng.integers(1, 1 << 63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.new: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def _known(self, words: list[bytes]) -> dict[bytes, int]:
        from xxhash import xxh64_intdigest
        if len(self.new) > MAX_WORDS:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        for w in set(words).difference(new):
            h = old.get(w)
            new[w] = xxh64_intdigest(w, SEED) if h is None else h
        return new

    def words(self, text: str | None) -> list[bytes]:
        return (text or "").encode("utf-8", "surrogatepass").lower().split()

    def occurrences(self, words: list[bytes]) -> np.ndarray:
        """Every shingle's hash, repeats included."""
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self._known(words).__getitem__, words), np.uint64, len(words))
        k = min(len(words), len(self.odd))
        out = h[:len(h) - k + 1] * self.odd[0] + np.uint64(k)
        for i in range(1, k):
            out += h[i:len(h) - k + 1 + i] * self.odd[i]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        return out

    def shingles(self, words: list[bytes]) -> np.ndarray:
        return np.unique(self.occurrences(words))


def cell_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    return (hashes >> np.uint64(65 - cells.bit_length())).astype(np.int64)


def shared_least(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with any partner, at least."""
    return -(-percent * n // 100)


def frequencies(docs: DataFrame, text_col: str, words: int, cells: int = SKETCH_CELLS) -> np.ndarray:
    """Occurrences of shingles per cell of the sketch, over all texts."""
    block_cells = min(SKETCH_BLOCK, cells)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total = Shingler(words), np.zeros(cells, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                texts = batch.column(0).slice(at, 512).to_pylist()
                parts = [cell_of(shingler.occurrences(shingler.words(t)), cells) for t in texts]
                total += np.bincount(np.concatenate(parts), minlength=cells)
        blocks = total.reshape(-1, block_cells)
        used = np.flatnonzero(blocks.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array([blocks[b].tobytes() for b in used], pa.binary())], ["block", "n"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, n in zip(*(c.to_pylist() for c in batch.columns)):
                totals[block] = totals.get(block, 0) + np.frombuffer(n, np.int64)
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int64()), pa.array([n.tobytes() for n in totals.values()], pa.binary())],
                ["block", "n"])

    parts = docs.select(F.col(text_col).alias("t")).mapInArrow(counted, "block long, n binary")
    # The driver gets one row per block of cells: a fixed size.
    rows = parts.repartition("block").mapInArrow(summed, "block long, n binary").collect()
    out = np.zeros((cells // block_cells, block_cells), np.int64)
    for block, n in rows:
        out[block] = np.frombuffer(n, np.int64)
    return np.minimum(out.reshape(-1), (1 << 32) - 1).astype(np.uint32)


def adaptive_prefix(hashes: np.ndarray, counts: np.ndarray, floor: int, percent: int) -> tuple[int, np.ndarray]:
    """(matches asked for, prefix) of a set: ``counts`` are its shingles' cells,
    ``floor`` what a cell holds of other shingles on the average."""
    n = len(hashes)
    least = shared_least(n, percent)
    top = min(MAX_MATCHES, least)
    order = np.argsort(counts, kind="stable")[:n - least + top]  # hashes are ascending: ties by hash
    cost = np.cumsum(np.maximum(counts[order].astype(np.float64) - floor, 1.0))
    matches = np.arange(1, top + 1)
    reads = cost[n - least + matches - 1]
    ell = int(np.argmin(reads * (1 + VERIFY_COST * n / matches))) + 1
    return ell, hashes[order[:n - least + ell]]


def _prints(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, sketch) -> DataFrame:
    """Staged: row, id, text_hash, d1, d2 (digest of the words), n, ell, prefix."""

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        shingler, cells = Shingler(words), sketch.value
        floor, seen = int(cells.mean()), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                digests, sizes, ells, prefixes = [], [], [], []
                for text in part.column(2).to_pylist():
                    ws = shingler.words(text)
                    hashes = shingler.shingles(ws)
                    digest = xxh3_128_digest(b" ".join(ws), SEED)
                    ell, prefix = 0, hashes[:0]
                    # A text met before in this task is a copy: its prefix is not needed again.
                    if len(hashes) and digest not in seen:
                        ell, prefix = adaptive_prefix(hashes, cells[cell_of(hashes, len(cells))], floor, percent)
                        if len(seen) >= MAX_SEEN:
                            seen.clear()
                        seen.add(digest)
                    digests.append(digest)
                    sizes.append(len(hashes))
                    ells.append(ell)
                    prefixes.append(prefix)
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                ends = np.concatenate(([0], np.cumsum([len(p) for p in prefixes])))
                flat = np.concatenate(prefixes).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                     pa.array(sizes, pa.int64()), pa.array(ells, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
                    ["id", "text_hash", "d1", "d2", "n", "ell", "prefix"])

    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("t"))
    id_type = slim.schema["id"].dataType.simpleString()
    made = slim.mapInArrow(printed, f"id {id_type}, text_hash long, d1 long, d2 long, n long, ell long, "
                                    "prefix array<long>")
    return stage(made.withColumn("row", F.monotonically_increasing_id()), "prints")


def _postings(prints: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Staged: (t, v, pos, n, ell, ok) of the vertices that may have a partner; ``pos`` is
    the shingle's place in the vertex's prefix, from 0."""
    every = prints.filter("ell > 0").select("row", F.posexplode("prefix").alias("pos", "t"))
    # Lists are short: shingles are taken rarest first, and copies of a text in one task
    # count once.  Rows, unlike vertices, need no join before the many lists of one go.
    shared = every.withColumn("c", F.count("*").over(Window.partitionBy("t"))).filter("c > 1").drop("c")
    # A text's copies in other tasks have prefixes, too: only its vertex's own row counts.
    own = stage(shared.join(reps.select(F.col("v").alias("row"), "n", "ell"), "row")
                .select("t", F.col("row").alias("v"), "pos", "n", "ell"), "shared-postings")
    return stage(_able(own, percent), "postings")


def _able(postings: DataFrame, percent: int) -> DataFrame:
    """The postings of vertices that may reach a partner, with ``ok``: bit ``k`` is set if
    at least ``k`` of the vertex's shingles in its ``k``-prefix are in shared lists.  A pair
    that has to share ``k`` shingles needs that bit on both sides."""
    lists = postings.groupBy("t").agg(F.count("*").alias("c"), F.bit_or(_bit("ell")).alias("ells")) \
        .filter("c > 1").drop("c")
    # What a vertex may have to share with some other: its own ell, or a smaller one of theirs.
    needs = F.col("ells").bitwiseAND(_bit("ell") - 1) \
        .bitwiseOR(F.when(F.col("ells") >= _bit("ell"), _bit("ell")).otherwise(F.lit(0)))
    beyond = F.col("pos") - F.col("n") + F.ceil(F.col("n") * percent / 100)  # 0 and more: not in the one-match prefix
    reach = [F.when(F.sum((beyond < k).cast("int")) >= k, F.lit(1 << k)).otherwise(F.lit(0))
             for k in range(1, MAX_MATCHES + 1)]
    able = postings.join(lists, "t").groupBy("v").agg(reduce(Column.bitwiseOR, reach).alias("ok"),
                                                      F.bit_or(needs).alias("needs")) \
        .filter(F.col("ok").bitwiseAND(F.col("needs")) != 0).select("v", "ok")
    return postings.drop("ok").join(able, "v")


def _bit(ell: str) -> Column:
    return F.expr(f"shiftleft(1, cast({ell} as int))")


def _sets(docs: DataFrame, reps: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Staged: (v, shingles) of the wanted vertices, each from the text of its own row."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingler.shingles(shingler.words(t)) for t in part.column(1).to_pylist()]
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
                    ["v", "shingles"])

    few = reps.join(wanted, "v").select("v", F.col("id").alias("i"), F.col("text_hash").alias("h"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")) \
        .join(few, F.col("id").eqNullSafe(F.col("i")) & (F.xxhash64("t") == F.col("h"))).select("v", "t")
    return stage(texts.dropDuplicates(["v"]).mapInArrow(shingled, "v long, shingles array<long>"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are at least ``percent`` alike."""
    of = lambda x: sets.select(F.col("v").alias(x), F.col("shingles").alias(f"s{x}"))
    both = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.withColumn("i", common) \
        .filter(100 * F.col("i") >= percent * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b")


def _shares_least(percent: int) -> Column:
    """Shingles that sets of sizes ``n1`` and ``n2`` share at least, if they link."""
    return F.ceil((F.col("n1") + F.col("n2")) * percent / (100 + percent))


def _can_meet(matches: Column, percent: int) -> Column:
    """Sizes can link, and the shingle is in both prefixes of so many matches."""
    least = _shares_least(percent)
    return (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")) \
        & (F.col("pos1") < F.col("n1") - least + matches) & (F.col("pos2") < F.col("n2") - least + matches)


def _side(rows: DataFrame, i: int) -> DataFrame:
    return rows.select("t", *[F.col(c).alias(f"{c}{i}") for c in rows.columns if c != "t"])


def _need() -> Column:
    return F.least("ell1", "ell2")


def _in_parts(postings: DataFrame, parts: DataFrame | None) -> DataFrame:
    """``postings`` with ``part``, as far as their lists hold several parts."""
    placed = postings.withColumn("part", F.col("v")) if parts is None else postings.join(parts, "v", "left") \
        .withColumn("part", F.coalesce("root", "v")).drop("root")
    several = placed.groupBy("t").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("t")
    return stage(placed.join(several, "t"), "open-postings")


def _star_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of every list's most central vertex with its others."""
    central = postings.groupBy("v").agg(F.count("*").alias("m"))
    leads = stage(postings.join(central, "v").groupBy("t")
                  .agg(F.max(F.struct("m", -F.col("v"), "v", "pos", "n", "ell")).alias("lead"))
                  .select("t", *[F.col(f"lead.{c}").alias(f"{c}2") for c in ("v", "pos", "n", "ell")]), "leads")
    return _side(postings, 1).join(leads, "t").filter((F.col("v1") != F.col("v2")) & _can_meet(_need(), percent)) \
        .groupBy(F.least("v1", "v2").alias("a"), F.greatest("v1", "v2").alias("b")) \
        .agg(F.count("*").alias("m"), F.max(_need()).alias("need")).filter("m >= need").select("a", "b")


def _cross_pairs(opened: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different parts that share enough prefix shingles."""
    prefixes = stage(opened.groupBy("v").agg(F.collect_list(F.struct("pos", "t")).alias("prefix")), "open-prefixes")
    least = _shares_least(percent)

    def held(i: int) -> Column:
        return F.transform(F.filter(f"prefix{i}", lambda x: x["pos"] < F.col(f"n{i}") - least + _need()), lambda x: x["t"])

    enough = F.size(F.array_intersect(held(1), held(2))) >= _need()
    # Who shares ``l`` shingles in the prefixes of ``l`` matches shares one in those of one.
    first = opened.filter(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * percent / 100)).drop("ok")
    lists = stage(first.select("t", "part").distinct().groupBy("t").agg(F.count("*").alias("parts"))
                  .filter("parts > 1"), "open-lists")
    apart = (F.col("part1") < F.col("part2")) & _can_meet(F.lit(1), percent)
    calm = first.join(lists.filter(F.col("parts") <= LONG_LIST).select("t"), "t")
    met = _side(calm, 1).join(_side(calm, 2), "t").filter(apart).select("v1", "n1", "ell1", "v2", "n2", "ell2").distinct()
    of = lambda i: prefixes.select(F.col("v").alias(f"v{i}"), F.col("prefix").alias(f"prefix{i}"))
    few = met.join(of(1), "v1").join(of(2), "v2").filter(enough)
    crowded = stage(first.join(lists.filter(F.col("parts") > LONG_LIST).select("t"), "t").join(prefixes, "v"), "crowded")
    many = _side(crowded, 1).join(_side(crowded, 2), "t").filter(apart & enough)
    ends = [F.least("v1", "v2").alias("a"), F.greatest("v1", "v2").alias("b")]
    return few.select(*ends).unionByName(many.select(*ends)).distinct()


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                       percent: int = PERCENT, cells: int = SKETCH_CELLS) -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    spark: SparkSession = docs.sparkSession
    sketch = spark.sparkContext.broadcast(frequencies(docs, text_col, words, cells))
    prints = _prints(docs, id_col, text_col, words, percent, sketch)
    vertices = prints.filter("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("v"))
    members = stage(prints.select("row", "id", "text_hash", "d1", "d2", "n", "ell").join(vertices, ["d1", "d2"], "left")
                    .drop("d1", "d2"), "members")
    reps = members.filter("row = v").drop("row")
    postings = _postings(prints, reps, percent)
    sets = _sets(docs, reps, postings.select("v").distinct(), id_col, text_col, words)

    links = stage(_verified(_star_pairs(postings, percent), sets, percent), "links")
    parts = None if links.isEmpty() else star_components(links)
    opened = _in_parts(postings, parts)
    if not opened.isEmpty():
        more = stage(_verified(_cross_pairs(opened, percent), sets, percent), "links")
        if not more.isEmpty():
            parts = star_components(links.unionByName(more))

    if parts is None:
        placed = members.withColumn("root", F.col("v"))
    else:
        placed = stage(members.join(parts, "v", "left").withColumn("root", F.coalesce("root", "v")), "placed")
    smallest = stage(placed.filter("root is not null").groupBy("root").agg(F.min("id").alias("component_id")), "smallest")
    joined = placed.join(smallest, "root", "left")
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                         F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
