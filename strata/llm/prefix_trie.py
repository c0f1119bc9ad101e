"""Conversation prefix trie as a z-fast trie.

A conversation is a string over turns (role, text).  The trie of all conversations is
kept compacted: an explicit node stands where conversations branch or end, and the edge
above it holds the turns since the node before.  Every prefix has a 128-bit key, the
chained digest of its turns.  A node hangs in a hash table (a Spark table) under its
*handle*: its prefix at the two-fattest depth of its edge, the depth whose binary form
ends in the most zeros.  Fat binary search over these depths finds the exit node of a
conversation, where it leaves the trie, with one hash join per binary digit of the
length, for all waiting conversations at once.

Conversations are inserted in batches.  All waiting conversations look for their exits;
every exit becomes an explicit node (it may split an edge); of those that leave at the
same place by the same turn one is inserted whole, the one of the smallest hash, the
others wait for the next batch.  A waiting conversation shares the path of a random one
of its group, so the groups halve and the number of batches grows with the logarithm of
the number of conversations.  Equal conversations are one string from the start.

An inserted conversation owns the nodes of its path below the place where it hangs.
Sums over subtrees are running sums along owned paths, from the last batch up; a place
where many paths hang is summed map-side first.  At the end edges are expanded to one
row per turn.

What a task holds: the turn digests of single conversations (16 bytes a turn), never
texts or a group of conversations.  The ids of the conversations that end at a node are
joined to pieces of ``CHUNK_IDS`` in parallel and hashed as a stream.

Defined results: turns come by turn number (null first), ties by the digest of role and
text; repeated rows are turns of their own; null roles and texts are empty; rows without a
conversation id belong to no conversation and are left out; an empty table gives no
rows (the root has no member to name it); further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stage, text_of

# Turns of a shared head, and whose head it is.
HEAD_TURNS = 6
HEAD_STRIDE = 100
KEY_BYTES = 16
ROOT = "\0" * KEY_BYTES
CHUNK_IDS = 4096
# Steps of a search that go into one plan.
PLAN_STEPS = 6


def strings(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, turns): every conversation's (digest, code points) per turn, in order."""
    role, text = text_of(role_col), text_of(text_col)
    spelled = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.unhex(F.substring(F.sha2(spelled, 256), 1, 2 * KEY_BYTES))
    slim = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.struct(F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars")).alias("x"))
    ordered = F.transform(F.sort_array(F.collect_list("x")), lambda x: F.struct(x["digest"].alias("digest"),
                                                                                x["chars"].alias("chars")))
    return slim.groupBy("conv").agg(ordered.alias("turns"))


def with_shared_heads(convs: DataFrame, stride: int = HEAD_STRIDE, turns: int = HEAD_TURNS) -> DataFrame:
    """Every conversation with its first ``h`` turns replaced by those of the first
    conversation of its stride, ``h`` = crc32 of its decimal id modulo ``turns``."""
    heads = convs.filter(F.col("conv") % stride == 0) \
        .select(F.col("conv").alias("base"), F.slice("turns", 1, turns - 1).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % turns).cast("int")
    own = F.slice("turns", h + 1, F.size("turns"))
    return convs.withColumn("at", F.col("conv") - F.col("conv") % stride) \
        .join(heads, F.col("at") == F.col("base"), "left") \
        .select("conv", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", 1, h), own)).alias("turns"))


def _paths(convs: DataFrame) -> DataFrame:
    """Staged: conv, len, key (of the whole string), keys (of its prefixes), sums (code
    points of the first 0, 1, ... turns)."""

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                all_keys, all_sums, last = [], [], []
                for digests, chars in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    key, keys, sums = ROOT.encode(), [], [0]
                    for digest, n in zip(digests, chars):
                        key = hashlib.blake2b(key + digest, digest_size=KEY_BYTES).digest()
                        keys.append(key)
                        sums.append(sums[-1] + n)
                    all_keys.append(keys)
                    all_sums.append(sums)
                    last.append(key)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(len, all_keys), pa.int64()), pa.array(last, pa.binary()),
                     pa.array(all_keys, pa.list_(pa.binary())), pa.array(all_sums, pa.list_(pa.int64()))],
                    ["conv", "len", "key", "keys", "sums"])

    flat = convs.select("conv", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars"))
    return stage(flat.mapInArrow(chained, "conv long, len long, key binary, keys array<binary>, sums array<long>"), "paths")


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] whose binary form ends in the most zeros."""
    return F.expr(f"{high} & ~(shiftleft(1L, length(bin({low} ^ {high})) - 1) - 1)")


def _at(array: str, i: str | Column) -> Column:
    """Element ``i`` of an array, counted from 1; null beyond it."""
    return F.get(F.col(array), (F.col(i) if isinstance(i, str) else i).cast("int") - 1)


def _nodes(points: DataFrame, owned: DataFrame, texts: DataFrame) -> DataFrame:
    """Staged: the explicit nodes.  ``low`` is the depth of the node above, ``edge`` the
    keys of the turns between, ``name`` the first of them, ``up`` the key above."""
    order = Window.partitionBy("owner").orderBy("depth")
    edges = points.join(owned.select("owner", "hang", "batch"), "owner") \
        .withColumn("low", F.coalesce(F.lag("depth").over(order), F.col("hang"))) \
        .join(texts.select(F.col("key").alias("owner"), "keys", "sums"), "owner") \
        .withColumn("handle_depth", two_fattest("low", "depth"))
    span = (F.col("depth") - F.col("low")).cast("int")
    start = F.col("low").cast("int") + 1
    return stage(edges.select(
        "owner", "batch", "hang", "low", "depth", _at("keys", "depth").alias("key"),
        _at("keys", "handle_depth").alias("handle"), _at("keys", F.col("low") + 1).alias("name"),
        F.coalesce(_at("keys", "low"), F.lit(ROOT).cast("binary")).alias("up"),
        F.slice("keys", start, span).alias("edge"), F.slice("sums", start, span + 1).alias("sums")), "nodes")


def _exits(waiting: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """``waiting`` with ``at`` (owner of the path where a string leaves the trie, null for
    the root) and ``hang`` (how deep): fat binary search, then one look for a child."""

    def matched() -> Column:
        """Depth down to which the string goes along the found edge."""
        same = F.zip_with("edge", F.slice("keys", F.col("low").cast("int") + 1, F.size("edge")),
                          lambda x, y: F.coalesce(x == y, F.lit(False)))
        return F.col("low") + F.size(F.filter(same, lambda x: x))

    hooks = nodes.select("handle", "owner", "low", "depth", "edge")
    state = waiting.withColumns({"a": F.lit(0).cast("long"), "b": F.col("len"), "at": F.lit(None).cast("binary")})
    kept = state.columns
    for step in range(steps):
        f = F.when(F.col("a") < F.col("b"), _at("keys", two_fattest("a", "b")))
        found = state.withColumn("f", two_fattest("a", "b")).withColumn("look", f) \
            .join(hooks, F.col("look") == F.col("handle"), "left").withColumn("to", matched())
        hit, whole = F.col("handle").isNotNull(), F.col("to") == F.col("depth")
        state = found.select(
            *[c for c in kept if c not in ("a", "b", "at")],
            F.when(hit, F.col("to")).otherwise(F.col("a")).alias("a"),
            F.when(F.col("look").isNull() | hit & whole, F.col("b")).when(hit, F.col("to"))
            .otherwise(F.col("f") - 1).alias("b"),
            F.when(hit, F.col("owner")).otherwise(F.col("at")).alias("at"))
        if step % PLAN_STEPS == PLAN_STEPS - 1:
            state = stage(state, "search")
    names = nodes.select("name", "owner", "low", "edge")
    last = state.withColumn("look", _at("keys", F.col("a") + 1)).join(names, F.col("look") == F.col("name"), "left")
    return last.select("key", "len", "keys", F.when(F.col("name").isNull(), F.col("a")).otherwise(matched()).alias("hang"),
                       F.when(F.col("name").isNull(), F.col("at")).otherwise(F.col("owner")).alias("at"))


def _build(texts: DataFrame) -> tuple[DataFrame | None, int]:
    """(the explicit nodes below the root, number of batches) of all distinct strings."""
    waiting = stage(texts.filter("len > 0").select("key", "len", "keys"), "waiting")
    longest = waiting.agg(F.max("len")).first()[0]
    if longest is None:
        return None, 0
    nodes = owned = points = None
    batch = 0
    while True:
        batch += 1
        exits = waiting.withColumns({"hang": F.lit(0).cast("long"), "at": F.lit(None).cast("binary")}) if nodes is None \
            else stage(_exits(waiting, nodes, int(longest).bit_length()), "exits")
        leaving = exits.filter("hang < len")
        chosen = stage(leaving.groupBy(_at("keys", F.col("hang") + 1).alias("turn"))
                       .agg(F.min(F.struct(F.xxhash64("key").alias("h"), "key")).alias("x"))
                       .select(F.col("x.key").alias("key")), "chosen")
        fresh = leaving.join(chosen, "key").select(F.col("key").alias("owner"), "hang", F.lit(batch).alias("batch"), "len")
        cuts = exits.filter("at is not null").select(F.col("at").alias("owner"), F.col("hang").alias("depth")) \
            .unionByName(fresh.select("owner", F.col("len").alias("depth")))
        owned = stage(fresh.drop("len") if owned is None else owned.unionByName(fresh.drop("len")), "owned")
        points = stage((cuts if points is None else points.unionByName(cuts)).distinct(), "points")
        nodes = _nodes(points, owned, texts)
        waiting = stage(leaving.join(chosen, "key", "left_anti").select("key", "len", "keys"), "waiting")
        if waiting.isEmpty():
            return nodes, batch


def _ends(paths: DataFrame) -> DataFrame:
    """Staged: (key, ends_sha256) of the strings that conversations end at."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()),
                                               pa.array([",".join(map(str, ids))])], ["key", "first", "piece"])

        for batch in batches:
            for k, i in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (k != key or len(ids) >= CHUNK_IDS):
                    yield out()
                    ids = []
                key = k
                ids.append(i)
        if ids:
            yield out()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])],
                                              ["key", "ends_sha256"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for k, _, piece in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    if k != key:
                        if sha:
                            yield out()
                        key, sha = k, hashlib.sha256(piece.encode())
                    else:
                        sha.update(b"," + piece.encode())
        if sha:
            yield out()

    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = paths.select("key", "conv").repartitionByRange(n, "key", "conv").sortWithinPartitions("key", "conv") \
        .mapInArrow(pieces, "key binary, first long, piece string")
    return stage(cut.repartition("key").sortWithinPartitions("key", "first")
                 .mapInArrow(hashed, "key binary, ends_sha256 string"), "ends")


SUMS = ("n", "leaves", "saved", "children")


def _gathered(parts: list[DataFrame]) -> DataFrame:
    """What hangs at each key: sums over the subtrees of inserted paths."""
    return reduce(DataFrame.unionByName, parts).groupBy("key").agg(
        *[F.sum(c).alias(f"a_{c}") for c in SUMS], F.min("first").alias("a_first"))


def trie(convs: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv, turns): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = _paths(convs)
    some = lambda c: F.first(c).alias(c)  # noqa: E731  equal in all rows of a key
    texts = stage(paths.groupBy("key").agg(F.count("*").alias("ends"), F.min("conv").alias("first"), some("len"),
                                           some("keys"), some("sums")), "strings")
    nodes, batches = _build(texts)
    ended = texts.select("key", "ends", F.col("first").alias("e_first"))
    zero = F.lit(0).cast("long")
    stats, hanging = [], []
    for batch in range(batches, 0, -1):
        rows = nodes.filter(F.col("batch") == batch).join(ended, "key", "left")
        if hanging:
            rows = rows.join(_gathered(hanging), "key", "left")
        else:
            rows = rows.withColumns({**{f"a_{c}": zero for c in SUMS}, "a_first": zero.cast("long") + F.lit(None)})
        a = {c: F.coalesce(F.col(f"a_{c}"), zero) for c in SUMS}
        up = Window.partitionBy("owner").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
        below = Window.partitionBy("owner").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, -1)
        lowest = F.row_number().over(Window.partitionBy("owner").orderBy(F.desc("depth"))) == 1
        summed = rows.withColumns({
            "n": F.sum(F.coalesce(F.col("ends"), zero) + a["n"]).over(up),
            "first": F.min(F.least("e_first", "a_first")).over(up),
            "children": a["children"] + F.when(lowest, 0).otherwise(1),
            "leaves": F.sum(a["leaves"]).over(up),
            "bare": F.max(F.when(F.col("depth") == F.max("depth").over(Window.partitionBy("owner")), a["children"]))
            .over(Window.partitionBy("owner"))})
        edge = (F.col("n") - 1) * (F.element_at("sums", -1) - F.element_at("sums", 1))
        done = stage(summed.withColumn("edge_saved", edge).select(
            "key", "up", "low", "depth", "hang", "sums", "n", "first", "children",
            (F.col("leaves") + F.when(F.col("bare") == 0, 1).otherwise(0)).alias("leaves"),
            (F.sum(a["saved"]).over(up) + F.coalesce(F.sum("edge_saved").over(below), zero)).alias("below"),
            "edge_saved"), "sums")
        stats.append(done)
        hanging.append(done.filter("low = hang").select(
            F.col("up").alias("key"), "n", "leaves", (F.col("below") + F.col("edge_saved")).alias("saved"),
            F.lit(1).cast("long").alias("children"), "first"))

    root_key = F.lit(ROOT).cast("binary")
    top = ended.filter(F.col("key") == root_key).select(
        "key", F.col("ends").alias("n"), F.lit(0).cast("long").alias("leaves"), zero.alias("saved"), zero.alias("children"),
        F.col("e_first").alias("first"))
    # No conversation, no row: the sums of an empty table have no first.
    root = stage(_gathered([top, *[h.filter(F.col("key") == root_key) for h in hanging]]).select(
        "key", F.col("a_first").alias("first"), F.col("a_n").alias("n"), F.col("a_children").alias("children"),
        F.greatest("a_leaves", F.lit(1)).alias("leaves"), F.col("a_saved").alias("below")), "root")
    ends = _ends(paths)
    none = hashlib.sha256(b"").hexdigest()
    root_row = root.join(ends, "key", "left").select(
        F.col("first").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("below").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
    if not stats:
        return root_row
    every = reduce(DataFrame.unionByName, stats)
    parents = every.select(F.col("key").alias("up"), F.col("first").alias("up_first")) \
        .unionByName(root.select(F.col("key").alias("up"), F.col("first").alias("up_first")))
    # ``sums`` runs over the edge: its entry i is the code points before turn low + i + 1.
    turn = every.join(parents, "up").join(ends, "key", "left") \
        .select("*", F.posexplode(F.slice("sums", 1, F.size("sums") - 1)).alias("i", "before"))
    depth = F.col("low") + F.col("i") + 1
    at_node = depth == F.col("depth")
    expanded = turn.select(
        F.col("first").alias("conv_id"), depth.alias("depth"),
        F.when(F.col("i") == 0, F.col("up_first")).otherwise(F.col("first")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(at_node, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n") - 1) * (F.element_at("sums", -1) - F.col("before"))).alias("saved_tokens"),
        F.when(at_node, F.coalesce("ends_sha256", F.lit(none))).otherwise(F.lit(none)).alias("ends_sha256"))
    return expanded.unionByName(root_row)


def conversation_trie(turns: DataFrame, **columns: str) -> DataFrame:
    """The trie of all conversations, rebuilt with shared heads."""
    return trie(with_shared_heads(stage(strings(turns, **columns), "conversations")))
