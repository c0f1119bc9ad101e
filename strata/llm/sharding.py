"""Sharding by extendible hashing (native expressions only).

A row's key hash is read bit by bit.  The directory starts with one bucket; a bucket
over its byte limit splits on the next bit, others stay as they are, until every
bucket fits.  A shard is named by the hash prefix that leads to it.

Bits are read in rounds of ``ROUND_BITS``: one aggregation gives the bytes of all
prefixes of the open buckets, a prefix that fits closes its rows at the least such
depth, and only rows of prefixes that still do not fit go on to the next round.  Rows
of one key cannot be parted by their key's hash: when an open bucket holds one key
only, its further bits come from a hash of the row's number, so a key that holds a
third of all rows splits as well.  A single row over the limit is a shard of its own.

What is moved are ids, hashes and sizes, never texts.

Defined results: a null text has 0 bytes, null ids are one key; repeated rows each
get a place; an empty table has no shards; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stage

LIMIT_BYTES = 16 << 20
ROUND_BITS = 8
MAX_ROUNDS = 32


def _prefix_name(prefix, depth):
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, "0"))


def assign_shards(docs: DataFrame, *, limit_bytes: int = LIMIT_BYTES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, shard (bits; after a dot, bits of the row's
    number), depth (bits used)."""
    slim = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.xxhash64(id_col).alias("key_hash"), F.xxhash64(F.monotonically_increasing_id()).alias("row_hash"))
    # Staged, so that a row's number is the same in every round.
    rows = stage(slim.withColumns({"path": F.lit(""), "bits": F.col("key_hash"), "by_row": F.lit(False),
                                   "used": F.lit(0)}), "shard-rows")
    closed: list[DataFrame] = []
    for turn in range(MAX_ROUNDS):
        rows = rows.withColumn("cell", F.shiftrightunsigned("bits", 64 - ROUND_BITS))
        cells = stage(rows.groupBy("path", "cell").agg(
            F.sum("n_bytes").alias("b"), F.count("*").alias("n"), F.min("key_hash").alias("k0"),
            F.max("key_hash").alias("k1")), "shard-cells")
        # All prefixes of the cells; in the first round also the whole table.
        depths = F.explode(F.sequence(F.lit(0 if turn == 0 else 1), F.lit(ROUND_BITS)))
        prefixes = cells.withColumn("d", depths).withColumn("p", F.expr(f"shiftright(cell, {ROUND_BITS} - d)"))
        nodes = prefixes.groupBy("path", "d", "p").agg(F.sum("b").alias("nb"), F.sum("n").alias("nn"))
        fits = nodes.filter((F.col("nb") <= limit_bytes) | (F.col("nn") == 1)).select("path", "d", "p")
        leaf = prefixes.join(fits, ["path", "d", "p"]).groupBy("path", "cell").agg(F.min("d").alias("depth"))
        table = stage(cells.join(leaf, ["path", "cell"], "left")
                      .select("path", "cell", "depth", (F.col("k0") == F.col("k1")).alias("one_key")), "shard-table")
        placed = rows.join(table, ["path", "cell"])
        prefix = F.expr(f"shiftright(cell, {ROUND_BITS} - depth)")
        closed.append(placed.filter("depth is not null").select(
            "id", "n_bytes", F.concat("path", _prefix_name(prefix, F.col("depth"))).alias("shard"),
            (F.col("used") + F.col("depth")).alias("depth")))
        onward = F.col("one_key") & ~F.col("by_row")
        path = F.concat("path", F.lpad(F.bin("cell"), ROUND_BITS, "0"), F.when(onward, ".").otherwise(""))
        rows = stage(placed.filter("depth is null").select(
            "id", "n_bytes", "key_hash", "row_hash", path.alias("path"),
            F.when(onward, F.col("row_hash")).otherwise(F.shiftleft("bits", ROUND_BITS)).alias("bits"),
            (F.col("by_row") | onward).alias("by_row"), (F.col("used") + ROUND_BITS).alias("used")), "shard-rows")
        if rows.isEmpty():
            break
    else:
        raise ValueError(f"rows cannot be parted by {MAX_ROUNDS * ROUND_BITS} bits")
    out = reduce(DataFrame.unionByName, closed)
    return out.withColumnRenamed("id", id_col)


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard: shard, depth, rows and bytes."""
    return assigned.groupBy("shard", "depth").agg(F.count("*").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
