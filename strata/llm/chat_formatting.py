"""Chat formatting by perspective rotation.

A conversation is rendered once for every participant: that speaker's turns are the
assistant's, the other speakers are users with their names, system turns stay system
turns.  The training mask of a perspective covers its speaker's texts and their end
marks.  The rendering comes as segments, one row per perspective and turn, with the
places of the segment and of its mask in the whole rendered dialogue, so that a
conversation of any length is never held in one row or task.

The turns are dealt by ranges of (conversation, turn) over all tasks and sorted there.
Places are running sums in each (conversation, perspective, range) plus the total of
the ranges before; a conversation that holds a third of all turns spreads over a third
of the ranges.

Defined results: turns come by turn number (null first), then role, then text; repeated
rows are all rendered; a null text is empty, a null role is the speaker "unknown"; a
conversation with system turns only has no participant and gives no rows; null
conversation ids are one conversation; the mark "<|" inside a text is written "< |", so
that no text can pose as a mark; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stage, text_of

# The marks of the rendering.
SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>\n"


def perspectives(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """conv_id, perspective, position (in the conversation, from 0), segment, start
    (character of the segment in the dialogue), mask_start, mask_end (null where the
    perspective's speaker is silent)."""
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(UNKNOWN)).alias("role"),
        F.replace(text_of(text_col), F.lit("<|"), F.lit("< |")).alias("body"),
        F.monotonically_increasing_id().alias("salt"))  # parts repeated rows
    ordered = stage(read.repartitionByRange(n, "conv", "turn", "role", "salt")
                    .sortWithinPartitions("conv", "turn", "role", "body", "salt")
                    .select("conv", "role", "body", F.spark_partition_id().alias("part"),
                            F.monotonically_increasing_id().alias("seq")), "turns")
    slim = ordered.select("conv", "role", "part", "seq", F.length("body").alias("size"))
    people = stage(ordered.filter(F.col("role") != SYSTEM).select(F.col("conv").alias("c"),
                                                                  F.col("role").alias("perspective")).distinct(), "people")
    own = F.col("role") == F.col("perspective")
    head = F.when(own, F.lit("<|assistant|>\n")).when(F.col("role") == SYSTEM, F.lit("<|system|>\n")) \
        .otherwise(F.concat(F.lit("<|user name="), "role", F.lit("|>\n")))
    seen = slim.join(people, F.col("conv").eqNullSafe(F.col("c"))).drop("c") \
        .withColumn("size", F.length(head) + F.col("size") + len(END))
    in_part = Window.partitionBy("conv", "perspective", "part").orderBy("seq")
    before = in_part.rowsBetween(Window.unboundedPreceding, -1)
    local = seen.withColumns({"local": F.coalesce(F.sum("size").over(before), F.lit(0)),
                              "row": F.row_number().over(in_part) - 1})
    # One row per range that a conversation reaches into: at most the number of ranges.
    earlier = Window.partitionBy("conv", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = seen.groupBy("conv", "perspective", "part").agg(F.sum("size").alias("size"), F.count("*").alias("rows")) \
        .select(F.col("conv").alias("c"), F.col("perspective").alias("p"), F.col("part").alias("q"),
                F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"),
                F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("row_base"))
    placed = local.join(bases, F.col("conv").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p"))
                        & (F.col("part") == F.col("q"))) \
        .select("seq", "perspective", (F.col("base") + F.col("local")).alias("start"),
                (F.col("row_base") + F.col("row")).alias("position"))
    segment = F.concat(head, "body", F.lit(END))
    return ordered.join(stage(placed, "places"), "seq").select(
        F.col("conv").alias(conv_col), "perspective", "position", segment.alias("segment"), "start",
        F.when(own, F.col("start") + F.length(head)).alias("mask_start"),
        F.when(own, F.col("start") + F.length(segment) - 1).alias("mask_end"))
