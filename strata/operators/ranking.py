"""Global RANK() and dense rank without a single-partition window.

``RANK() OVER (ORDER BY x DESC)`` in plain Spark moves every row into one
partition.  Here the rank of a row is 1 + the number of rows with a greater
value, computed as:

1. count rows per distinct value (map-side combined, so a value shared by a
   third of all rows is one row per map task);
2. range-partition the distinct values (Spark samples the bounds) and stage them
   with their range's number: the bounds are drawn once, whatever reads them;
3. inside each range, a window sums the counts of the values before;
4. each range adds the row count of all ranges before (a table of one row per
   range);
5. join the value ranks back on the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stage

_N, _B, _OFF, _GT = "__n", "__bucket", "__offset", "__greater"


def _ranges(spark, asked: int | None) -> int:
    return max(1, asked or int(spark.conf.get("spark.sql.shuffle.partitions")))


def _with_rows_before(vals: DataFrame, order: Column, ranges: int) -> DataFrame:
    """``vals`` (a value column and ``_N`` rows each) with ``_GT``, the rows of all
    values before, in ``order``."""
    ranged = stage(vals.repartitionByRange(ranges, order).withColumn(_B, F.spark_partition_id()), "rank")
    before = (Window.unboundedPreceding, -1)
    w = Window.partitionBy(_B).orderBy(order).rowsBetween(*before)
    local = ranged.withColumn(_GT, F.coalesce(F.sum(_N).over(w), F.lit(0)))
    # One row per range, so this window and the broadcast are bounded.
    per_range = ranged.groupBy(_B).agg(F.sum(_N).alias(_N))
    offsets = per_range.select(
        _B, F.coalesce(F.sum(_N).over(Window.orderBy(_B).rowsBetween(*before)), F.lit(0)).alias(_OFF))
    return local.join(F.broadcast(offsets), _B).withColumn(_GT, F.col(_GT) + F.col(_OFF)).drop(_B, _OFF)


def global_rank(df: DataFrame, col: str, rank_col: str = "rank",
                descending: bool = True, buckets: int | None = None) -> DataFrame:
    """Add ``rank_col`` = SQL ``RANK()`` over ``col``, as bigint.  NULLs rank after
    every value.  ``df`` is read twice: stage it when its values are not computed
    the same way twice (sums of doubles)."""
    vals = df.groupBy(col).agg(F.count(F.lit(1)).alias(_N))
    order = F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_last()
    ranks = _with_rows_before(vals, order, _ranges(df.sparkSession, buckets)).select(
        F.col(col).alias("__v"), (F.lit(1) + F.col(_GT)).cast("bigint").alias(rank_col))
    return df.join(ranks, df[col].eqNullSafe(ranks["__v"]), "inner").drop("__v")


def dense_rank_values(df: DataFrame, col: str, rank_col: str = "rank",
                      ranges: int | None = None) -> DataFrame:
    """Distinct non-NULL values of ``col`` (any orderable type) numbered
    1, 2, ... in ascending order, without a single-partition window."""
    vals = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn(_N, F.lit(1))
    placed = _with_rows_before(vals, F.col(col).asc(), _ranges(df.sparkSession, ranges))
    return placed.select(col, (F.col(_GT) + 1).cast("int").alias(rank_col))
